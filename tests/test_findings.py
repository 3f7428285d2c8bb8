import pytest
from pyspark.sql import functions as F

from ratewise.operators import chartdata, findings, prepare, rates, sampling
from ratewise.operators.findings import AuditRoles
from ratewise.operators.roles import MissingColumns
from ratewise.plans import flows
from ratewise.sources.scratch import stage

ROLES = AuditRoles(
    id="id_vuelo", target="demora", origin="aeropuerto_origen", destination="aeropuerto_destino", distance="distancia_vuelo",
    minutes="tiempo_estimado_vuelo", load="ocupacion_vuelo", kind="tipo_avion", impossible_pair=("EZE", "AEP"),
)


def test_planted_problems_are_found(flights, flights_pd):
    found = stage(findings.audit(stage(flights, "flights"), ROLES), "findings")
    got = found.collect()
    by_rule = {}
    for r in got:
        by_rule.setdefault(r["rule"], []).append(r)
    assert by_rule["null_cells"][0]["value"] == flights_pd.isna().sum().sum()
    assert {r["column"] for r in by_rule["null_column"]} == set(flights_pd.columns[flights_pd.isna().any()])
    assert by_rule["duplicate_rows"][0]["level"] == "INFO"
    assert by_rule["duplicate_rows_without_id"][0]["level"] == "ANOMALY" and by_rule["duplicate_rows_without_id"][0]["value"] == 2
    assert by_rule["impossible_route"][0]["level"] == "CRITICAL"
    assert by_rule["same_ends"][0]["value"] == 1
    assert by_rule["above_100"][0]["value"] == 1 and by_rule["below_0"][0]["value"] == 1 and by_rule["exactly_0"][0]["value"] == 1
    assert by_rule["class_balance"][0]["level"] == "FINDING"
    assert [r["column"] for r in by_rule["dominant_value"] if r["column"] == "constante"] == ["constante"]
    assert by_rule["rate_too_low"][0]["value"] >= 1
    assert "drop_candidate" in by_rule
    shares = {(r["column"], r["text"].split("'")[1]): r["value"] for r in by_rule["category_share"]}
    rates_ = {(r["column"], r["text"].split("'")[1]): r["value"] for r in by_rule["category_rate"]}
    assert set(shares) == set(rates_)
    for c in ("condiciones_climaticas", "tipo_avion", "aeropuerto_origen"):
        present = flights_pd.dropna(subset=[c])
        for v, part in present.groupby(c):
            assert abs(shares[c, v] - 100 * len(part) / len(present)) < 1e-3 and abs(rates_[c, v] - 100 * part["demora"].mean()) < 1e-3
    order = findings.audit_report(found).select("level").collect()
    ranks = [findings.SEVERITY.index(r["level"]) for r in order]
    assert ranks == sorted(ranks)
    counts = {r["level"]: r["findings"] for r in findings.audit_counts(found).collect()}
    assert sum(counts.values()) == len(got) and counts["CRITICAL"] == 1


def test_missing_target_is_critical(flights):
    got = findings.audit(flights.select("id_vuelo", "distancia_vuelo", "tipo_avion"), AuditRoles(id="id_vuelo", target="demora"))
    assert got.filter((F.col("rule") == "target_missing") & (F.col("level") == "CRITICAL")).count() == 1


def test_eda_report_skips_missing_parts(flights):
    roles = flows.EdaRoles(
        id="id_vuelo", target="demora", places=("aeropuerto_origen", "aeropuerto_destino"), weather="condiciones_climaticas",
        congestion="nada", hour="hora_salida_programada", visibility="visibilidad", distance="distancia_vuelo",
        minutes="tiempo_estimado_vuelo", kind="tipo_avion",
    )
    report = flows.eda_report(stage(flights, "flights"), roles)
    assert "rate_by_congestion" not in report and {"rate_by_weather", "rate_by_hour", "entity_rate", "correlation_matrix"} <= set(report)
    for name in ("rate_by_hour", "rate_by_bin", "class_balance", "rate_by_type"):
        assert report[name].count() > 0


def test_missing_columns_are_named(flights):
    for call in (
        lambda: findings.audit(flights, AuditRoles(id="id_vuelo", target="demora", load="nada")),
        lambda: rates.rate_by_category(flights, "nada", "demora"),
        lambda: rates.rate_by_category_all(flights, ["tipo_avion", "nada"], "demora"),
        lambda: sampling.stratified_split(flights, "demora", ["nada"]),
        lambda: prepare.build_view(flights, prepare.ViewSpec(target="nada")),
    ):
        with pytest.raises(MissingColumns, match="nada"):
            call()


def test_eda_computes_its_input_once(spark, flights, monkeypatch):
    columns = ["id_vuelo", "distancia_vuelo", "visibilidad", "condiciones_climaticas", "demora"]
    ids, rest = flights.select("id_vuelo", "demora"), flights.select(F.col("id_vuelo").alias("i"), *columns[1:4])
    joined = ids.join(rest, F.col("id_vuelo") == F.col("i")).select(*columns)
    scans, keep = [], chartdata.quantile_row
    monkeypatch.setattr(chartdata, "quantile_row", lambda df, cols, *a, **b: scans.append(list(cols)) or keep(df, cols, *a, **b))
    report = flows.eda_report(joined, flows.EdaRoles(id="id_vuelo", target="demora", weather="condiciones_climaticas"))
    assert "Join" not in report["rate_by_weather"]._jdf.queryExecution().optimizedPlan().toString()
    assert len(scans) == 2  # of all columns for the histograms, and for the boxes
    for c in ("distancia_vuelo", "visibilidad"):
        alone = chartdata.histogram_bins(joined, c).orderBy("bin").collect()
        assert report[f"histogram_{c}"].orderBy("bin").collect() == alone
