import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.functions.columns import extract_hour
from ratewise.operators import chartdata, entities, rates, relations

PLACES = ["aeropuerto_origen", "aeropuerto_destino"]


def melted(pdf, extra):
    return pd.concat([pdf[[*extra, p]].rename(columns={p: "place"}) for p in PLACES])


def test_rate_by_category(flights, flights_pd):
    got = rates.rate_by_category(flights, "condiciones_climaticas", "demora").toPandas()
    want = flights_pd.dropna(subset=["condiciones_climaticas"]).groupby("condiciones_climaticas")["demora"].agg(["count", "mean"])
    assert got["rate_pct"].is_monotonic_decreasing
    for _, r in got.iterrows():
        w = want.loc[r["condiciones_climaticas"]]
        assert r["total"] == w["count"] and r["rate_pct"] == pytest.approx(w["mean"] * 100, abs=0.0051)


def test_hours(flights, flights_pd):
    df = flights.withColumn("hora", extract_hour("hora_salida_programada"))
    h = pd.to_numeric(flights_pd["hora_salida_programada"].astype(str).str.extract(r"(\d{1,2})", expand=False), errors="coerce")
    valid = flights_pd.assign(hora=h)[h.between(0, 23)]
    want = valid.groupby("hora")["demora"].agg(["count", "mean"])
    got = rates.rate_by_hour(df, "hora", "demora").toPandas().set_index("hora")
    assert got["rows"].to_dict() == want["count"].to_dict()
    v = relations.hour_verdict(df, "hora", "demora").first()
    assert v["r"] == pytest.approx(valid["hora"].corr(valid["demora"]), abs=1e-6)
    assert v["std_pp"] == pytest.approx((want["mean"] * 100).std(), abs=1e-4)
    peak = rates.peak_group(rates.rate_by_hour(df, "hora", "demora"), "hora", "rate_pct").first()
    assert peak["hora"] == (want["mean"] * 100).round(2).idxmax()


def test_rate_by_bin_matches_cut(flights, flights_pd):
    got = rates.rate_by_bin(flights, "visibilidad", "demora").toPandas().set_index("bin")
    base = flights_pd[["visibilidad", "demora"]].dropna()
    want = base.groupby(pd.cut(base["visibilidad"], bins=10, labels=False) + 1)["demora"].agg(["count", "mean"])
    assert got["total"].to_dict() == want["count"].to_dict()
    assert np.allclose(got["rate_pct"], want.loc[got.index, "mean"] * 100, atol=0.0051)


def test_places(flights, flights_pd):
    long = melted(flights_pd, ["demora", "condiciones_climaticas"])
    want = long.groupby("place")["demora"].agg(["count", "sum", "mean"])
    got = rates.entity_rate(flights, PLACES, "demora").toPandas().set_index("place")
    assert got["total"].to_dict() == want["count"].to_dict() and got["positives"].to_dict() == want["sum"].to_dict()
    top = rates.entity_volume_rate_topn(flights, PLACES, "demora", 2).collect()
    assert [r["place"] for r in top] == want.sort_values("count", ascending=False).index[:2].tolist()
    wide = rates.rate_contribution(flights, PLACES, "condiciones_climaticas", "demora", n=3).toPandas().set_index("place")
    cell = long.groupby(["place", "condiciones_climaticas"])["demora"].sum()
    for place, r in wide.iterrows():
        for w in ("Despejado", "Lluvia", "Nublado"):
            assert r[w] == pytest.approx(cell.get((place, w), 0) / want.loc[place, "count"] * 100, abs=0.0051)


def test_single_place_column(flights, flights_pd):
    got = {r["place"]: r["total"] for r in rates.entity_rate(flights, PLACES[:1], "demora").collect()}
    assert got == flights_pd["aeropuerto_origen"].value_counts().to_dict()


def test_routes(flights, flights_pd):
    pairs = flights_pd.groupby(PLACES).size()
    got = {(r[0], r[1]): r[2] for r in rates.route_counts(flights, *PLACES).collect()}
    assert got == pairs.to_dict()
    directions = pairs.reset_index(name="n")
    directions["key"] = [tuple(sorted(p)) for p in directions[PLACES].itertuples(index=False)]
    one_way = directions.groupby("key").filter(lambda g: len(g) == 1)["key"]
    assert {(r["end_1"], r["end_2"]) for r in rates.one_way_routes(flights, *PLACES).collect()} == set(one_way)


def test_balance_levels(spark):
    for ones, level in ((10, "severe"), (30, "moderate"), (45, "acceptable")):
        df = spark.createDataFrame([(int(i < ones),) for i in range(100)], "y int")
        rows = {r["class"]: r for r in rates.class_balance(df, "y").collect()}
        assert rows[1]["rows"] == ones and rows[0]["level"] == level


def test_correlations_match_pandas(flights, flights_pd):
    cols = ["distancia_vuelo", "ocupacion_vuelo", "visibilidad", "tiempo_estimado_vuelo", "demora", "constante"]
    want = flights_pd[cols].corr()
    got = {(r["x"], r["y"]): r["r"] for r in relations.correlation_matrix(flights, cols).collect()}
    for a in cols:
        for b in cols:
            if a == b:
                assert got[a, b] == 1.0
            elif "constante" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-6)
    ranking = relations.target_correlation_ranking(flights, cols[:4], "demora").toPandas()
    assert ranking["r"].abs().is_monotonic_decreasing
    high = relations.collinear_pairs(flights, ["distancia_vuelo", "tiempo_estimado_vuelo"], 0.1).collect()
    assert len(high) == 1


# Published table of 40 places (volume, raw %, controlled %, difference, share explained %).
PLACE_TABLE = """
EZE 4328 32.5 17.6 14.9 46; BOG 3764 31.7 17.0 14.7 46; MDE 2975 32.7 19.2 13.5 41; GRU 2958 30.8 18.4 12.4 40
PTY 2592 31.2 19.2 12.0 38; LIM 816 33.6 20.0 13.6 40; UIO 809 33.1 20.1 13.0 39; PEI 717 31.9 18.2 13.7 43
MIA 712 34.0 22.7 11.3 33; CTG 694 32.4 16.3 16.2 50; BAQ 673 31.6 17.9 13.7 43; CLO 624 32.7 24.5 8.2 25
BGA 617 29.8 13.5 16.3 55; JFK 611 35.0 20.5 14.5 42; CCS 572 29.9 11.8 18.1 61; AEP 562 30.4 15.8 14.6 48
MVD 511 27.2 9.9 17.3 64; MEX 418 29.2 16.2 12.9 44; GIG 414 29.2 15.5 13.8 47; SCL 382 35.9 26.3 9.5 27
MAD 322 33.2 15.0 18.2 55; ROS 302 34.4 16.7 17.8 52; SJO 254 33.5 22.9 10.5 32; CWB 253 26.9 14.6 12.2 46
FLN 249 28.5 17.0 11.5 40; COR 245 33.1 17.1 16.0 48; GUA 239 31.0 16.3 14.6 47; POA 228 31.1 20.0 11.1 36
IGR 219 30.6 8.7 21.9 72; MDZ 215 32.6 18.2 14.4 44; ASU 213 33.8 25.0 8.8 26; BRC 211 32.7 20.0 12.7 39
BSB 209 37.3 27.0 10.3 28; NQN 207 32.4 15.8 16.6 51; TUC 196 29.1 19.4 9.7 34; CLT 165 32.1 11.1 21.0 65
IAH 162 35.2 32.4 2.8 8; SSA 150 27.3 16.1 11.2 41; AMS 110 30.0 16.7 13.3 44; CDG 102 21.6 13.3 8.2 38
"""


def place_table(spark):
    rows = [r.split() for line in PLACE_TABLE.strip().splitlines() for r in line.split(";")]
    parsed = [(p, int(v), float(a), float(b), float(d), float(s)) for p, v, a, b, d, s in rows]
    return spark.createDataFrame(parsed, "place string, volume long, raw double, controlled double, delta double, share double")


def test_published_place_table(spark):
    t = place_table(spark)
    assert t.count() == 40 and t.agg(F.sum("volume")).first()[0] == 30000
    spread = {r["size_class"]: r for r in entities.dispersion_by_size(t, "volume", "raw").collect()}
    assert spread["large"]["places"] == 5 and spread["large"]["std_pp"] == pytest.approx(0.82, abs=0.005)
    assert spread["small"]["places"] == 23 and spread["small"]["std_pp"] == pytest.approx(3.43, abs=0.005)
    c = entities.volume_rate_correlation(t, "volume", "raw").first()
    assert c["places"] == 40 and c["r"] == pytest.approx(0.082, abs=0.002) and c["p_value"] == pytest.approx(0.61, abs=0.01)
    assert t.filter(F.abs(F.col("raw") - F.col("controlled") - F.col("delta")) > 0.11).count() == 0


def test_adjusted_rates(flights, flights_pd):
    control = (F.col("condiciones_climaticas") == "Despejado") & (F.col("congestion_aerea") == "Baja")
    got = entities.adjusted_rate_table(flights, PLACES, "demora", control).toPandas().set_index("place")
    long = melted(flights_pd, ["demora", "condiciones_climaticas", "congestion_aerea"])
    clear = long[(long["condiciones_climaticas"] == "Despejado") & (long["congestion_aerea"] == "Baja")]
    for place, r in got.iterrows():
        raw, pure = long[long.place == place]["demora"].mean(), clear[clear.place == place]["demora"].mean()
        assert r["raw_pct"] == pytest.approx(raw * 100, abs=1e-4) and r["controlled_pct"] == pytest.approx(pure * 100, abs=1e-4)
        assert r["delta_pp"] == pytest.approx((raw - pure) * 100, abs=1e-4)
    scenes = {r["scenario"]: r for r in entities.control_scenarios(flights, PLACES, "demora", {"all": F.lit(True), "both": control}).collect()}
    assert scenes["both"]["mean_pct"] == pytest.approx(clear.groupby("place")["demora"].mean().mean() * 100, abs=1e-4)
    assert scenes["all"]["std_pp"] == pytest.approx(long.groupby("place")["demora"].mean().std() * 100, abs=1e-4)


def test_role_asymmetry(flights, flights_pd):
    o = flights_pd.groupby("aeropuerto_origen")["demora"].mean() * 100
    d = flights_pd.groupby("aeropuerto_destino")["demora"].mean() * 100
    r = entities.role_asymmetry(flights, *PLACES, "demora").first()
    assert r["r"] == pytest.approx(o.corr(d), abs=1e-4) and r["places"] == len(o)
    assert r["mean_abs_difference"] == pytest.approx((o - d).abs().mean(), abs=1e-3)
    assert r["above_limit"] == ((o - d).abs() > 4).sum()


def test_charts(flights, flights_pd):
    v = flights_pd["visibilidad"].dropna()
    hist = chartdata.histogram_bins(flights, "visibilidad", 12).toPandas().set_index("bin")["rows"]
    want = np.histogram(v, 12)[0]
    assert all(hist.get(i + 1, 0) == n for i, n in enumerate(want))
    assert chartdata.auto_bins(flights, "visibilidad") == len(np.histogram_bin_edges(v, "auto")) - 1
    box = chartdata.box_stats(flights, ["visibilidad"]).first()
    q1, q3 = v.quantile(0.25), v.quantile(0.75)
    inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
    assert box["high"] == pytest.approx(inside.max()) and box["outliers"] == len(v) - len(inside)
    curve = chartdata.density_curve(flights, "visibilidad", 50).toPandas()
    h = v.std() * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 50)
    exact = np.exp(-0.5 * ((grid[:, None] - v.to_numpy()[None, :]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.allclose(curve["density"], exact, atol=1e-9)
    few = flights.withColumn("step", F.round(F.col("visibilidad") / 1000))  # repeated values take the counted path
    s = (flights_pd["visibilidad"] / 1000).dropna().apply(lambda x: np.floor(x + 0.5))
    hs = s.std() * len(s) ** -0.2
    gs = np.linspace(s.min(), s.max(), 20)
    es = np.exp(-0.5 * ((gs[:, None] - s.to_numpy()[None, :]) / hs) ** 2).sum(1) / (len(s) * hs * np.sqrt(2 * np.pi))
    assert np.allclose(chartdata.density_curve(few, "step", 20).toPandas()["density"], es, atol=1e-9)
    assert chartdata.scatter_sample(flights, "distancia_vuelo", "tiempo_estimado_vuelo", ["id_vuelo"], 50).count() == 50
    cells = chartdata.heatmap_lower_triangle(flights, ["distancia_vuelo", "visibilidad", "ocupacion_vuelo"]).count()
    assert cells == 3


def test_balance_of_empty_table(spark):
    assert rates.class_balance(spark.createDataFrame([], "y int"), "y").collect() == []
