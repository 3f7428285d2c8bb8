import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import filters, prepare
from ratewise.operators.prepare import ViewSpec
from ratewise.plans import flows
from ratewise.sources import tables

DROP = ["id_vuelo", "hora_salida_programada", "dia_semana"]


def rules():
    return [
        ("velocidad_baja", filters.min_rate_rule("distancia_vuelo", "tiempo_estimado_vuelo")),
        ("eze_aep", filters.exclude_pair_rule("aeropuerto_origen", "aeropuerto_destino", "EZE", "AEP")),
    ]


def pandas_view(pdf):
    """The preparation, step by step, as plain pandas."""
    f = pdf[(pdf["distancia_vuelo"] / (pdf["tiempo_estimado_vuelo"] / 60)) >= 100]
    ends = f[["aeropuerto_origen", "aeropuerto_destino"]].apply(set, axis=1)
    f = f[ends != {"EZE", "AEP"}].copy()
    text = f["hora_salida_programada"].astype(str)
    hour = pd.to_numeric(text.str.extract(r"(\d{1,2})", expand=False), errors="coerce")
    minute = pd.to_numeric(text.str.extract(r"\d{1,2}:(\d{2})", expand=False), errors="coerce").fillna(0)
    band = pd.cut(hour, [-1, 0, 6, 11, 15, 19, 99], labels=["noche", "madrugada", "manana", "mediodia", "tarde", "noche"], ordered=False)
    f["franja_horaria"] = band.astype(object)
    f["timestamp_vuelo"] = hour + minute / 60
    f = f.drop(columns=DROP).drop_duplicates()
    numeric = [c for c in f.columns if c != "demora" and f[c].dtype.kind in "fi"]
    categorical = [c for c in f.columns if c not in numeric and c != "demora"]
    for c in numeric:
        f[c] = f[c].fillna(f[c].median())
        span = f[c].max() - f[c].min()
        f[c] = (f[c] - f[c].min()) / (span if span else 1.0)
    for c in categorical:
        f[c] = f[c].fillna(f[c].mode()[0])
    f["temporada_alta"] = f["temporada_alta"].astype(bool)
    return pd.get_dummies(f, columns=categorical, drop_first=True, dtype=int)


def test_build_view_matches_pandas(flights, flights_pd):
    spec = ViewSpec(target="demora", drop=DROP, rules=rules(), hour="hora_salida_programada")
    view, params = prepare.build_view(flights, spec)
    want = pandas_view(flights_pd)
    assert view.columns[-1] == "demora" and set(view.columns) == set(want.columns)
    got = view.toPandas()[want.columns]
    key = list(want.columns)
    a = got.round(9).sort_values(key).to_numpy(dtype=float)
    b = want.round(9).sort_values(key).to_numpy(dtype=float)
    assert a.shape == b.shape and np.allclose(a, b, atol=1e-8)
    assert params.rows == len(want) and params.nulls["visibilidad"] > 0
    assert (got[params.numeric].min().min(), got[params.numeric].max().max()) == (0.0, 1.0)
    assert set(got["constante"]) == {0.0}


def test_feature_count_of_full_flight_table(spark):
    """5 numeric + 39 + 39 + 4 + 2 + 11 + 1 = 101 features from the domains of the flight table."""
    codes = [f"A{i:02d}" for i in range(40)]
    rows = [
        (i, codes[i % 40], codes[(i + 1) % 40], f"{i % 24:02d}:15", str(i % 7), float(i), float(i % 90), i % 30, float(i % 50),
         float(i % 300), "DNLTX"[i % 5], "AMB"[i % 3], f"t{i % 12}", i % 2 == 0, i % 3 == 0)
        for i in range(480)
    ]
    df = spark.createDataFrame([r[:-1] + (int(r[-1]),) for r in rows], tables.FLIGHT_SCHEMA)
    _, p = prepare.build_view(df, ViewSpec(target="demora", drop=DROP))
    assert len(p.feature_names()) == 101
    _, p = prepare.build_view(df, ViewSpec(target="demora", drop=DROP + ["puerta_embarque"], hour="hora_salida_programada"))
    assert len(p.feature_names()) == 100 + 4 + 1


def test_nulls_give_zero_indicators(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    got = prepare.one_hot_drop_first(df, ["k"]).collect()
    assert [tuple(r) for r in got] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    with pytest.raises(ValueError):
        prepare.one_hot_drop_first(df, ["k"], limit=2)


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",), ("c",)], "k string")
    assert prepare.modes(df, ["k"]).first()["mode"] == "a"
    assert prepare.impute_mode(df, ["k"]).filter("k IS NULL").count() == 0


def test_apply_view_to_unseen_rows(spark, flights):
    spec = ViewSpec(target="demora", drop=DROP, deduplicate=False)
    params = prepare.fit_view(prepare.derive(flights.filter("id_vuelo <= 400"), spec), spec)
    restored = prepare.params_from_table(prepare.params_table(flights, params), flights.columns)
    assert restored.feature_names() == params.feature_names() and restored.median == params.median
    unseen = flights.filter("id_vuelo > 400")
    a = prepare.apply_view(unseen, spec, params, keep=["id_vuelo"])
    b = prepare.apply_view(unseen, spec, restored, keep=["id_vuelo"])
    assert a.columns[0] == "id_vuelo" and a.count() == unseen.count()
    assert a.exceptAll(b).count() == 0


def test_view_files_and_metadata(spark, flights, tmp_path):
    root = str(tmp_path)
    assert tables.next_view_id(spark, root) == "001"
    spec = ViewSpec(target="demora", drop=DROP, rules=rules())
    first, params = flows.publish_view(flights, spec, root, row_id="row_id")
    second, _ = flows.publish_view(flights, ViewSpec(target="demora", drop=DROP + ["visibilidad"]), root)
    assert (first, second) == ("001", "002") and tables.next_view_id(spark, root) == "003"
    view = tables.load_view(spark, root, first)
    assert view.columns[-1] == "demora" and view.select("row_id").distinct().count() == view.count()
    registry = {r["view_id"]: r for r in tables.view_registry(spark, root).collect()}
    assert registry["001"]["rows"] == view.count() and registry["001"]["features"] == len(params.feature_names())
    meta = {(r["item"], r["name"]): r["number"] for r in tables.load_metadata(spark, root, first).collect()}
    assert meta["class", "0"] + meta["class", "1"] == view.count()
    assert meta["filter", "rows_after"] + meta["filter", "rows_removed"] == flights.count()
    assert meta["imputed", "visibilidad"] > 0


def test_csv_view_and_summary(spark, flights, tmp_path):
    small = flights.groupBy("tipo_avion").agg(F.count("*").alias("n"))
    path = tables.write_summary(small, f"{tmp_path}/s")
    assert tables.load_table(spark, path, "csv", small.schema).exceptAll(small).count() == 0
    with pytest.raises(ValueError):
        tables.load_table(spark, path, "csv")
    view = flights.select("demora", "distancia_vuelo")
    tables.write_view(view, str(tmp_path), "007", "demora", fmt="csv")
    back = tables.load_view(spark, str(tmp_path), "007", "csv", view.select("distancia_vuelo", "demora").schema)
    assert back.columns == ["distancia_vuelo", "demora"] and back.count() == view.count()


def test_vector_encoding_of_many_categories(spark):
    rows = spark.range(1200).selectExpr("id", "CASE WHEN id % 7 > 0 THEN concat('c', id % 1000) END AS k", "'one' AS same")
    out, labels = prepare.one_hot_vector(rows, ["k", "same"])
    names = {r["position"]: (r["column"], r["value"]) for r in labels.collect()}
    source = {r["id"]: r["k"] for r in rows.collect()}
    values = sorted({v for v in source.values() if v is not None})
    assert sorted(v for _, v in names.values()) == values[1:] and out.columns == ["id", "encoded"]
    for r in out.collect():
        want = [source[r["id"]]] if source[r["id"]] in values[1:] else []
        assert [names[int(i)][1] for i in r["encoded"].indices] == want


def test_vector_encoding_without_categories(spark):
    out, labels = prepare.one_hot_vector(spark.range(2).selectExpr("id", "cast(null AS string) AS k"), ["k"])
    assert labels.count() == 0 and [r["encoded"].size for r in out.collect()] == [0, 0]


def test_left_over_folders_and_claims_keep_their_numbers(spark, tmp_path):
    root = str(tmp_path)
    spark.range(1).write.parquet(tables.view_path(root, "004"))
    assert tables.claim_view_id(spark, root) == "005"
    assert tables.claim_view_id(spark, root) == "006"
