import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.functions import columns as fc
from ratewise.functions.stats import correlation_p_value, pearson
from ratewise.operators import roles


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_hours_from_text(spark):
    df = texts(spark, ["7", "07:05", "14:35:00", "24:10", "", None, "x9:30", "no"])
    assert column(df, fc.extract_hour("t")) == [7, 7, 14, 24, None, None, 9, None]
    assert column(df, fc.decimal_hour("t")) == pytest.approx([7.0, 7 + 5 / 60, 14 + 35 / 60, 24 + 10 / 60, None, None, 9.5, None])


def test_hour_of_timestamp(spark):
    df = spark.sql("SELECT timestamp'2026-03-04 09:30:00' AS t")
    assert df.select(fc.extract_hour_of(df, "t")).first()[0] == 9


def test_bands(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate([0, 1, 6, 7, 11, 12, 15, 16, 19, 20, 23, 24, None])], "i int, h int")
    assert column(df, fc.time_band_5("h")) == [
        "noche", "madrugada", "madrugada", "manana", "manana", "mediodia", "mediodia", "tarde", "tarde", "noche", "noche", "noche", None,
    ]
    assert column(df, fc.time_band_4("h")) == [
        "madrugada", "madrugada", "manana", "manana", "manana", "tarde", "tarde", "tarde", "noche", "noche", "noche", None, None,
    ]


def test_binary_indicator(spark):
    df = texts(spark, ["si", " Sí ", "DELAYED", "no", None, "1", "true", "demorado", "delay", "2"])
    assert column(df, fc.binary_indicator(df, "t")) == [1, 1, 1, 0, 0, 1, 1, 1, 1, 0]
    num = spark.createDataFrame([(0, 1.0, True), (1, 2.0, False), (2, None, None)], "i int, n double, b boolean")
    assert column(num, fc.binary_indicator(num, "n")) == [1, 0, 0]
    assert column(num, fc.binary_indicator(num, "b")) == [1, 0, 0]


def test_ratio_rate_zero_minutes(spark):
    df = spark.createDataFrame([(0, 100.0, 60.0), (1, 100.0, 0.0), (2, 0.0, 0.0), (3, 5.0, None)], "i int, d double, m double")
    assert column(df, fc.ratio_rate("d", "m")) == [100.0, None, None, None]
    got = column(df, fc.ratio_rate("d", "m", on_zero="inf"))
    assert got[:2] == [100.0, float("inf")] and np.isnan(got[2]) and got[3] is None


@pytest.mark.parametrize("bins", [3, 7, 10])
def test_equal_width_bins_match_pandas(spark, bins):
    rng = np.random.default_rng(bins)
    values = np.concatenate([np.linspace(0, 1, 41), rng.normal(0.4, 0.3, 200), [0.1, 0.2, 0.3, 0.7]])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    start, width = fc.bin_edges(values.min(), values.max(), bins)
    want = pd.cut(pd.Series(values), bins=bins, labels=False) + 1
    assert column(df, fc.right_closed_bin("v", start, width, bins)) == want.tolist()
    edges = start + np.arange(bins + 1) * width
    left = np.clip(np.searchsorted(edges, values, side="right"), 1, bins)
    assert column(df, fc.left_closed_bin("v", start, width, bins)) == left.tolist()


def test_pairs_and_labels(spark):
    df = spark.createDataFrame([(0, "B", "A"), (1, "A", "B"), (2, None, "A")], "i int, a string, b string")
    lo, hi = fc.pair_key("a", "b")
    assert column(df, F.concat(lo, hi)) == ["AB", "AB", "AA"]
    assert column(df, fc.same_pair("a", "b", "A", "B")) == [True, True, False]
    assert column(df, fc.label_map("b", {"A": "first"})) == ["first", None, "first"]


def test_p_values():
    # published correlations over 40 places
    assert correlation_p_value(0.084, 40) == pytest.approx(0.607, abs=2e-3)
    assert correlation_p_value(-0.047, 40) == pytest.approx(0.774, abs=2e-3)
    assert correlation_p_value(0.9, 5) == pytest.approx(0.0373861, abs=1e-6)
    assert correlation_p_value(None, 5) is None


def test_half_width(spark):
    df = spark.createDataFrame([(0, 0.324, 37)], "i int, p double, n int")
    assert column(df, fc.rate_half_width("p", "n") * 100)[0] == pytest.approx(15.08, abs=0.01)


def test_pearson_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert df.agg(pearson("a", "b")).first()[0] is None


def test_roles(flights):
    numeric, categorical, other = roles.classify_columns(flights, ["id_vuelo"])
    assert "demora" in numeric and "temporada_alta" in categorical and other == []
    stamped = flights.withColumn("cuando", F.current_timestamp())
    assert roles.classify_columns(stamped)[2] == ["cuando"]
    assert roles.place_columns(flights) == ["aeropuerto_origen", "aeropuerto_destino"]
    renamed = flights.select(F.col("aeropuerto_origen").alias("airport_origin"))
    assert roles.place_columns(renamed) == [] and roles.place_columns(renamed, names=roles.PLACE_NAMES_WIDE) == ["airport_origin"]
    assert roles.target_last(flights, "demora").columns[-1] == "demora"
    with pytest.raises(roles.MissingColumns):
        roles.require_columns(flights, "nada")
    assert len(roles.column_pairs(list("abcdef"))) == 15 and roles.column_pairs(list("abcdef"), 10) == [tuple(p) for p in ["ab", "ac", "ad", "ae", "af", "bc", "bd", "be", "bf", "cd"]]
