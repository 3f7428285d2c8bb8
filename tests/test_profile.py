import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import filters, profile
from ratewise.operators.quantiles import cumulative_counts, exact_quantiles, quantile_row, with_sort_key

NUM = ["distancia_vuelo", "ocupacion_vuelo", "visibilidad", "tiempo_estimado_vuelo", "constante"]


def by_column(df):
    return df.toPandas().set_index("column")


def test_numeric_summary_matches_pandas(flights, flights_pd):
    got = by_column(profile.numeric_summary(flights, NUM))
    want = flights_pd[NUM].describe().T
    for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q1": "25%", "median": "50%", "q3": "75%", "max": "max"}.items():
        assert np.allclose(got.loc[NUM, ours], want.loc[NUM, theirs], atol=0.0051), ours


def test_numeric_summary_by_group(flights, flights_pd):
    got = profile.numeric_summary(flights, ["visibilidad"], ["tipo_avion"]).toPandas().set_index("tipo_avion")
    want = flights_pd.groupby("tipo_avion")["visibilidad"].describe()
    assert np.allclose(got.loc[want.index, "median"], want["50%"], atol=0.0051)


def test_shape_matches_pandas(flights, flights_pd):
    cols = NUM[:-1]
    got = by_column(profile.shape_flags(flights, NUM))
    assert np.allclose(got.loc[cols, "skewness"], flights_pd[cols].skew(), atol=1e-6)
    assert np.allclose(got.loc[cols, "kurtosis"], flights_pd[cols].kurtosis(), atol=1e-6)
    assert pd.isna(got.loc["constante", "skewness"]) and not got.loc["constante", "heavy_tails"]


def test_outliers_match_pandas(flights, flights_pd):
    got = by_column(profile.iqr_outliers(flights, NUM))
    non_null = by_column(profile.iqr_outliers(flights, NUM, pct_base="non_null"))
    z = by_column(profile.zscore_outliers(flights, NUM))
    for c in NUM:
        s = flights_pd[c]
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        out = ((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).sum()
        assert got.loc[c, "outliers"] == out
        assert got.loc[c, "pct"] == pytest.approx(out / len(s) * 100, abs=1e-4)
        assert non_null.loc[c, "pct"] == pytest.approx(out / s.notna().sum() * 100, abs=1e-4)
        v = s.dropna()
        far = (np.abs((v - v.mean()) / v.std(ddof=0)) > 3).sum() if v.std(ddof=0) > 0 else 0
        assert z.loc[c, "outliers"] == far


def test_duplicates_and_ids(flights, flights_pd):
    assert profile.duplicate_count(flights).first()["duplicates"] == 0
    assert profile.duplicate_count(flights, ["id_vuelo"]).first()["duplicates"] == 2
    assert profile.id_uniqueness(flights, "id_vuelo").first()["unique"]
    examples = profile.duplicate_examples(flights, ["id_vuelo"]).collect()
    assert [r["copy"] for r in examples] == [1, 2, 3] and examples[0]["copies"] == 3


def test_nulls_and_schema(flights, flights_pd):
    nulls = by_column(profile.null_report(flights))
    assert nulls["nulls"].to_dict() == flights_pd.isna().sum().to_dict()
    schema = by_column(profile.describe_schema(flights))
    assert schema["distinct"].to_dict() == flights_pd.nunique().to_dict()
    assert profile.table_nulls(flights).first()["null_cells"] == flights_pd.isna().sum().sum()


def test_dominant_value(spark):
    rows = [(1.0, float(i), None if i % 2 else 3.0) for i in range(30)] + [(2.0, 100.0 + i, 4.0 + i) for i in range(70)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {r["column"]: r for r in profile.dominant_value(df, ["a", "b", "c"]).collect()}
    assert set(got) == {"a"} and got["a"]["value"] == 2.0 and got["a"]["pct"] == 70.0
    # a value just above the share is found wherever it lies in the order
    for at in (-5.0, 37.5, 1000.0):
        df = spark.createDataFrame([(float(i),) for i in range(74)] + [(at,)] * 26, "v double")
        assert profile.dominant_value(df, ["v"]).first()["value"] == at


def test_categories(flights, flights_pd):
    got = profile.category_proportions(flights, ["condiciones_climaticas", "temporada_alta"]).toPandas()
    counts = flights_pd["condiciones_climaticas"].value_counts()
    weather = got[got["column"] == "condiciones_climaticas"].set_index("value")
    assert weather["rows"].to_dict() == counts.to_dict()
    assert weather.loc["Lluvia", "pct_of_rows"] == pytest.approx(counts["Lluvia"] / len(flights_pd) * 100, abs=0.006)
    assert set(got[got["column"] == "temporada_alta"]["value"]) == {"True", "False"}
    summary = by_column(profile.category_summary(flights, ["tipo_avion", "aeropuerto_origen"], many=3))
    assert not summary.loc["tipo_avion", "high_cardinality"] and summary.loc["aeropuerto_origen", "high_cardinality"]
    assert summary.loc["aeropuerto_origen", "top_value"] == flights_pd["aeropuerto_origen"].mode()[0]


@pytest.mark.parametrize("seed", [2000, 10**6])
@pytest.mark.parametrize("partitions", [1, 5])
def test_quantiles_exact_with_hot_value(spark, seed, partitions):
    """A third of the rows share one value; nulls and NaN are ignored."""
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(0, 1, 2000), np.full(1000, 0.25), rng.exponential(50, 500)])
    rows = [(float(v), float(i)) for i, v in enumerate(values)] + [(None, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(partitions)
    qs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["q"]): r["value"] for r in exact_quantiles(df, ["a", "b"], qs).collect()}
    b = np.append(np.arange(len(values), dtype=float), 1.0)
    for q in qs:
        assert got["a", q] == pytest.approx(np.quantile(values, q), abs=1e-9)
        assert got["b", q] == pytest.approx(np.quantile(b, q), abs=1e-9)


def test_quantiles_by_group_mixed_sizes(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": ["big"] * 9000 + ["small"] * 7, "v": rng.normal(10, 3, 9007)})
    df = spark.createDataFrame(pdf).repartition(3)
    got = quantile_row(df, ["v"], {"m": 0.5, "p": 0.9}, ["g"], moments=True).toPandas().set_index("g")
    for g, s in pdf.groupby("g")["v"]:
        assert got.loc[g, "m"] == pytest.approx(s.quantile(0.5)) and got.loc[g, "p"] == pytest.approx(s.quantile(0.9))
        assert got.loc[g, "count"] == len(s)
        assert got.loc[g, "mean"] == pytest.approx(s.mean()) and got.loc[g, "std"] == pytest.approx(s.std())


def test_quantiles_narrowed_twice(spark):
    """Distinct values in shuffled order, so the answer is known; a tenth of the rows is one hot value."""
    df = spark.range(900_000).selectExpr("cast((id * 7919) % 900000 AS double) AS v")
    df = df.unionByName(spark.range(100_000).selectExpr("cast(450000.5 AS double) AS v")).repartition(4)
    qs = [0.001, 0.25, 0.44999, 0.5, 0.55001, 0.9]
    got = {r["q"]: r["value"] for r in exact_quantiles(df, ["v"], qs).collect()}
    values = np.sort(np.append(np.arange(900_000.0), np.full(100_000, 450000.5)))
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(values, q), abs=1e-6)


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002, 0.9999999999999999, -1.0, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 3.0, 0.1, 1e15, 1 / 3]


def test_sort_keys_are_the_bits_of_the_double(spark):
    rng = np.random.default_rng(3)
    values = EXTREMES + [2.0**e for e in range(-1074, 1024)] + [float(np.nextafter(2.0**e, 0)) for e in range(-1022, 1024)] + rng.integers(0, 2047 << 52, 3000).view(np.float64).tolist()
    rows = with_sort_key(spark.createDataFrame([(v,) for v in values], "value double")).collect()
    for r in rows:
        bits = int(np.array(abs(r["value"])).view(np.int64))
        assert r["key"] == (-bits if r["value"] < 0 else bits)


def test_quantiles_of_extreme_values_and_null_groups(spark):
    df = spark.createDataFrame([(None if i % 2 else "g", v) for v in EXTREMES for i in range(3)], "g string, v double").repartition(3)
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], ["g"]).collect()}
    for g, times in ((None, 1), ("g", 2)):
        values = np.sort(np.repeat(EXTREMES, times))
        with np.errstate(invalid="ignore"):
            assert all(got[g, q] == np.quantile(values, q) for q in (0.25, 0.5)) and got[g, 0.0] == -np.inf and got[g, 1.0] == np.inf


def test_quantile_rounds_do_not_follow_the_data(spark):
    """Five rounds at most, each a bounded number of jobs; one value, or whole numbers, take fewer."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(df):
        group = f"quantiles-{id(df)}"
        sc.setJobGroup(group, "")
        exact_quantiles(df, ["v"], [0.1, 0.5, 0.9])
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    few = jobs(spark.range(500).selectExpr("cast(id % 3 AS double) AS v"))
    many = jobs(spark.range(200_000).selectExpr("rand(1) AS v"))
    more = jobs(spark.range(50).selectExpr("rand(1) AS v"))
    assert few < more <= many <= 45


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]).collect() == []


def test_cumulative_counts_over_buckets(spark):
    df = spark.range(1000).selectExpr("cast(id * id as double) AS k", "id % 7 AS m").repartition(5)
    small = {r["k"]: r["before_m"] for r in cumulative_counts(df, "k", ["m"]).collect()}
    large = {r["k"]: r["before_m"] for r in cumulative_counts(df, "k", ["m"], buckets=16).collect()}
    want, total = {}, 0
    for i in range(1000):
        want[float(i * i)], total = total, total + i % 7
    assert small == want and large == want


def test_filters(flights, flights_pd):
    d, t = flights_pd["distancia_vuelo"], flights_pd["tiempo_estimado_vuelo"]
    keep = (d / (t / 60)) >= 100  # inf is kept, missing is removed
    pair = flights_pd["aeropuerto_origen"].isin(["EZE"]) & flights_pd["aeropuerto_destino"].isin(["AEP"])
    pair |= flights_pd["aeropuerto_origen"].isin(["AEP"]) & flights_pd["aeropuerto_destino"].isin(["EZE"])
    rules = [
        ("velocidad_baja", filters.min_rate_rule("distancia_vuelo", "tiempo_estimado_vuelo")),
        ("eze_aep", filters.exclude_pair_rule("aeropuerto_origen", "aeropuerto_destino", "EZE", "AEP")),
    ]
    report = {r["item"]: r["rows"] for r in filters.filter_report(flights, rules).collect()}
    assert report == {
        "velocidad_baja": (~keep).sum(),
        "eze_aep": pair.sum(),
        "rows_before": len(flights_pd),
        "rows_removed": (~keep | pair).sum(),
        "rows_after": (keep & ~pair).sum(),
    }
    assert filters.apply_rules(flights, rules).count() == report["rows_after"]


def test_domain_checks(flights, flights_pd):
    r = filters.domain_range_check(flights, "ocupacion_vuelo").first()
    assert (r["above"], r["below"], r["at_lower"]) == (1, 1, 1)
    speed = flights_pd["distancia_vuelo"] / flights_pd["tiempo_estimado_vuelo"] * 60
    band = filters.rate_band_check(flights, "distancia_vuelo", "tiempo_estimado_vuelo").first()
    assert (band["too_slow"], band["too_fast"]) == ((speed < 150).sum(), (speed > 950).sum())
    assert filters.self_pair_check(flights, "aeropuerto_origen", "aeropuerto_destino").first()["hits"] == 1
    hits = filters.pair_set_check(flights, "aeropuerto_origen", "aeropuerto_destino", ["EZE", "AEP"]).first()["hits"]
    both = flights_pd["aeropuerto_origen"].isin(["EZE", "AEP"]) & flights_pd["aeropuerto_destino"].isin(["EZE", "AEP"])
    assert hits == (both & (flights_pd["aeropuerto_origen"] != flights_pd["aeropuerto_destino"])).sum()
