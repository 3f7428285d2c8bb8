"""NaN counts as missing; defaults drop nothing; shares are rounded once; repeated results replace each other."""

import math

from pyspark.sql import functions as F

from ratewise.operators import chartdata, filters, prepare, profile, rates, relations, trees
from ratewise.sources import models


def with_nan(spark):
    return spark.createDataFrame([(float(i),) for i in range(100)] + [(math.nan,), (None,)], "x double")


def test_nan_is_missing(spark):
    df = with_nan(spark)
    assert profile.zscore_outliers(df, ["x"]).first()["outliers"] == 0
    assert profile.iqr_outliers(df, ["x"]).first()["outliers"] == 0
    assert profile.null_report(df).first()["nulls"] == 2
    scaled = [r["x"] for r in prepare.min_max_scale(df, ["x"]).collect()]
    assert scaled.count(None) == 2 and max(v for v in scaled if v is not None) == 1.0
    assert chartdata.histogram_bins(df, "x", 10).agg(F.sum("rows")).first()[0] == 100


def test_nan_is_missing_in_every_numeric_operator(spark):
    rows = [(i, float(i), float(2 * i + 1), "a" if i % 2 else "b", i % 2) for i in range(100)]
    schema = "id long, x double, m double, k string, y int"
    clean = spark.createDataFrame(rows + [(100, None, 3.0, "a", 1), (101, 5.0, None, "b", 0)], schema)
    dirty = spark.createDataFrame(rows + [(100, math.nan, 3.0, "a", 1), (101, 5.0, math.nan, "b", 0)], schema)
    spec = prepare.ViewSpec(target="y", drop=["id"])
    checks = {
        "skewness": lambda d: profile.skewness_flag(d, ["x", "m"]),
        "kurtosis": lambda d: profile.kurtosis_flag(d, ["x", "m"]),
        "describe": profile.describe_schema,
        "describe sketched": lambda d: profile.describe_schema(d, approximate=True),
        "cells": profile.table_nulls,
        "nulls": profile.null_report,
        "dominant": lambda d: profile.dominant_value(d.withColumn("x", F.when(F.col("id") < 60, F.lit(1.0)).otherwise(F.col("x"))), ["x"]),
        "summary": lambda d: profile.numeric_summary(d, ["x", "m"], ["k"]),
        "entity mean": lambda d: rates.entity_mean_topn(d, ["k"], "x"),
        "types": lambda d: rates.rate_stats_by_type(d, "k", "x", "m"),
        "type spread": lambda d: rates.type_mean_spread(d, "k", "x", "m"),
        "correlation": lambda d: relations.row_correlation(d, "x", "m"),
        "class means": lambda d: rates.mean_by_class(d, "x", "y"),
        "range": lambda d: filters.domain_range_check(d, "x", 2.0, 50.0),
        "median": lambda d: prepare.impute_median(d, ["x", "m"]),
        "view": lambda d: prepare.build_view(d, spec)[0],
        "unseen": lambda d: prepare.apply_view(d, spec, prepare.fit_view(prepare.derive(d, spec), spec)),
        "duplicates": lambda d: profile.duplicate_count(d.unionByName(d), ["id"]),
        "examples": lambda d: profile.duplicate_examples(d.unionByName(d), [], 500),
        "scatter": lambda d: chartdata.scatter_pairs(d, ["x", "m"], ["id"], 500),
    }
    for name, check in checks.items():
        want, got = (sorted(map(repr, check(d).collect())) for d in (clean, dirty))
        assert want == got and want, name
        assert not any("nan" in r.lower() for r in got), name
    view, _ = prepare.build_view(dirty, spec)
    assert trees.assemble(view, ["x", "m"], "y").count() and view.filter("x IS NULL OR isnan(x)").count() == 0


def test_one_far_value(spark):
    df = spark.createDataFrame([(i / 1000,) for i in range(1000)] + [(1e15,)], "x double")
    got = chartdata.histogram_bins(df, "x").collect()
    assert sum(r["rows"] for r in got) == 1001 and max(r["bin"] for r in got) > 1 << 31


def test_pairs_are_sampled_among_the_rows_that_know_both(spark):
    df = spark.range(50_000).select("id", F.when(F.col("id") % 100 == 0, F.rand(1)).alias("x"), F.rand(2).alias("z"), F.lit(None).cast("double").alias("w"))
    got = {(r["x_name"], r["y_name"]): r["count"] for r in chartdata.scatter_pairs(df, ["x", "z", "w"], ["id"], 1000).groupBy("x_name", "y_name").count().collect()}
    assert got == {("x", "z"): 500}


def test_fingerprints_tell_missing_values_apart_by_their_place(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), (None, None, math.nan), (None, None, None), ("a", "a", 1.0), ("a", "a", 1.0)]
    df = spark.createDataFrame(rows, "p string, q string, r double").repartition(3)
    got = profile.duplicate_count(df).first()
    assert (got["rows"], got["duplicates"]) == (7, 3)
    assert [r["copies"] for r in profile.duplicate_examples(df, [], 10).collect()] == [2] * 6
    wide = spark.createDataFrame([tuple(None if j == i else 1 for j in range(130)) for i in range(130)], ", ".join(f"c{j} int" for j in range(130)))
    assert profile.duplicate_count(wide).first()["duplicates"] == 0
    assert profile.duplicate_count(df.limit(0)).first()["rows"] == 0
    ids = profile.id_uniqueness(spark.createDataFrame([(1,), (None,)], "id long"), "id").first()
    assert (ids["distinct_ids"], ids["rows"], ids["unique"]) == (1, 2, False)


def test_distinct_counts_and_duplicates_shuffle_fingerprints_only(spark):
    df = spark.createDataFrame([("x" * 50, 1.0, None), ("y", 1.0, "t"), ("y", None, "t")], "a string, b double, c string").repartition(2)
    got = {r["column"]: (r["non_null"], r["nulls"], r["distinct"]) for r in profile.describe_schema(df).collect()}
    assert got == {"a": (3, 0, 2), "b": (2, 1, 1), "c": (2, 1, 1)}
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan(profile.describe_schema(df))
    duplicates = plan(profile.duplicate_count(df, ["c"]))
    assert "hashpartitioning(kind" in duplicates and "hashpartitioning(a#" not in duplicates.replace("hashpartitioning(kind", "")


def test_defaults_keep_everything(spark):
    df = spark.range(300).select((F.col("id") % 30).cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    out = rates.rate_by_category_all(df, ["c"], "y").collect()
    assert len(out) == 30 and out[0]["categories"] == 30 and not out[0]["drawable"]
    wide = spark.range(50).select("id", *[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(12)])
    assert chartdata.scatter_pairs(wide, [f"c{i}" for i in range(12)], ["id"], 50).select("x_name", "y_name").distinct().count() == 66
    far = spark.createDataFrame([(float(i % 7),) for i in range(1000)] + [(1e5,)], "x double")
    assert chartdata.auto_bins(far, "x") > 2000


def test_shares_are_rounded_once(spark):
    df = spark.range(1_000_000).select(F.when(F.col("id") < 124_460, "a").otherwise("b").alias("c"))
    assert {r["value"]: r["pct"] for r in chartdata.bar_counts_pct(df, ["c"]).collect()} == {"a": 12.4, "b": 87.6}


def test_second_result_replaces_the_first(spark, tmp_path):
    for value in (0.5, 0.75):
        models.save_metrics(spark.createDataFrame([("knn", "001", "002", "accuracy", value)], models.METRIC_SCHEMA), str(tmp_path))
    models.save_metrics(spark.createDataFrame([("knn", "002", "002", "accuracy", 0.1)], models.METRIC_SCHEMA), str(tmp_path))
    stored = models.load_metrics(spark, str(tmp_path))
    assert {(r["model_id"], r["value"]) for r in stored.collect()} == {("001", 0.75), ("002", 0.1)}
    assert models.metrics_json(stored).count() == 2


def test_correlations_of_many_columns_with_gaps(spark):
    import numpy as np
    import pandas as pd

    from ratewise.operators import relations

    draw = np.random.default_rng(4)
    wide = draw.normal(size=(400, 100)) @ (np.eye(100) + 0.2 * draw.normal(size=(100, 100)))
    wide[:, 3] += 1e9
    wide[:, 7] = 0.1
    wide[::3, 10], wide[1::4, 20], wide[:, 30] = np.nan, np.nan, np.nan
    wide[:200, 40], wide[200:, 41] = np.nan, np.nan  # no row knows both
    wide[50:, 50], wide[:50, 51] = np.nan, 2.5  # constant where the other is known
    names = [f"c {i}" for i in range(100)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(wide)], ", ".join(f"`{c}` double" for c in names)).repartition(5)
    out = relations.correlation_matrix(df, names)
    assert "Generate" not in relations.correlation_pairs(df, names)._jdf.queryExecution().optimizedPlan().toString()
    got = out.toPandas().pivot(index="x", columns="y", values="r").loc[names, names].to_numpy(dtype=float)
    want = pd.DataFrame(wide).corr(min_periods=2).to_numpy(copy=True)
    want[[7, 51, 50], [7, 50, 51]] = np.nan
    np.fill_diagonal(want, 1.0)
    want[7, np.arange(100) != 7] = want[np.arange(100) != 7, 7] = np.nan
    assert np.allclose(got, want, atol=2e-6, equal_nan=True)
    empty = relations.correlation_matrix(df.limit(0), names[:3]).toPandas()
    assert len(empty) == 9 and empty["r"].notna().sum() == 3


def test_report_as_one_table(spark):
    import json

    from ratewise.plans import flows

    a = spark.createDataFrame([(1, None), (2, "x")], "n int, c string")
    got = {(r["part"], r["row"]) for r in flows.eda_table({"a": a, "b": a.select("n")}).collect()}
    assert {(p, tuple(json.loads(r).items())) for p, r in got} == {("a", (("n", 1), ("c", None))), ("a", (("n", 2), ("c", "x"))), ("b", (("n", 1),)), ("b", (("n", 2),))}
