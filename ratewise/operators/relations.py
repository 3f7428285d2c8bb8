"""Correlations and verdicts built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.stats import pearson, rate_pct
from ratewise.operators.onepass import OnePass, run


def row_correlation_pass(x: str, y: str, digits: int = 6) -> OnePass:
    return OnePass({"r": F.round(pearson(x, y), digits)}, lambda flat: flat)


def row_correlation(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    return run(df, row_correlation_pass(x, y, digits))


def group_correlation(table: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """Pearson r between two columns of an aggregated table (not the row-level number)."""
    return table.agg(F.round(pearson(x, y), digits).alias("r"))


#: A spread below this part of the mean, or a sum of squares that cancels to this part, is rounding noise: the
#: column counts as constant.
NOISE = 1e-13


def batch_products(x: np.ndarray) -> np.ndarray:
    """(6, d, d) of a batch of rows: n, mean of a, mean of b, centred aa, bb and ab of every pair of columns, each
    over the rows that know both."""
    known = ~np.isnan(x)
    m = known.astype(float)
    shift = np.where(known, x, 0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    z = np.where(known, x - shift, 0)
    n = m.T @ m
    own, squares = z.T @ m, (z * z).T @ m
    some = np.maximum(n, 1)
    aa = squares - own * own / some
    aa[aa <= NOISE * squares] = 0
    mean = shift[:, None] + own / some
    return np.stack([n, mean, mean.T, aa, aa.T, z.T @ z - own * own.T / some])


def merged_products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The products of two sets of rows together."""
    n = np.maximum(p[0] + q[0], 1)
    a, b, w = q[1] - p[1], q[2] - p[2], p[0] * q[0] / n
    means = [(p[0] * p[k] + q[0] * q[k]) / n for k in (1, 2)]
    return np.stack([p[0] + q[0], *means, p[3] + q[3] + w * a * a, p[4] + q[4] + w * b * b, p[5] + q[5] + w * a * b])


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    """(x, y, r) for the given pairs, each over the rows that know both (null and NaN are unknown). Every task
    folds its rows by matrix products over batches and sends one row per pair. Constant columns and
    columns with infinite values have a null r."""
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "x string, y string, r double")
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = [[cols.index(pair[k]) for pair in pairs] for k in (0, 1)]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros((6, len(cols), len(cols)))
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    done = merged_products(done, batch_products(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])))
        found = done[:, at[0], at[1]]
        some = np.flatnonzero(found[0] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(v[some]) for v in found)], names=["pair", "n", "ma", "mb", "aa", "bb", "ab"])

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        fold, "pair int, n double, ma double, mb double, aa double, bb double, ab double"
    )
    tasks = Window.partitionBy("pair")  # one row per task
    parts = parts.select("*", F.min("ma").over(tasks).alias("low_a"), F.min("mb").over(tasks).alias("low_b"))
    n, a, b = F.col("n"), F.col("ma") - F.col("low_a"), F.col("mb") - F.col("low_b")
    sums = parts.groupBy("pair").agg(
        F.sum("n").alias("n"), F.first("low_a").alias("low_a"), F.first("low_b").alias("low_b"), F.sum(n * a).alias("a"), F.sum(n * b).alias("b"),
        F.sum(F.col("aa") + n * a * a).alias("aa"), F.sum(F.col("bb") + n * b * b).alias("bb"), F.sum(F.col("ab") + n * a * b).alias("ab"),
    )

    def spread(k: str) -> Column:
        mean, deviation = F.col(f"low_{k}") + F.col(k) / n, F.sqrt(F.greatest(F.col(k + k) - F.col(k) * F.col(k) / n, F.lit(0.0)) / n)
        return F.when(deviation > NOISE * F.abs(mean), deviation)

    r = (F.col("ab") / n - (F.col("a") / n) * (F.col("b") / n)) / (spread("a") * spread("b"))
    table = sums.select("pair", F.round(F.when(~F.isnan(r), r), digits).alias("r"))
    names = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, x string, y string")
    return names.join(table, "pair", "left").select("x", "y", "r")


def correlation_pairs(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    return pair_correlations(df, list(combinations(cols, 2)), digits)


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Full symmetric matrix in long form, ones on the diagonal."""
    upper = correlation_pairs(df, cols, digits)
    cells = F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    mirrored = upper.select(F.inline(cells))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "x string, y string, r double")
    return mirrored.unionByName(diagonal)


def target_correlation_ranking(df: DataFrame, cols: Sequence[str], y: str, digits: int = 6) -> DataFrame:
    """Correlation of every column with the outcome, strongest first, with strength and drop advice."""
    return target_ranking_of(pair_correlations(df, [(c, y) for c in cols], digits), y)


def target_ranking_of(pairs: DataFrame, y: str) -> DataFrame:
    """The same from a table of pair correlations."""
    size = F.abs("r")
    return (
        pairs.filter((F.col("x") == y) | (F.col("y") == y))
        .select(F.when(F.col("x") == y, F.col("y")).otherwise(F.col("x")).alias("column"), "r")
        .select(
            "column",
            "r",
            F.when(size > 0.3, "strong").when(size > 0.1, "weak").otherwise("none").alias("strength"),
            F.coalesce(size < 0.05, F.lit(False)).alias("drop_candidate"),
        )
        .orderBy(F.abs("r").desc_nulls_last(), "column")
    )


def collinear_pairs(df: DataFrame, cols: Sequence[str], limit: float = 0.7) -> DataFrame:
    return correlation_pairs(df, cols).filter(F.abs("r") > limit)


def hour_verdict(df: DataFrame, hour: str, y: str, r_limit: float = 0.05, range_limit: float = 15.0) -> DataFrame:
    """Whether the hour carries signal. Rows, positives and the sums behind Pearson's r are all sums over
    hours, so one aggregation by hour gives the rate table and the row-level correlation."""
    h = F.col(hour).cast("double")
    hourly = (
        df.filter(F.col(hour).between(0, 23) & F.col(y).isNotNull())
        .groupBy(h.alias("h"))
        .agg(F.count("*").cast("double").alias("n"), F.sum(y).cast("double").alias("p"), rate_pct(y, None).alias("rate"))
    )
    n, p = F.sum("n"), F.sum("p")
    sh, shh, shp = F.sum(F.col("h") * F.col("n")), F.sum(F.col("h") * F.col("h") * F.col("n")), F.sum(F.col("h") * F.col("p"))
    r = F.try_divide(n * shp - sh * p, F.sqrt((n * shh - sh * sh) * (n * p - p * p)))
    flat = (F.abs("_r") < r_limit) & (F.col("_range") < range_limit)
    table = hourly.agg(
        r.alias("_r"),
        (F.max("rate") - F.min("rate")).alias("_range"),
        n.cast("long").alias("rows"),
        F.round(F.try_divide(p * 100, n), 4).alias("rate_pct"),
        F.round(r, 6).alias("r"),
        F.round(F.min("rate"), 4).alias("min_rate"),
        F.round(F.max("rate"), 4).alias("max_rate"),
        F.round(F.max("rate") - F.min("rate"), 4).alias("range_pp"),
        F.round(F.stddev_samp("rate"), 4).alias("std_pp"),
    )
    return table.withColumn("verdict", F.when(flat, "no signal").otherwise("some variation")).drop("_r", "_range")
