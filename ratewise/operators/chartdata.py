"""The tables behind the charts. Each is bounded by bins, grid points, groups or a sample size."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.columns import bin_edges, known_number, left_closed_bin, shuffle_key
from ratewise.operators.prepare import min_max_scale
from ratewise.operators.quantiles import quantile_row
from ratewise.operators.rates import class_balance, rate_contribution_long
from ratewise.operators.relations import correlation_pairs
from ratewise.operators.reshape import melt_numeric, value_counts
from ratewise.operators.roles import column_pairs
from ratewise.operators.sampling import hash_sample
from ratewise.sources.scratch import stage


def _ends(df: DataFrame, c: str) -> tuple[float, float, int, float]:
    x = known_number(c)
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("s")).first()
    return r["lo"], r["hi"], r["n"], r["s"]


def auto_bins(df: DataFrame, c: str) -> int:
    """Freedman-Diaconis or Sturges, whichever gives more bins."""
    return auto_bins_of(df, [c])[c]


def auto_bins_of(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """The same for several columns, which share the scans."""
    if not cols:
        return {}
    x = [known_number(c) for c in cols]
    ends = df.agg(*[f(c) for c in x for f in (F.min, F.max, F.count)]).first()
    ends = {c: ends[3 * i : 3 * i + 3] for i, c in enumerate(cols)}
    wide = [c for c, (lo, hi, n) in ends.items() if n and lo != hi]
    quartiles = {r["column"]: r for r in quantile_row(df, wide, {"q1": 0.25, "q3": 0.75}).collect()} if wide else {}  # one row per column
    bins = {c: 1 for c in cols}
    for c in wide:
        lo, hi, n = ends[c]
        width = 2 * (quartiles[c]["q3"] - quartiles[c]["q1"]) / n ** (1 / 3)
        sturges = math.ceil(math.log2(n) + 1)
        diaconis = math.ceil((hi - lo) / width) if width > 0 else 1
        bins[c] = max(sturges, diaconis)
    return bins


def histogram_bins(df: DataFrame, c: str, bins: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal left-closed bins over the whole range, optionally per group; empty bins do not appear."""
    lo, hi, n, _ = _ends(df, c)
    if not n:
        keys = "".join(f"`{b}` string, " for b in by)
        return df.sparkSession.createDataFrame([], f"{keys}bin int, lo double, hi double, rows bigint")
    bins = bins or auto_bins(df, c)
    start, width = bin_edges(lo, hi, bins)
    return (
        df.select(*by, left_closed_bin(known_number(c), start, width, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("rows"))
        .select(
            *by,
            "bin",
            F.round(F.lit(start) + (F.col("bin") - 1) * F.lit(width), 6).alias("lo"),
            F.round(F.lit(start) + F.col("bin") * F.lit(width), 6).alias("hi"),
            "rows",
        )
    )


def density_curve(df: DataFrame, c: str, points: int = 200, digits: int = 9) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid from min to max. A batch's
    repeated values fold into one; each task sums its weighted kernels onto the grid, so only grid-sized partial
    sums leave it."""
    lo, hi, n, s = _ends(df, c)
    if not n or not s:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = s * n ** (-0.2)
    grid = np.linspace(lo, hi, points)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(points)
        for batch in batches:
            x, weight = np.unique(batch["x"].to_numpy(), return_counts=True)
            for start in range(0, len(x), 4096):
                z = (grid[None, :] - x[start : start + 4096, None]) / width
                total += weight[start : start + 4096] @ np.exp(-0.5 * z * z)
        yield pd.DataFrame({"point": np.arange(points, dtype="int32"), "part": total})

    values = df.select(known_number(c).alias("x")).dropna()
    scale = 1.0 / (n * width * math.sqrt(2 * math.pi))
    step = (hi - lo) / (points - 1)
    return (
        values.mapInPandas(run, "point int, part double")
        .groupBy("point")
        .agg(F.sum("part").alias("total"))
        .select(
            "point",
            F.round(F.lit(lo) + F.col("point") * F.lit(step), 6).alias("x"),
            F.round(F.col("total") * F.lit(scale), digits).alias("density"),
        )
        .orderBy("point")
    )


BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Quartiles, whisker ends (last value within 1.5·iqr) and outlier count per column and group.
    The box table has one row per (group, column). It is written out first: with its size known, Catalyst
    broadcasts it when it is small and joins by key when it is not."""
    keys = [*by, "column"]
    boxes = stage(quantile_row(df, cols, BOX, by), "boxes")
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return (
        melt_numeric(df, cols, by)
        .join(boxes, keys)
        .groupBy(*keys, *BOX)
        .agg(
            F.count("*").alias("rows"),
            F.min(F.when(inside, F.col("value"))).alias("low"),
            F.max(F.when(inside, F.col("value"))).alias("high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            *keys,
            "rows",
            *[F.round(x, digits).alias(x) for x in ("low", "q1", "median", "q3", "high")],
            "outliers",
        )
    )


def box_stats_normalized(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Box table of all columns on a common 0-1 scale."""
    return box_stats(min_max_scale(df.select(*cols), cols), cols)


def scatter_sample(df: DataFrame, x: str, y: str, ids: Sequence[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """A reproducible sample of n points; the figure is the feature, so n is fixed."""
    return hash_sample(df.filter(known_number(x).isNotNull() & known_number(y).isNotNull()).select(*ids, x, y), ids, n, seed)


def scatter_pairs(
    df: DataFrame, cols: Sequence[str], ids: Sequence[str], n: int = 1000, pairs: int | None = None, seed: int = 42
) -> DataFrame:
    """(x_name, y_name, x, y) for all pairs of columns (or the first ``pairs``): of each pair the first n points, in the
    order of a hash of the ids, among the rows that know both."""
    chosen = column_pairs(cols, pairs)
    points = [
        F.struct(F.lit(i).alias("pair"), F.lit(a).alias("x_name"), F.lit(b).alias("y_name"), known_number(a).alias("x"), known_number(b).alias("y"))
        for i, (a, b) in enumerate(chosen)
    ]
    known = df.select(*ids, F.inline(F.array(*points))).dropna(subset=["x", "y"])
    first = Window.partitionBy("pair").orderBy(shuffle_key(ids, seed), *ids)  # the limit also applies before the shuffle
    return known.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= n).select(*ids, "x_name", "y_name", "x", "y")


def scatter_grid(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """All points as counts on a two-dimensional grid."""
    known = df.select(known_number(x).alias("x"), known_number(y).alias("y")).dropna()
    r = known.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if r[0] is None:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, rows bigint")
    (sx, wx), (sy, wy) = bin_edges(r[0], r[1], bins), bin_edges(r[2], r[3], bins)
    return known.groupBy(
        left_closed_bin("x", sx, wx, bins).alias("bin_x"), left_closed_bin("y", sy, wy, bins).alias("bin_y")
    ).agg(F.count("*").alias("rows"))


def bar_counts_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of all rows of every category; rounded once, from the counts."""
    counts = stage(value_counts(df, cols, nulls=True), "bar-counts")
    whole = counts.groupBy("column").agg(F.sum("rows").alias("whole"))  # one row per column
    share = F.round(F.col("rows") * 100.0 / F.col("whole"), 1)
    return counts.join(F.broadcast(whole), "column").filter(F.col("value").isNotNull()).select("column", "value", "rows", share.alias("pct"))


def class_bars(df: DataFrame, y: str, labels: dict[int, str]) -> DataFrame:
    """Class bars labelled by class value, not by frequency."""
    label = F.lit(None).cast("string")
    for value, text in labels.items():
        label = F.when(F.col("class") == value, text).otherwise(label)
    whole = F.sum("rows").over(Window.partitionBy())  # one row per class
    return class_balance(df, y).select(label.alias("label"), "rows", F.round(F.col("rows") * 100.0 / whole, 1).alias("pct"))


def heatmap_lower_triangle(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Cells below the diagonal: row column comes later in ``cols`` than the column column."""
    return correlation_pairs(df, cols, digits).select(F.col("y").alias("row"), F.col("x").alias("col"), "r")


def error_band(search: DataFrame) -> DataFrame:
    """K curve with its band of one standard deviation."""
    mean, std = F.col("accuracy_mean"), F.col("accuracy_std")
    return search.select(
        "k", "accuracy_mean", F.round(mean - std, 9).alias("low"), F.round(mean + std, 9).alias("high"), "best"
    )


def stacked_contribution(
    df: DataFrame, places: Sequence[str], part: str, y: str, n: int = 20
) -> DataFrame:
    """Bar segments per place: where each level's points start and end."""
    long = rate_contribution_long(df, places, part, y, n)
    along = Window.partitionBy("place").orderBy(part).rowsBetween(Window.unboundedPreceding, 0)  # levels of one place
    end = F.sum("points").over(along)
    return long.select(
        "place", part, "points", F.round(end - F.col("points"), 4).alias("start"), F.round(end, 4).alias("end")
    )
