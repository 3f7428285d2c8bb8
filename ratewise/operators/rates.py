"""Outcome rates by category, hour, bin, place and route. ``y`` is always a 0/1 column.

Every table is a partial + final hash aggregation whose output is bounded by the number of groups, so a
group holding a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.columns import bin_edges, known_number, pair_key, ratio_rate, right_closed_bin, time_band_4
from ratewise.functions.stats import pearson, rate_pct
from ratewise.operators.profile import numeric_summary
from ratewise.operators.reshape import bounded_values, melt_places, pivot_fill, value_counts
from ratewise.operators.roles import require_columns
from ratewise.sources.scratch import stage


def rate_by_category(df: DataFrame, category: str, y: str, digits: int = 2) -> DataFrame:
    """Rows and rate per category, highest rate first."""
    return (
        require_columns(df, category, y).dropna(subset=[category, y])
        .groupBy(category)
        .agg(F.count("*").alias("total"), rate_pct(y, None).alias("rate"))
        .orderBy(F.col("rate").desc(), category)
        .select(category, "total", F.round("rate", digits).alias("rate_pct"))
    )


def rate_by_category_all(df: DataFrame, cols: Sequence[str], y: str, max_categories: int = 20) -> DataFrame:
    """Rate of every category of every column, with the column's number of categories and whether a figure
    of at most ``max_categories`` of them can show it. The cells are stored: they are counted per column too."""
    cells = stage(rate_cells(df, cols, y), "category-cells")
    widths = cells.groupBy("column").agg(F.count("*").alias("categories"))  # one row per column
    return cells.join(F.broadcast(widths), "column").select(
        "column",
        "value",
        "rows",
        F.round(F.try_divide(F.col("positives") * 100.0, F.col("known")), 4).alias("rate_pct"),
        "categories",
        (F.col("categories") <= max_categories).alias("drawable"),
    )


def rate_cells(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """(column, value, rows, positives, known) for every category of every column."""
    return value_counts(require_columns(df, *cols, y), cols, [F.sum(y).alias("positives"), F.count(y).alias("known")], keep=[y])


def rate_spread_by_category(df: DataFrame, cols: Sequence[str], y: str, limit: float = 15.0) -> DataFrame:
    """Lowest and highest category rate per column, their distance, and whether it passes the limit."""
    return rate_spread_of(rate_cells(df, cols, y), limit)


def rate_spread_of(cells: DataFrame, limit: float = 15.0) -> DataFrame:
    """The same from given category cells."""
    rate = F.try_divide(F.col("positives") * 100.0, F.col("known"))
    spread = cells.groupBy("column").agg(F.min(rate).alias("lo"), F.max(rate).alias("hi"))
    return spread.select(
        "column",
        F.round("lo", 4).alias("min_rate"),
        F.round("hi", 4).alias("max_rate"),
        F.round(F.col("hi") - F.col("lo"), 4).alias("spread_pp"),
        (F.col("hi") - F.col("lo") > limit).alias("important"),
    )


def crosstab_row_pct(df: DataFrame, category: str, y: str) -> DataFrame:
    """Row-normalised two-way table, lowest positive share first."""
    known = require_columns(df, category, y).dropna(subset=[category, y])
    table = known.groupBy(category).pivot(y, [0, 1]).agg(F.count(F.lit(1))).na.fill(0, ["0", "1"])
    whole = F.col("0") + F.col("1")
    return table.select(
        category,
        F.round(F.try_divide(F.col("0") * 100.0, whole), 4).alias("negative_pct"),
        F.round(F.try_divide(F.col("1") * 100.0, whole), 4).alias("positive_pct"),
    ).orderBy("positive_pct", category)


def rate_by_hour(df: DataFrame, hour: str, y: str, digits: int = 2) -> DataFrame:
    """Rows and rate for hours 0-23; other hours and unreadable texts are left out."""
    return (
        df.filter(F.col(hour).between(0, 23))
        .groupBy(hour)
        .agg(F.count("*").alias("rows"), rate_pct(y, digits).alias("rate_pct"))
        .orderBy(hour)
    )


def hour_occupancy_rate(df: DataFrame, hour: str, load: str, y: str) -> DataFrame:
    return (
        df.filter(F.col(hour).between(0, 23))
        .groupBy(hour)
        .agg(
            F.count("*").alias("rows"),
            F.round(F.avg(load), 6).alias("mean_load"),
            rate_pct(y).alias("rate_pct"),
        )
        .orderBy(hour)
    )


def peak_group(table: DataFrame, key: str, measure: str) -> DataFrame:
    """Group with the largest measure; the smallest key wins ties."""
    return table.agg(
        F.min_by(key, F.struct(-F.col(measure), F.col(key))).alias(key), F.max(measure).alias(measure)
    )


def rate_by_time_band(df: DataFrame, hour: str, y: str) -> DataFrame:
    return (
        df.filter(F.col(hour).between(0, 23))
        .withColumn("band", time_band_4(hour))
        .groupBy("band")
        .agg(F.count(y).alias("rows"), rate_pct(y, 4).alias("rate_pct"))
    )


def rate_by_bin(df: DataFrame, c: str, y: str, bins: int = 10) -> DataFrame:
    """Rate in equal-width right-closed bins; empty bins do not appear."""
    known = df.select(c, y).dropna()
    ends = known.agg(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, total bigint, rate_pct double")
    start, width = bin_edges(ends["lo"], ends["hi"], bins)
    return (
        known.withColumn("bin", right_closed_bin(c, start, width, bins))
        .groupBy("bin")
        .agg(F.count("*").alias("total"), rate_pct(y).alias("rate_pct"))
        .select(
            "bin",
            F.round(F.lit(start) + (F.col("bin") - 1) * F.lit(width), 6).alias("lo"),
            F.round(F.lit(start) + F.col("bin") * F.lit(width), 6).alias("hi"),
            "total",
            "rate_pct",
        )
        .orderBy("bin")
    )


# --- places -----------------------------------------------------------------------------------------


def entity_rate(df: DataFrame, places: Sequence[str], y: str) -> DataFrame:
    """Rows, positives and rate per place over all place columns, highest rate first."""
    return (
        melt_places(df, places, [y])
        .groupBy("place")
        .agg(F.count(y).alias("total"), F.sum(y).cast("long").alias("positives"), rate_pct(y).alias("rate_pct"))
        .orderBy(F.col("rate_pct").desc(), "place")
    )


def entity_volume_rate_topn(df: DataFrame, places: Sequence[str], y: str, n: int = 20) -> DataFrame:
    """The n busiest places with their rate."""
    return (
        melt_places(df, places, [y])
        .groupBy("place")
        .agg(F.count("*").alias("total"), rate_pct(y).alias("rate_pct"))
        .orderBy(F.col("total").desc(), "place")
        .limit(n)
    )


def entity_mean_topn(df: DataFrame, places: Sequence[str], measure: str, n: int = 20) -> DataFrame:
    """The n places with the highest mean of a measure; rows without it are left out."""
    return (
        melt_places(df.withColumn(measure, known_number(measure)), places, [measure])
        .filter(F.col(f"`{measure}`").isNotNull())
        .groupBy("place")
        .agg(F.count("*").alias("total"), F.avg(measure).alias("mean"))
        .orderBy(F.col("mean").desc(), "place")
        .limit(n)
        .withColumn("mean", F.round("mean", 6))
    )


def attach_totals(table: DataFrame, key: str, measure: str, total: str = "total") -> DataFrame:
    """Add the per-key total of an already aggregated table to each of its rows. A window does it in one
    pass over the table; joining a table with its own totals would compute it twice."""
    return table.withColumn(total, F.sum(measure).over(Window.partitionBy(key)))  # a few rows per key


def rate_contribution_long(df: DataFrame, places: Sequence[str], part: str, y: str, n: int = 20) -> DataFrame:
    """Points each level of ``part`` adds to the rate of the n busiest places. The raw rows are read once;
    totals, ranking and shares come from the stored (place, part) table. Rows with an unknown level count in
    the total but form no part."""
    cells = stage(
        melt_places(df, places, [part, y])
        .groupBy("place", part)
        .agg(F.count("*").alias("cell_rows"), F.sum(y).cast("long").alias("positives")),
        "place-cells",
    )
    totals = cells.groupBy("place").agg(F.sum("cell_rows").alias("total"))
    busiest = totals.orderBy(F.col("total").desc(), "place").limit(n)
    return (
        cells.filter(F.col(part).isNotNull())
        .join(busiest, "place")
        .select(
            "place",
            part,
            "positives",
            "total",
            F.round(F.col("positives") * 100.0 / F.col("total"), 2).alias("points"),
        )
    )


def rate_contribution(
    df: DataFrame, places: Sequence[str], part: str, y: str, n: int = 20, levels: Sequence[str] | None = None, max_levels: int = 1000
) -> DataFrame:
    """The same as one row per place with one column per level and the row total, smallest total first.
    Beyond ``max_levels`` columns use ``rate_contribution_long``, which has no limit."""
    long = stage(rate_contribution_long(df, places, part, y, n), "contribution")
    if levels is None:
        levels = bounded_values(long, part, max_levels)
    wide = pivot_fill(long, "place", part, "points", levels)
    total = sum((F.col(f"`{v}`") for v in levels), F.lit(0.0))
    return wide.withColumn("row_total", F.round(total, 4)).orderBy("row_total", "place")


def rate_stats_by_type(df: DataFrame, kind: str, amount: str, minutes: str, digits: int = 1) -> DataFrame:
    """Mean, std, min and max hourly rate per type."""
    raw = raw_stats_by_type(require_columns(df, kind, amount, minutes), kind, amount, minutes)
    return raw.select(kind, *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "max")]).orderBy(F.col("mean").desc(), kind)


def raw_stats_by_type(df: DataFrame, kind: str, amount: str, minutes: str) -> DataFrame:
    """The same before rounding, in no order."""
    rated = df.select(kind, ratio_rate(known_number(amount), known_number(minutes)).alias("rate")).dropna(subset=[kind])
    return rated.groupBy(kind).agg(F.avg("rate").alias("mean"), F.stddev_samp("rate").alias("std"), F.min("rate").alias("min"), F.max("rate").alias("max"))


def rate_summary_by_type(df: DataFrame, kind: str, amount: str, minutes: str, digits: int = 1) -> DataFrame:
    """Full numeric summary of the hourly rate per type, complete rows only."""
    rated = df.select(kind, amount, minutes).dropna().withColumn("rate", ratio_rate(amount, minutes))
    return numeric_summary(rated, ["rate"], [kind], digits).drop("column").orderBy(F.col("mean").desc(), kind)


def type_mean_spread(df: DataFrame, kind: str, amount: str, minutes: str, limit: float = 30.0) -> DataFrame:
    """Distance between the largest and smallest type mean; below the limit the type hardly matters."""
    return mean_spread_of(raw_stats_by_type(df, kind, amount, minutes), limit)


def mean_spread_of(stats: DataFrame, limit: float = 30.0) -> DataFrame:
    """The same from a table with the types' means; pass them unrounded, so that rounding decides nothing."""
    spread = F.max("mean") - F.min("mean")
    return stats.agg(
        F.round(spread, 1).alias("spread"), (spread < limit).alias("almost_equal")
    )


# --- routes -----------------------------------------------------------------------------------------


def route_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count("*").alias("rows"))


def top_routes(df: DataFrame, a: str, b: str, n: int = 10) -> DataFrame:
    return route_counts(df, a, b).orderBy(F.col("rows").desc(), a, b).limit(n)


def pair_totals(df: DataFrame, a: str, b: str) -> DataFrame:
    """Volume and number of directions per unordered pair, from the route counts."""
    lo, hi = pair_key(a, b)
    return (
        route_counts(df, a, b)
        .groupBy(lo.alias("end_1"), hi.alias("end_2"))
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("directions"))
    )


def one_way_routes(df: DataFrame, a: str, b: str) -> DataFrame:
    return pair_totals(df, a, b).filter(F.col("directions") == 1).select("end_1", "end_2", "rows")


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Count and share per class, plus the smallest/largest ratio and its level."""
    counts = stage(
        df.filter(F.col(y).isNotNull()).groupBy(F.col(y).alias("class")).agg(F.count("*").alias("rows")), "class-counts"
    )
    whole = counts.agg(F.sum("rows").alias("all"), (F.min("rows") / F.max("rows")).alias("ratio")).first()
    ratio, total = F.lit(whole["ratio"]).cast("double"), F.lit(whole["all"]).cast("double")
    return counts.select(
        "class",
        "rows",
        F.round(F.col("rows") * 100.0 / total, 4).alias("pct"),
        F.round(ratio, 6).alias("ratio"),
        F.when(ratio < 0.25, "severe").when(ratio < 0.5, "moderate").otherwise("acceptable").alias("level"),
    )


def mean_by_class(df: DataFrame, c: str, y: str) -> DataFrame:
    return df.dropna(subset=[y]).groupBy(y).agg(F.count(known_number(c)).alias("rows"), F.round(F.avg(known_number(c)), 6).alias("mean"))


def hour_correlation(df: DataFrame, hour: str, y: str) -> DataFrame:
    return df.filter(F.col(hour).between(0, 23)).agg(F.round(pearson(hour, y), 6).alias("r"))
