"""Place effects: raw and controlled rates, volume, spread, composition and role asymmetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.columns import rate_half_width
from ratewise.functions.stats import p_value_column, pearson, rate_pct
from ratewise.operators.reshape import melt_places, rows_of


def with_strata(df: DataFrame, strata: dict[str, Column]) -> DataFrame:
    """Add one boolean column per stratum; unknown levels are outside."""
    return df.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in strata.items()})


def raw_vs_controlled(df: DataFrame, places: Sequence[str], y: str, control: Column) -> DataFrame:
    """Raw and controlled volume and rate per place in one aggregation, no join."""
    marked = with_strata(df, {"_in": control})
    return (
        melt_places(marked, places, [y, "_in"])
        .groupBy("place")
        .agg(
            F.count("*").alias("total"),
            F.avg(y).alias("raw"),
            F.count_if("_in").alias("control_total"),
            F.avg(F.when(F.col("_in"), F.col(y))).alias("controlled"),
        )
    )


def adjusted_rate_table(df: DataFrame, places: Sequence[str], y: str, control: Column) -> DataFrame:
    """Volume, raw and controlled rate, difference in points, explained share, and the interval of the
    controlled rate (a small control sample makes it unreliable)."""
    t = raw_vs_controlled(df, places, y, control)
    delta = (F.col("raw") - F.col("controlled")) * 100
    return t.select(
        "place",
        "total",
        F.round(F.col("raw") * 100, 4).alias("raw_pct"),
        F.round(F.col("controlled") * 100, 4).alias("controlled_pct"),
        "control_total",
        F.round(delta, 4).alias("delta_pp"),
        F.round(F.try_divide(delta, F.col("raw")), 4).alias("explained_pct"),
        F.round(rate_half_width("controlled", "control_total") * 100, 4).alias("half_width_pp"),
    ).orderBy(F.col("total").desc(), "place")


def rate_confidence_interval(df: DataFrame, places: Sequence[str], y: str, z: float = 1.96) -> DataFrame:
    rates = melt_places(df, places, [y]).groupBy("place").agg(F.count(y).alias("total"), F.avg(y).alias("rate"))
    half = rate_half_width("rate", "total", z) * 100
    return rates.select(
        "place",
        "total",
        F.round(F.col("rate") * 100, 4).alias("rate_pct"),
        F.round(half, 4).alias("half_width_pp"),
        F.round(F.col("rate") * 100 - half, 4).alias("low_pct"),
        F.round(F.col("rate") * 100 + half, 4).alias("high_pct"),
    )


def control_scenarios(df: DataFrame, places: Sequence[str], y: str, strata: dict[str, Column]) -> DataFrame:
    """Mean and spread across places of the rate inside each stratum; one scan for all strata."""
    names = list(strata)
    marked = with_strata(df, {f"_s{i}": strata[n] for i, n in enumerate(names)})
    flags = [f"_s{i}" for i in range(len(names))]
    per_place = (
        melt_places(marked, places, [y, *flags])
        .groupBy("place")
        .agg(*[(F.avg(F.when(F.col(f), F.col(y))) * 100).alias(f) for f in flags])
    )
    flat = per_place.agg(
        *[F.avg(f).alias(f"m{i}") for i, f in enumerate(flags)],
        *[F.stddev_samp(f).alias(f"d{i}") for i, f in enumerate(flags)],
        *[F.count(f).alias(f"n{i}") for i, f in enumerate(flags)],
    )
    return rows_of(
        flat,
        [
            F.struct(
                F.lit(name).alias("scenario"),
                F.col(f"n{i}").alias("places"),
                F.round(F.col(f"m{i}"), 4).alias("mean_pct"),
                F.round(F.col(f"d{i}"), 4).alias("std_pp"),
            )
            for i, name in enumerate(names)
        ],
    )


def volume_rate_correlation(table: DataFrame, volume: str, rate: str) -> DataFrame:
    """Pearson r across the places of an aggregated table, with t and the two-sided p-value."""
    known = table.filter(F.col(volume).isNotNull() & F.col(rate).isNotNull())
    flat = known.agg(F.count("*").alias("places"), pearson(volume, rate).alias("r"))
    t = F.col("r") * F.sqrt(F.try_divide((F.col("places") - 2).cast("double"), 1 - F.col("r") * F.col("r")))
    return flat.select(
        "places",
        F.round("r", 6).alias("r"),
        F.round(t, 6).alias("t"),
        F.round(p_value_column("r", "places"), 6).alias("p_value"),
    )


def dispersion_by_size(table: DataFrame, volume: str, rate: str, large: float = 1000, small: float = 500) -> DataFrame:
    """Spread of the rate among large and among small places; those between are left out."""
    size = F.when(F.col(volume) >= large, "large").when(F.col(volume) < small, "small")
    return (
        table.withColumn("size_class", size)
        .filter(F.col("size_class").isNotNull())
        .groupBy("size_class")
        .agg(F.count("*").alias("places"), F.round(F.stddev_samp(rate), 4).alias("std_pp"))
    )


def composition_by_entity(df: DataFrame, places: Sequence[str], part: str) -> DataFrame:
    """Share of every level per place."""
    cells = (
        melt_places(df, places, [part])
        .filter(F.col(part).isNotNull())
        .groupBy("place", part)
        .agg(F.count("*").alias("rows"))
    )
    total = F.sum("rows").over(Window.partitionBy("place"))  # one row per level and place
    return cells.select("place", part, "rows", F.round(F.col("rows") * 100.0 / total, 4).alias("pct"))


def role_rates(df: DataFrame, origin: str, destination: str, y: str) -> DataFrame:
    """Unrounded rates (o, d) of each place in the two roles, which are two columns of one aggregation over the
    long form, so the raw rows are read once."""
    long = (
        df.select(y, origin, destination)
        .unpivot([y], [origin, destination], "role", "place")
        .filter(F.col("place").isNotNull())
    )
    as_origin = F.when(F.col("role") == origin, F.col(y))
    as_destination = F.when(F.col("role") == destination, F.col(y))
    return long.groupBy("place").agg(
        F.count(as_origin).alias("origin_rows"),
        F.count(as_destination).alias("destination_rows"),
        (F.avg(as_origin) * 100).alias("o"),
        (F.avg(as_destination) * 100).alias("d"),
    )


def role_compare(df: DataFrame, origin: str, destination: str, y: str) -> DataFrame:
    """Rate of each place as origin next to its rate as destination (either may be missing)."""
    return role_rates(df, origin, destination, y).select(
        "place",
        "origin_rows",
        "destination_rows",
        F.round("o", 4).alias("origin_pct"),
        F.round("d", 4).alias("destination_pct"),
        F.round(F.col("o") - F.col("d"), 4).alias("difference_pp"),
    ).orderBy(F.abs("difference_pp").desc_nulls_last(), "place")


def role_asymmetry(df: DataFrame, origin: str, destination: str, y: str, limit: float = 4.0) -> DataFrame:
    """How differently places behave in the two roles: r with p-value, spreads, ranges, mean absolute
    difference and the number of places above the limit, all from unrounded rates."""
    t = role_rates(df, origin, destination, y)
    apart = F.col("o") - F.col("d")
    flat = t.agg(
        F.count(apart).alias("places"),
        pearson("o", "d").alias("r"),
        F.stddev_samp("o").alias("so"),
        F.stddev_samp("d").alias("sd"),
        F.round(F.min("o"), 4).alias("origin_min"),
        F.round(F.max("o"), 4).alias("origin_max"),
        F.round(F.min("d"), 4).alias("destination_min"),
        F.round(F.max("d"), 4).alias("destination_max"),
        F.avg(F.abs(apart)).alias("mad"),
        F.count_if(F.abs(apart) > limit).alias("above_limit"),
    )
    return flat.select(
        "places",
        F.round("r", 5).alias("r"),
        F.round(p_value_column("r", "places"), 5).alias("p_value"),
        F.round("so", 3).alias("origin_std"),
        F.round("sd", 3).alias("destination_std"),
        "origin_min",
        "origin_max",
        "destination_min",
        "destination_max",
        F.round("mad", 3).alias("mean_abs_difference"),
        "above_limit",
    )


def place_volume_rate(df: DataFrame, places: Sequence[str], y: str) -> DataFrame:
    """Unrounded-enough volume and rate per place for the aggregate-level operators."""
    return melt_places(df, places, [y]).groupBy("place").agg(F.count("*").alias("total"), rate_pct(y, None).alias("rate_pct"))
