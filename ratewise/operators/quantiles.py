"""Exact order statistics and exact cumulative counts without a single-task sort.

Every double has a 64-bit key with the same order. The rows of a wanted rank are found digit by digit of that
key: a round counts the next digit of the rows that share a wanted rank's leading digits, so it shuffles one
row per digit and task at most, whatever the data. All columns, groups and ranks go through the same rounds;
after the fifth each rank's key is whole. A rank whose digits hold one value only is done sooner, so hot
values and short lists of values take a round or two.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators.reshape import melt_numeric
from ratewise.sources.scratch import stage

#: Bits of the key that stay unread after each round.
SHIFTS = (48, 36, 24, 12, 0)


def with_sort_key(df: DataFrame, value: str = "value", key: str = "key") -> DataFrame:
    """Adds a whole number that orders as the double does: its IEEE bits, with the sign of the value.

    Both zeros get the key 0; nulls and NaN have no place in the order and must be gone before.
    """
    low, one = F.lit(2.0**-1022), float(1 << 52)
    guess = F.least(F.greatest(F.floor(F.log2(F.greatest(F.col("_size"), low))), F.lit(-1022)), F.lit(1023)).cast("double")
    # A logarithm may fall on the wrong side of a power of two, so the ratio to it lies between 1/2 and 4.
    ratio = F.col("_size") / F.pow(F.lit(2.0), F.col("_e"))
    part = F.when(F.col("_r") < 1, (F.col("_r") * 2 - 2) * one).when(F.col("_r") >= 2, F.col("_r") / 2 * one).otherwise((F.col("_r") - 1) * one)
    normal = (F.col("_e").cast("long") + 1023) * (1 << 52) + part.cast("long")
    bits = F.when(F.col("_size") == math.inf, 2047 << 52).when(F.col("_size") < low, (F.col("_size") / F.lit(5e-324)).cast("long")).otherwise(normal)
    # Each step is known not to be null, so that no test for nulls, with all of the steps in it, is put before them.
    known = lambda c, other: F.coalesce(c, F.lit(other))
    sized = df.withColumn("_size", known(F.abs(value), 0.0)).withColumn("_e", known(guess, 0.0)).withColumn("_r", known(ratio, 0.0)).withColumn("_bits", known(bits, 0))
    return sized.withColumn(key, F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits"))).drop("_size", "_e", "_r", "_bits")


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{k}`").alias(f"{prefix}{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`") for c in df.columns if c not in keys])


def _matches(keys: Sequence[str], prefix: str) -> Column:
    """Equal keys; null groups are groups."""
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"{prefix}{i}"))
    return on


def _ranks(n: Column, qs: Sequence[float]) -> Column:
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    return F.array_distinct(F.flatten(F.transform(wanted, lambda q: F.array(F.floor(q * (n - 1)).cast("long"), F.ceil(q * (n - 1)).cast("long")))))


def _place(items: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Each open item's next digit: where its rank within the parent falls. ``counts``: keys, parent, prefix, rows, lo, hi."""
    upto = F.sum("rows").over(Window.partitionBy(*[f"`{k}`" for k in keys], "parent").orderBy("prefix"))
    running = _renamed(counts.withColumn("upto", upto), keys, "_r").withColumnRenamed("parent", "r_parent").withColumnRenamed("prefix", "r_prefix")
    waiting = items.select(*[F.col(f"`{k}`") for k in keys], "rank", "rest", F.col("prefix").alias("at"))
    joined = waiting.join(running, _matches(keys, "_r") & F.col("at").eqNullSafe(F.col("r_parent")))
    here = joined.filter((F.col("rest") >= F.col("upto") - F.col("rows")) & (F.col("rest") < F.col("upto")))
    return here.select(*[F.col(f"`{k}`") for k in keys], "rank", (F.col("rest") - F.col("upto") + F.col("rows")).alias("rest"), F.col("r_prefix").alias("prefix"), "lo", "hi")


def order_statistics(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Stored (*by, column, n, mean, m2, at): the number of values, their mean and squared deviations, and the
    values at the ranks floor and ceil of q * (n - 1), as a map from rank. Nulls and NaN are no values; columns (of a
    group) without values give no row."""
    keys = [*by, "column"]
    columns = [F.col(f"`{k}`") for k in keys]
    long = with_sort_key(melt_numeric(df, cols, by))
    prefix = lambda r: F.shiftright("key", SHIFTS[r]) if SHIFTS[r] else F.col("key")
    ends = [F.count("*").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    finite = F.when(F.abs("value") < math.inf, F.col("value"))
    moments = [F.avg(finite).alias("avg"), F.var_pop(finite).alias("var"), F.count_if(F.abs("value") == math.inf).alias("far")]
    first = stage(long.groupBy(*columns, prefix(0).alias("prefix")).agg(*ends, *moments), "digits")
    near = F.col("rows") - F.col("far")
    total = first.groupBy(*columns).agg(F.sum("rows").alias("n"), (F.sum(F.col("avg") * near) / F.sum(near)).alias("mean"), F.sum("far").alias("far"), F.min("lo").alias("least"), F.max("hi").alias("most"))
    total = stage(total, "totals")
    around = _renamed(total.select(*columns, F.col("mean").alias("centre")), keys, "_t")
    spread = first.join(around, _matches(keys, "_t")).groupBy(*columns).agg(F.sum(near * (F.col("var") + (F.col("avg") - F.col("centre")) * (F.col("avg") - F.col("centre")))).alias("m2"))
    items = total.select(*columns, F.explode(_ranks(F.col("n"), qs)).alias("rank")).withColumn("rest", F.col("rank")).withColumn("prefix", F.lit(None).cast("long"))
    found = stage(_place(items, first.select(*columns, F.lit(None).cast("long").alias("parent"), "prefix", "rows", "lo", "hi"), keys), "ranks")
    done = []
    for r in range(1, len(SHIFTS)):
        done.append(found.filter("lo = hi"))
        open_ = found.filter("lo < hi")
        if open_.isEmpty():
            break
        wanted = _renamed(open_.groupBy(*columns).agg(F.collect_set("prefix").alias("prefixes")), keys, "_w")  # one entry to a rank at most
        inside = long.join(wanted, _matches(keys, "_w")).filter(F.array_contains("prefixes", prefix(r - 1)))
        counts = inside.groupBy(*columns, prefix(r - 1).alias("parent"), prefix(r).alias("prefix")).agg(*ends)
        found = stage(_place(open_, counts, keys), "ranks")
    else:
        done.append(found)
    values = done[0]
    for d in done[1:]:
        values = values.unionByName(d)
    at = _renamed(values.groupBy(*columns).agg(F.map_from_entries(F.collect_list(F.struct("rank", F.col("lo").alias("value")))).alias("at")), keys, "_v")
    whole = total.join(_renamed(spread, keys, "_s"), _matches(keys, "_s")).join(at, _matches(keys, "_v"))
    # Infinite values leave neither a mean nor a spread but their own.
    mean = F.when(F.col("far") == 0, F.col("mean")).otherwise(F.when(F.col("least") == -math.inf, F.col("least")).otherwise(0.0) + F.when(F.col("most") == math.inf, F.col("most")).otherwise(0.0))
    return stage(whole.select(*columns, "n", mean.alias("mean"), F.when(F.col("far") == 0, F.col("m2")).otherwise(F.lit(math.nan)).alias("m2"), "at"), "order-statistics")


def quantile(q: float) -> Column:
    """One quantile of a row of ``order_statistics``: linear interpolation between ranks."""
    position = F.lit(float(q)) * (F.col("n") - 1)
    low, high = F.element_at("at", F.floor(position).cast("long")), F.element_at("at", F.ceil(position).cast("long"))
    return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))


def quantile_row(df: DataFrame, cols: Sequence[str], qs: Mapping[str, float], by: Sequence[str] = (), moments: bool = False) -> DataFrame:
    """One row per (*by, column) with a named column per quantile: linear interpolation between ranks, nulls
    and NaN ignored. ``moments`` adds count, mean and std, taken in the first round."""
    seen = order_statistics(df, cols, sorted(set(qs.values())), by)
    plain = [F.col("n").alias("count"), "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std")] if moments else []
    return seen.select(*[F.col(f"`{k}`") for k in by], "column", *plain, *[quantile(q).alias(name) for name, q in qs.items()])


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The same in long form: rows (*by, column, q, value)."""
    seen = order_statistics(df, cols, sorted(set(map(float, qs))), by)
    pairs = F.inline(F.array(*[F.struct(F.lit(float(q)).alias("q"), quantile(q).alias("value")) for q in qs]))
    return seen.select(*[F.col(f"`{k}`") for k in by], "column", pairs)


def cumulative_counts(df: DataFrame, order: str, measures: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Sums of ``measures`` over all strictly smaller values of ``order`` (columns ``before_<m>``).

    ``df`` has one row per distinct ``order`` value. Rows are dealt to range partitions, ``buckets`` or as many as
    shuffles have, and written with the number of theirs: running sums within a partition, plus a running sum over
    the partitions' totals, one row each. The driver holds nothing.
    """
    ranged = df.repartitionByRange(order) if buckets is None else df.repartitionByRange(buckets, order)
    placed = stage(ranged.withColumn("_bucket", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"before_{m}": F.coalesce(F.sum(m).over(within), F.lit(0)) for m in measures})
    across = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select("_bucket", *[F.coalesce(F.sum(f"_t_{m}").over(across), F.lit(0)).alias(f"_o_{m}") for m in measures])
    )
    return (
        local.join(offsets, "_bucket")
        .withColumns({f"before_{m}": F.col(f"before_{m}") + F.col(f"_o_{m}") for m in measures})
        .drop("_bucket", *[f"_o_{m}" for m in measures])
    )
