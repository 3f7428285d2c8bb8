"""Exact, reproducible class balancing, splits and folds.

The input is scanned once, for the class and key of each row; counts, histogram and ranking read that table. Rows are ordered inside their class by a hash of (seed, id), so the choice does not depend on
partitioning, retries or engine. Instead of ranking a whole class in one task, the wanted positions are
located in a histogram over the first hash digits, only the rows of the one digit group that holds a
position are ranked, and the found keys become literals: selecting is then a narrow comparison.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.columns import shuffle_key
from ratewise.operators.roles import require_columns
from ratewise.sources.scratch import stage

SEED = 42


@dataclass(frozen=True)
class Order:
    """Class and hash key of every row, written once; everything a choice needs is read from it."""

    keyed: DataFrame  # (y, key)
    counts: dict
    y: str
    ids: tuple[str, ...]
    seed: int


def class_order(df: DataFrame, y: str, ids: Sequence[str], seed: int = SEED) -> Order:
    """The one scan of the input. A column that is missing raises, as does a null class: its rows would belong to no part."""
    keyed = stage(require_columns(df, y, *ids).select(F.col(y).alias("y"), shuffle_key(ids, seed).alias("key")), "sample-keys")
    counts = {r[0]: r[1] for r in keyed.groupBy("y").agg(F.count("*")).collect()}  # one row per class
    if None in counts:
        raise ValueError(f"class column {y} has {counts[None]} nulls")
    return Order(keyed, counts, y, tuple(ids), seed)


def prefix_digits(rows: int) -> int:
    """Hash digits of the histogram: about as many groups as a group has rows, at least 16**4."""
    return max(4, math.ceil(math.log(max(rows, 1), 16) / 2))


def position_keys(order: Order, wanted: Mapping[int, Sequence[int]]) -> dict[tuple[int, int], str]:
    """Hash key of the wanted 1-based positions of every class. Raises where rows of one id lie on both sides of a
    position: such a cut would take more rows than asked."""
    digits = prefix_digits(sum(order.counts.values()))
    asked = [(c, p) for c, positions in wanted.items() for p in positions]
    if not asked:
        return {}
    keyed, ids = order.keyed, order.ids
    histogram = keyed.groupBy("y", F.substring("key", 1, digits).alias("digits")).agg(F.count("*").alias("rows"))
    upto = Window.partitionBy("y").orderBy("digits")  # at most 16**digits counted rows per class
    running = histogram.withColumn("upto", F.sum("rows").over(upto)).withColumn("before", F.col("upto") - F.col("rows"))
    holds = reduce(
        lambda a, b: a | b,
        [(F.col("y") == c) & (F.col("before") < p) & (F.col("upto") >= p) for c, p in asked],
    )
    groups = running.filter(holds).select("y", "digits", "before").collect()  # at most one row per wanted position
    edge = reduce(
        lambda a, b: a | b, [(F.col("y") == g["y"]) & F.startswith("key", F.lit(g["digits"])) for g in groups]
    )
    before = reduce(
        lambda acc, g: acc.when((F.col("y") == g["y"]) & F.startswith("key", F.lit(g["digits"])), F.lit(g["before"])),
        groups,
        F.when(F.lit(False), F.lit(0).cast("long")),
    )
    within = Window.partitionBy("y", F.substring("key", 1, digits)).orderBy("key")
    ranked = keyed.filter(edge).select(
        "y",
        "key",
        (before + F.row_number().over(within)).alias("position"),
        F.coalesce(F.lead("key").over(within) == F.col("key"), F.lit(False)).alias("torn"),
    )
    hit = reduce(lambda a, b: a | b, [(F.col("y") == c) & (F.col("position") == p) for c, p in asked])
    found = ranked.filter(hit).collect()  # one row per wanted position
    if any(r["torn"] for r in found):
        raise ValueError(f"rows with equal {', '.join(ids)} lie on both sides of a cut; give ids that are unique")
    return {(r["y"], r["position"]): r["key"] for r in found}


def _first(order: Order, *quotas: Mapping[int, int]) -> list[Column]:
    """For each table of quotas: true for the first ``quota[c]`` rows of every class c. All are cuts of the same
    order, found together."""
    partial = {c: sorted({q[c] for q in quotas if 0 < q[c] < n}) for c, n in order.counts.items()}
    cuts = position_keys(order, partial)
    key, flags = shuffle_key(order.ids, order.seed), []
    for quota in quotas:
        flag = F.lit(False)
        for c, q in quota.items():
            if q >= order.counts[c]:
                flag = flag | (F.col(order.y) == c)
            elif q > 0:
                flag = flag | ((F.col(order.y) == c) & (key <= F.lit(cuts[(c, q)])))
        flags.append(flag)
    return flags


def _balanced(counts: Mapping[int, int]) -> dict[int, int]:
    smallest = min(counts.values()) if counts else 0
    return {c: smallest for c in counts}


def mark_undersample(
    df: DataFrame, y: str, ids: Sequence[str], seed: int = SEED, flag: str = "selected"
) -> DataFrame:
    """Mark all rows of the smallest class and equally many of every other class."""
    order = class_order(df, y, ids, seed)
    return df.withColumn(flag, _first(order, _balanced(order.counts))[0])


def undersample_majority(df: DataFrame, y: str, ids: Sequence[str], seed: int = SEED) -> DataFrame:
    return mark_undersample(df, y, ids, seed).filter("selected").drop("selected")


def undersample_discarded(df: DataFrame, y: str, ids: Sequence[str], seed: int = SEED) -> DataFrame:
    return mark_undersample(df, y, ids, seed).filter("NOT selected").drop("selected")


def split_quotas(counts: Mapping[int, int], test_size: float) -> dict[int, int]:
    """Rows per class in the test part: ceil(size·N) in total, shares kept by largest remainder
    (ties: smaller class first)."""
    total = sum(counts.values())
    wanted = math.ceil(round(test_size * total, 9))
    exact = {c: wanted * n / total for c, n in counts.items()}
    quota = {c: math.floor(e) for c, e in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (quota[c] - exact[c], c))
    for c in by_remainder[: wanted - sum(quota.values())]:
        quota[c] += 1
    return quota


def stratified_split(
    df: DataFrame, y: str, ids: Sequence[str], test_size: float = 0.3, seed: int = SEED, flag: str = "is_test"
) -> DataFrame:
    """Mark the test part."""
    order = class_order(df, y, ids, seed)
    return df.withColumn(flag, _first(order, split_quotas(order.counts, test_size))[0])


def stratified_kfold(
    df: DataFrame, y: str, ids: Sequence[str], folds: int = 5, seed: int = SEED, name: str = "fold"
) -> DataFrame:
    """Fold 0..folds-1; inside a class the folds take consecutive runs of the hash order whose sizes
    differ by one row at most."""
    order = class_order(df, y, ids, seed)
    counts = order.counts
    ends = {c: [round_up(n * f, folds) for f in range(1, folds)] for c, n in counts.items()}
    wanted = {c: sorted({e for e in es if 0 < e < counts[c]}) for c, es in ends.items()}
    cuts = position_keys(order, wanted)
    key = shuffle_key(ids, seed)
    fold = F.lit(0)
    for c, es in ends.items():
        for e in es:
            beyond = F.lit(True) if e == 0 else key > F.lit(cuts[(c, e)]) if (c, e) in cuts else F.lit(False)
            fold = fold + F.when((F.col(y) == c) & beyond, 1).otherwise(0)
    return df.withColumn(name, fold)


def round_up(a: int, b: int) -> int:
    return -(-a // b)


def full_evaluation_set(
    df: DataFrame, y: str, ids: Sequence[str], test_size: float = 0.3, seed: int = SEED
) -> DataFrame:
    """Test part of the balanced rows plus all rows the balancing discarded. The balanced rows are the first of each
    class, and their test part the first of these, so both are cuts of one order and ``df`` is scanned once for it."""
    order = class_order(df, y, ids, seed)
    kept = _balanced(order.counts)
    selected, test = _first(order, kept, split_quotas(kept, test_size))
    return df.filter(test | ~selected)


def set_difference(df: DataFrame, taken: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows whose id is not among the taken ones."""
    return df.join(taken.select(*ids).distinct(), list(ids), "left_anti")


def hash_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """Exactly n reproducible rows (a top-n by hash; n is small)."""
    return df.withColumn("_key", shuffle_key(ids, seed)).orderBy("_key").limit(n).drop("_key")
