"""Row filters and domain checks.

Each check is one aggregate over one scan. A comparison with a null counts as 'not kept', so every
rule is coalesced to false before it is negated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.columns import as_column, known_number, pair_key, ratio_rate, same_pair
from ratewise.operators.onepass import OnePass, run

Rule = tuple[str, Column]


def min_rate_rule(amount: str, minutes: str, minimum: float = 100.0) -> Column:
    """Keep rows whose hourly rate reaches the minimum; unknown rates are not kept."""
    rate = ratio_rate(amount, minutes, on_zero="inf")
    return F.coalesce((rate >= minimum) & ~F.isnan(rate), F.lit(False))


def min_rate_filter(df: DataFrame, amount: str, minutes: str, minimum: float = 100.0) -> DataFrame:
    return df.filter(min_rate_rule(amount, minutes, minimum))


def exclude_pair_rule(a: str, b: str, x: str, y: str) -> Column:
    return ~same_pair(a, b, x, y)


def exclude_pair(df: DataFrame, a: str, b: str, x: str, y: str) -> DataFrame:
    return df.filter(exclude_pair_rule(a, b, x, y))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    keep = F.lit(True)
    for _, rule in rules:
        keep = keep & F.coalesce(rule, F.lit(False))
    return df.filter(keep)


def filter_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows each rule removes on its own, rows before and after all of them; one pass."""
    removed = [~F.coalesce(rule, F.lit(False)) for _, rule in rules]
    any_removed = F.lit(False)
    for r in removed:
        any_removed = any_removed | r
    flat = df.agg(
        F.count("*").alias("before"),
        F.count_if(any_removed).alias("gone"),
        *[F.count_if(r).alias(f"r{i}") for i, r in enumerate(removed)],
    )
    rows = [F.struct(F.lit(name).alias("item"), F.col(f"r{i}").alias("rows")) for i, (name, _) in enumerate(rules)]
    rows += [
        F.struct(F.lit("rows_before").alias("item"), F.col("before").alias("rows")),
        F.struct(F.lit("rows_removed").alias("item"), F.col("gone").alias("rows")),
        F.struct(F.lit("rows_after").alias("item"), (F.col("before") - F.col("gone")).alias("rows")),
    ]
    return flat.select(F.inline(F.array(*rows)))


def valid_range(df: DataFrame, c: str | Column, lo: float, hi: float) -> DataFrame:
    return df.filter(as_column(c).between(lo, hi))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def pair_set_pass(a: str, b: str, members: Sequence[str]) -> OnePass:
    hit = F.col(a).isin(*members) & F.col(b).isin(*members) & (F.col(a) != F.col(b))
    return OnePass(
        {"rows": F.count("*"), "hits": F.count_if(hit)},
        lambda flat: flat.select(
            "rows", "hits", F.round(F.try_divide(F.col("hits") * 100.0, F.col("rows")), 4).alias("pct")
        ),
    )


def pair_set_check(df: DataFrame, a: str, b: str, members: Sequence[str]) -> DataFrame:
    """Rows whose two ends are different members of a set, with their share of all rows."""
    return run(df, pair_set_pass(a, b, members))


def self_pair_pass(a: str, b: str) -> OnePass:
    return OnePass({"rows": F.count("*"), "hits": F.count_if(F.col(a) == F.col(b))}, lambda flat: flat)


def self_pair_check(df: DataFrame, a: str, b: str) -> DataFrame:
    return run(df, self_pair_pass(a, b))


def rate_band_pass(amount: str, minutes: str, slow: float = 150.0, fast: float = 950.0) -> OnePass:
    rate = ratio_rate(amount, minutes, on_zero="inf")
    return OnePass(
        {"too_slow": F.count_if(rate < slow), "too_fast": F.count_if((rate > fast) & ~F.isnan(rate))}, lambda flat: flat
    )


def rate_band_check(df: DataFrame, amount: str, minutes: str, slow: float = 150.0, fast: float = 950.0) -> DataFrame:
    return run(df, rate_band_pass(amount, minutes, slow, fast))


def slow_routes(df: DataFrame, a: str, b: str, amount: str, minutes: str, slow: float = 150.0) -> DataFrame:
    """Ordered pairs that contain rows below the slow limit."""
    return (
        df.filter(ratio_rate(amount, minutes, on_zero="inf") < slow)
        .dropna(subset=[a, b])
        .groupBy(a, b)
        .agg(F.count("*").alias("rows"))
        .orderBy(a, b)
    )


def domain_range_pass(c: str, lo: float = 0.0, hi: float = 100.0) -> OnePass:
    x = known_number(c)
    return OnePass(
        {"above": F.count_if(x > hi), "below": F.count_if(x < lo), "at_lower": F.count_if(x == lo)}, lambda flat: flat
    )


def domain_range_check(df: DataFrame, c: str, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Counts above the upper limit, below the lower limit and exactly at the lower limit."""
    return run(df, domain_range_pass(c, lo, hi))


def top_members(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values of a key (ties: smaller key first)."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("rows"))
        .orderBy(F.col("rows").desc(), key)
        .limit(n)
    )


def top_n_members_filter(df: DataFrame, key: str, n: int) -> DataFrame:
    """Keep the rows of the n most frequent members. The member side has n rows at most, so
    Catalyst broadcasts it from its own size estimate."""
    return df.join(top_members(df, key, n).select(key), key, "left_semi")


def control_rule(**strata: str) -> Column:
    """All strata at their reference level; unknown levels are outside."""
    keep = F.lit(True)
    for column, level in strata.items():
        keep = keep & F.coalesce(F.col(column) == level, F.lit(False))
    return keep


def control_filter(df: DataFrame, **strata: str) -> DataFrame:
    return df.filter(control_rule(**strata))


def unordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    lo, hi = pair_key(a, b)
    return df.withColumns({"end_1": lo, "end_2": hi})
