"""Checks that are plain aggregates over the whole table, written so that several can share a scan.

A ``OnePass`` names its aggregates and says how the single result row becomes a table. ``run`` evaluates
one. ``run_together`` evaluates many in few scans: aggregates are packed into groups small enough that the
generated loop is still compiled (one aggregate of hundreds of columns falls back to interpreted code and is
many times slower than a few scans).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

PER_SCAN = 32


@dataclass(frozen=True)
class OnePass:
    aggregates: Mapping[str, Column]
    finish: Callable[[DataFrame], DataFrame]


def run(df: DataFrame, check: OnePass) -> DataFrame:
    return check.finish(df.agg(*[c.alias(name) for name, c in check.aggregates.items()]))


def run_together(df: DataFrame, checks: Mapping[str, OnePass]) -> dict[str, DataFrame]:
    wanted = [(k, a, c) for k, check in checks.items() for a, c in check.aggregates.items()]
    values, types = {}, {}
    for start in range(0, len(wanted), PER_SCAN):
        group = df.agg(*[c.alias(f"a{i}") for i, (_, _, c) in enumerate(wanted[start : start + PER_SCAN])])
        row = group.first()  # one row of numbers
        for i, (k, a, _) in enumerate(wanted[start : start + PER_SCAN]):
            values[k, a], types[k, a] = row[i], group.schema[i].dataType.simpleString()
    out = {}
    for k, check in checks.items():
        schema = ", ".join(f"`{a}` {types[k, a]}" for a in check.aggregates)
        out[k] = check.finish(df.sparkSession.createDataFrame([tuple(values[k, a] for a in check.aggregates)], schema))
    return out
