"""Wide/long reshaping and value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.columns import category_text


def melt_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(*by, column, value double) without nulls and NaN."""
    wide = df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(by), list(cols), "column", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def melt_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, column, value string), nulls included."""
    wide = df.select(*keep, *[category_text(df, c).alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "column", "value")


def value_counts(
    df: DataFrame, cols: Sequence[str], extra: Sequence[Column] = (), keep: Sequence[str] = (), nulls: bool = False
) -> DataFrame:
    """(column, value, rows, *extra) for every value of every column; one scan, one shuffle of
    partially aggregated rows."""
    long = melt_text(df, cols, keep)
    if not nulls:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count("*").alias("rows"), *extra)


def melt_places(df: DataFrame, places: Sequence[str], keep: Sequence[str] = (), name: str = "place") -> DataFrame:
    """One row per (row, place column), null places dropped: two observations per origin/destination row."""
    if len(places) == 1:
        long = df.select(*keep, F.col(places[0]).alias(name))
    else:
        long = df.select(*keep, *places).unpivot(list(keep), list(places), "role", name).drop("role")
    return long.filter(F.col(name).isNotNull())


def pivot_fill(
    df: DataFrame, index: str, header: str, value: str, headers: Sequence[str], fill: float = 0.0
) -> DataFrame:
    """Long to wide over a known list of headers; missing cells get ``fill``."""
    return df.groupBy(index).pivot(header, list(headers)).agg(F.first(value)).na.fill(fill, list(headers))


def bounded_values(df: DataFrame, column: str, limit: int) -> list:
    """The distinct values of a column, sorted, refusing more than ``limit`` of them."""
    rows = df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column} has more than {limit} values")
    return [r[0] for r in rows]


def rows_of(flat: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame into several rows."""
    return flat.select(F.inline(F.array(*structs)))
