"""Equal rows and equal values by fingerprints: two 64-bit hashes stand for the value of any number of columns.

What is shuffled is sixteen bytes and a count per distinct value and task, never the rows. Two unlike rows among a
billion billion (10^18) share a fingerprint with a chance of about one in seven hundred; nulls, and NaN, which
counts as missing, are told apart from every value by their place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns whose missing values fit into one whole number.
_PLACES = 62


def known_values(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The columns with NaN as null."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    return [(F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) if c in floats else F.col(f"`{c}`")) for c in cols]


def fingerprint(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Two hashes of the columns' values; the hash functions skip nulls, so their places are hashed as well."""
    values = known_values(df, cols)
    gaps = [sum((v.isNull().cast("long") * (1 << i) for i, v in enumerate(values[s : s + _PLACES])), F.lit(0).cast("long")) for s in range(0, len(values), _PLACES)]
    return [F.xxhash64(F.lit(seed), *gaps, *values) for seed in (1, 2)]


def fingerprint_counts(df: DataFrame, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """(kind, a, b, empty, copies): how often each value of each set of columns occurs; all sets in one shuffle.
    ``empty`` marks the value whose columns are all missing."""
    empty = lambda cols: F.coalesce(*[F.when(v.isNotNull(), False) for v in known_values(df, cols)], F.lit(True))
    each = F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("a"), b.alias("b"), empty(cols).alias("empty")) for k, cols in kinds.items() for a, b in [fingerprint(df, cols)]])
    return df.select(F.explode(each).alias("f")).select("f.*").groupBy("kind", "a", "b", "empty").agg(F.count("*").alias("copies"))


def copy_counts(df: DataFrame, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """(kind, rows, distinct_rows, empty_rows) of each set of columns; zeros for an empty table."""
    counted = fingerprint_counts(df, kinds).groupBy("kind").agg(F.sum("copies").alias("rows"), F.count("*").alias("distinct_rows"), F.sum(F.when(F.col("empty"), F.col("copies"))).alias("empty_rows"))
    named = df.sparkSession.createDataFrame([(k,) for k in kinds], "name string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return named.join(counted, F.col("name") == F.col("kind"), "left").select(F.col("name").alias("kind"), zero("rows"), zero("distinct_rows"), zero("empty_rows"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, non_null, distinct, rows) of each column: values fold within a task, one shuffle of
    fingerprints for all columns, exact."""
    entry = lambda i, here, a, b: F.when(here, F.struct(F.lit(i).alias("i"), a.alias("a"), b.alias("b")))
    values = known_values(df, cols)
    hashed = [entry(i, v.isNotNull(), F.xxhash64(F.lit(1), v), F.xxhash64(F.lit(2), v)) for i, v in enumerate(values)]
    whole = entry(-1, F.lit(True), F.lit(0).cast("long"), F.lit(0).cast("long"))
    long = df.select(F.explode(F.array(whole, *hashed)).alias("f")).filter("f is not null").select("f.*")
    counted = long.groupBy("i", "a", "b").agg(F.count("*").alias("n")).groupBy("i").agg(F.sum("n").alias("non_null"), F.count("*").alias("distinct"))
    named = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "place int, column string")
    # Every column's row carries the total, which came with the same shuffle: a group of its own, joined by key.
    rows = counted.filter("i < 0").select(F.lit(0).alias("all"), F.col("non_null").alias("rows"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    joined = named.join(counted, F.col("place") == F.col("i"), "left").select("place", "column", zero("non_null"), zero("distinct"))
    return joined.withColumn("one", F.lit(0)).join(rows, F.col("one") == F.col("all"), "left").orderBy("place").select("column", "non_null", "distinct", zero("rows"))
