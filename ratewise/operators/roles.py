"""Column roles, read from the schema only (no job runs here)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names that denote a place, besides any name containing 'aeropuerto'.
PLACE_PATTERN = "aeropuerto"
PLACE_NAMES = ("aeropuerto", "origen", "destino", "aeropuerto_origen", "aeropuerto_destino", "origen_iata", "destino_iata")
PLACE_NAMES_WIDE = PLACE_NAMES + ("airport_origin", "airport_destination")


class MissingColumns(ValueError):
    def __init__(self, missing: Sequence[str]):
        super().__init__(f"missing columns: {', '.join(missing)}")
        self.missing = list(missing)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(missing)
    return df


def has_columns(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def classify_columns(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str], list[str]]:
    """(numeric, categorical, other). Dates, timestamps and nested types are 'other'."""
    skip = set(exclude)
    numeric, categorical, other = [], [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            categorical.append(f.name)
        else:
            other.append(f.name)
    return numeric, categorical, other


def role_table(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    numeric, categorical, other = classify_columns(df, exclude)
    dtypes = dict(df.dtypes)
    rows = [
        (c, dtypes[c], role)
        for role, cols in (("numeric", numeric), ("categorical", categorical), ("other", other))
        for c in cols
    ]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string, role string")


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def place_columns(df: DataFrame, pattern: str = PLACE_PATTERN, names: Iterable[str] = PLACE_NAMES) -> list[str]:
    """String columns named like a place."""
    known = set(names)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
        and (pattern in f.name.lower().strip() or f.name.lower().strip() in known)
    ]


def target_last(df: DataFrame, target: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != target], F.col(f"`{target}`"))


def feature_columns(df: DataFrame, target: str, ids: Iterable[str] = ()) -> list[str]:
    skip = {target, *ids}
    return [c for c in df.columns if c not in skip]


def target_summary(df: DataFrame, target: str, ids: Iterable[str] = ()) -> DataFrame:
    """Number of features, class counts and share of positives."""
    y = F.col(target)
    return df.agg(
        F.lit(len(feature_columns(df, target, ids))).cast("long").alias("features"),
        F.count("*").alias("rows"),
        F.count_if(y == 0).alias("zeros"),
        F.count_if(y == 1).alias("ones"),
        F.round(F.avg(y) * 100, 4).alias("positive_pct"),
    )


def column_pairs(names: Sequence[str], limit: int | None = None) -> list[tuple[str, str]]:
    """All pairs of column names without repeats, or the first ``limit`` of them."""
    pairs = list(combinations(names, 2))
    return pairs if limit is None else pairs[:limit]
