"""Scalar column expressions. All stay JVM-side; none needs a UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as a positive outcome.
POSITIVE_WORDS = ("1", "si", "sí", "true", "demorado", "delay", "delayed")

# Names of the five departure bands and of the four six-hour bands.
MORNING, MIDDAY, AFTERNOON, NIGHT, EARLY = "manana", "mediodia", "tarde", "noche", "madrugada"
SIX_HOUR_BANDS = ("madrugada", "manana", "tarde", "noche")

HOUR_PATTERN = r"(\d{1,2})"
MINUTE_PATTERN = r"\d{1,2}:(\d{2})"


def known_number(c: str) -> Column:
    """The column as a double, with NaN as null: both mean that the value is missing."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_rate(amount: str | Column, minutes: str | Column, on_zero: str = "null") -> Column:
    """Amount per hour. ``on_zero='inf'`` gives ±infinity for x/0 and NaN for 0/0,
    which comparisons can then treat as 'very fast'; 'null' is safe inside averages."""
    a, m = as_column(amount).cast("double"), as_column(minutes).cast("double")
    rate = F.try_divide(a, m) * F.lit(60.0)
    if on_zero == "null":
        return rate
    unbounded = (
        F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).when(a == 0, F.lit(float("nan")))
    )
    return F.when(m == 0, unbounded).otherwise(rate)


def extract_hour(c: str | Column) -> Column:
    """First one or two digits of a text as an int; null when there are none."""
    return F.regexp_extract(as_column(c).cast("string"), HOUR_PATTERN, 1).try_cast("int")


def extract_hour_of(df: DataFrame, name: str) -> Column:
    """``hour()`` for timestamp columns, the text rule for everything else."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.hour(name)
    return extract_hour(name)


def decimal_hour(c: str | Column) -> Column:
    """14:30 -> 14.5; missing minutes count as 0."""
    minutes = F.regexp_extract(as_column(c).cast("string"), MINUTE_PATTERN, 1).try_cast("double")
    return extract_hour(c).cast("double") + F.coalesce(minutes, F.lit(0.0)) / F.lit(60.0)


def time_band_5(hour: str | Column) -> Column:
    """Morning 7-11, midday 12-15, afternoon 16-19, early 1-6, everything else night."""
    h = as_column(hour).cast("int")
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(h.between(7, 11), MORNING)
        .when(h.between(12, 15), MIDDAY)
        .when(h.between(16, 19), AFTERNOON)
        .when(h.between(1, 6), EARLY)
        .otherwise(NIGHT)
    )


def time_band_4(hour: str | Column) -> Column:
    """Left-closed six-hour bands over [0, 24); null outside."""
    h = as_column(hour)
    early, morning, afternoon, night = SIX_HOUR_BANDS
    return (
        F.when((h >= 0) & (h < 6), early)
        .when((h >= 6) & (h < 12), morning)
        .when((h >= 12) & (h < 18), afternoon)
        .when((h >= 18) & (h < 24), night)
    )


def valid_hour(hour: str | Column) -> Column:
    return as_column(hour).between(0, 23)


def binary_indicator(df: DataFrame, name: str) -> Column:
    """0/1 outcome, never null: numeric and boolean columns compare with 1, texts with POSITIVE_WORDS."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        hit = c
    elif isinstance(dtype, T.NumericType):
        hit = c == 1
    else:
        hit = F.lower(F.trim(c.cast("string"))).isin(*POSITIVE_WORDS)
    return F.coalesce(hit, F.lit(False)).cast("int")


def label_map(c: str | Column, labels: Mapping[object, str]) -> Column:
    """Look a value up in a small literal map; unknown values give null."""
    expr, col = None, as_column(c)
    for value, text in labels.items():
        expr = F.when(col == F.lit(value), text) if expr is None else expr.when(col == F.lit(value), text)
    return expr if expr is not None else F.lit(None).cast("string")


def category_text(df: DataFrame, name: str) -> Column:
    """Category as text; booleans read 'True' / 'False'."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.initcap(c.cast("string"))
    return c.cast("string")


def bin_edges(lo: float, hi: float, n: int) -> tuple[float, float]:
    """(start, width) of n equal bins over [lo, hi]; a constant column is widened by 0.1 % each way."""
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - pad, hi + pad
    return lo, (hi - lo) / n


def _bin_type(n: int) -> str:
    """Bins that far values make too many for an int are longs."""
    return "int" if n < 1 << 31 else "long"


def right_closed_bin(c: str | Column, start: float, width: float, n: int) -> Column:
    """1-based bin of (start+(i-1)·width, start+i·width]; the minimum falls in bin 1.
    The two corrections compare with the edge itself, so values on an edge land exactly."""
    x, s, w = as_column(c).cast("double"), F.lit(float(start)), F.lit(float(width))
    first = F.greatest(F.lit(1), F.least(F.lit(n), F.ceil((x - s) / w).cast("long")))
    down = F.when((first > 1) & (x <= s + (first - 1) * w), first - 1).otherwise(first)
    return F.when(x.isNotNull(), F.when((down < n) & (x > s + down * w), down + 1).otherwise(down)).cast(_bin_type(n))


def left_closed_bin(c: str | Column, start: float, width: float, n: int) -> Column:
    """1-based bin of [start+(i-1)·width, start+i·width); the maximum falls in bin n."""
    x, s, w = as_column(c).cast("double"), F.lit(float(start)), F.lit(float(width))
    first = F.greatest(F.lit(1), F.least(F.lit(n), (F.floor((x - s) / w) + 1).cast("long")))
    down = F.when((first > 1) & (x < s + (first - 1) * w), first - 1).otherwise(first)
    return F.when(x.isNotNull(), F.when((down < n) & (x >= s + down * w), down + 1).otherwise(down)).cast(_bin_type(n))


def pair_key(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """The two ends of an unordered pair, smaller first."""
    return F.least(as_column(a), as_column(b)), F.greatest(as_column(a), as_column(b))


def same_pair(a: str | Column, b: str | Column, x: str, y: str) -> Column:
    """True on either direction of the pair {x, y}; null ends never match."""
    a, b = as_column(a), as_column(b)
    return F.coalesce(((a == x) & (b == y)) | ((a == y) & (b == x)), F.lit(False))


def rate_half_width(rate: str | Column, n: str | Column, z: float = 1.96) -> Column:
    """Half width of the normal confidence interval of a share ``rate`` (0-1) over n rows."""
    p = as_column(rate)
    return F.lit(z) * F.sqrt(F.try_divide(p * (F.lit(1.0) - p), as_column(n)))


def shuffle_key(ids: Sequence[str | Column], seed: int) -> Column:
    """Reproducible pseudo-random hex key of a row id: the same rows sort the same way for any
    partitioning, retry or engine. Lexicographic order of the text is the shuffle order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[as_column(c).cast("string") for c in ids]))
