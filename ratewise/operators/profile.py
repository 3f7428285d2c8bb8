"""Column profiles and cleaning checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ratewise.functions.columns import known_number
from ratewise.functions.stats import sample_kurtosis, sample_skewness
from ratewise.operators.fingerprints import copy_counts, distinct_counts, fingerprint, fingerprint_counts, known_values
from ratewise.operators.onepass import OnePass, run
from ratewise.operators.quantiles import order_statistics, quantile, quantile_row
from ratewise.operators.reshape import rows_of, value_counts
from ratewise.sources.scratch import stage

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def tidy(x, digits: int):
    """Half-up rounding after cutting off the float noise of sums and interpolation, so that a value that
    lies on a rounding tie in decimal falls to the same side however it was computed."""
    return F.round(F.round(x, 9), digits)


def _pct(part, whole):
    return F.try_divide(part * 100.0, whole)


def describe_schema(df: DataFrame, approximate: bool = False) -> DataFrame:
    """dtype, non-null, null and distinct count of every column; NaN counts as null. Exact distinct counts come from one
    shuffle of fingerprints; with ``approximate`` one scan of sketches gives them."""
    dtypes = dict(df.dtypes)
    named = F.create_map(*[F.lit(x) for c in df.columns for x in (c, dtypes[c])])
    if not approximate:
        counts = distinct_counts(df, df.columns)
        return counts.select("column", F.element_at(named, F.col("column")).alias("dtype"), "non_null", (F.col("rows") - F.col("non_null")).alias("nulls"), "distinct")
    values = known_values(df, df.columns)
    flat = df.agg(
        F.count("*").alias("rows"),
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)],
        *[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(values)],
    )
    return rows_of(
        flat,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(dtypes[c]).alias("dtype"),
                F.col(f"n{i}").alias("non_null"),
                (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                F.col(f"d{i}").alias("distinct"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


def table_nulls_pass(df: DataFrame) -> OnePass:
    width = len(df.columns)
    nulls = sum((v.isNull().cast("long") for v in known_values(df, df.columns)), F.lit(0).cast("long"))
    return OnePass(
        {"rows": F.count("*"), "null_cells": F.coalesce(F.sum(nulls), F.lit(0)).cast("long")},
        lambda flat: flat.select(
            "rows",
            F.lit(width).cast("long").alias("columns"),
            "null_cells",
            F.round(_pct(F.col("null_cells"), F.col("rows") * width), 2).alias("null_pct"),
        ),
    )


def table_nulls(df: DataFrame) -> DataFrame:
    """Rows, columns, null cells and their share of all cells."""
    return run(df, table_nulls_pass(df))


def null_report_pass(df: DataFrame) -> OnePass:
    counts = {f"n{i}": F.count_if(v.isNull()) for i, v in enumerate(known_values(df, df.columns))}
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("nulls"),
            F.round(_pct(F.col(f"n{i}"), F.col("rows")), 2).alias("null_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return OnePass(
        {"rows": F.count("*"), **counts}, lambda flat: rows_of(flat, lines).orderBy(F.col("nulls").desc(), "column")
    )


def null_report(df: DataFrame) -> DataFrame:
    """Nulls per column with their share, most first."""
    return run(df, null_report_pass(df))


def duplicate_share(counts: DataFrame) -> DataFrame:
    """rows, duplicates and their share from (rows, distinct_rows)."""
    return counts.select(
        "rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
        F.round(_pct(F.col("rows") - F.col("distinct_rows"), F.col("rows")), 2).alias("duplicate_pct"),
    )


def duplicate_count(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that repeat an earlier row, missing values being equal. One shuffle of fingerprints; copies of a hot
    row are folded before it."""
    return duplicate_share(copy_counts(df, {"rows": [c for c in df.columns if c not in set(ignore)]}))


def duplicate_examples(df: DataFrame, ignore: Sequence[str] = (), n: int = 6) -> DataFrame:
    """The first n members of duplicate groups, in the order of their values. Rows are read in full only where a
    fingerprint repeats, and a group contributes at most n copies before the top-n."""
    cols = [c for c in df.columns if c not in set(ignore)]
    repeated = stage(fingerprint_counts(df, {"rows": cols}).filter("copies > 1").select(F.col("a").alias("f_a"), F.col("b").alias("f_b")), "repeated")
    a, b = fingerprint(df, cols)
    rows = df.select(*[v.alias(c) for v, c in zip(known_values(df, cols), cols)], a.alias("_a"), b.alias("_b"))
    rows = rows.join(repeated, (F.col("_a") == F.col("f_a")) & (F.col("_b") == F.col("f_b")), "left_semi")
    groups = rows.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count("*").alias("copies"))
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(n)).cast("int")))
    return groups.filter("copies > 1").withColumn("copy", copies).orderBy(*[f"`{c}`" for c in cols], "copy").limit(n)


def id_share(counts: DataFrame) -> DataFrame:
    """Distinct ids, rows and whether they agree, from the counts of the id column; a missing id is no id."""
    ids = F.col("distinct_rows") - (F.col("empty_rows") > 0).cast("long")
    return counts.select(ids.alias("distinct_ids"), "rows", (ids == F.col("rows")).alias("unique"))


def id_uniqueness(df: DataFrame, id_column: str) -> DataFrame:
    return id_share(copy_counts(df, {"ids": [id_column]}))


def numeric_summary(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, optionally per group. The plain statistics are taken
    in the first quantile round; the ends are ranks like the others."""
    table = quantile_row(df, cols, {"min": 0.0, "max": 1.0, **QUARTILES}, by, moments=True)
    rounded = [tidy(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "max", *QUARTILES)]
    return table.select(*by, "column", "count", *rounded)


def shape_flags_pass(cols: Sequence[str]) -> OnePass:
    moments = {f"s{i}": sample_skewness(known_number(c)) for i, c in enumerate(cols)}
    moments |= {f"k{i}": sample_kurtosis(known_number(c)) for i, c in enumerate(cols)}
    lines = [
        F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("skewness"), F.col(f"k{i}").alias("kurtosis"))
        for i, c in enumerate(cols)
    ]
    s, k = F.abs("skewness"), F.abs("kurtosis")
    return OnePass(
        moments,
        lambda flat: rows_of(flat, lines).select(
            "column",
            F.round("skewness", 6).alias("skewness"),
            F.when(s > 2, "high").when(s > 1, "moderate").otherwise("low").alias("skew_level"),
            F.round("kurtosis", 6).alias("kurtosis"),
            F.coalesce(k > 7, F.lit(False)).alias("heavy_tails"),
        ),
    )


def shape_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Corrected skewness and excess kurtosis per column with their levels."""
    return run(df, shape_flags_pass(cols))


def skewness_flag(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return shape_flags(df, cols).select("column", "skewness", "skew_level")


def kurtosis_flag(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return shape_flags(df, cols).select("column", "kurtosis", "heavy_tails")


def iqr_limits(df: DataFrame, cols: Sequence[str], factor: float = 1.5, seen: DataFrame | None = None) -> DataFrame:
    """Quartiles and the limits they set; ``seen`` reuses order statistics that hold the quartiles."""
    seen = order_statistics(df, cols, list(QUARTILES.values())) if seen is None else seen
    iqr = F.col("q3") - F.col("q1")
    return seen.select("column", *[quantile(q).alias(name) for name, q in QUARTILES.items()]).select(
        "column",
        "q1",
        "median",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - factor * iqr).alias("low"),
        (F.col("q3") + factor * iqr).alias("high"),
    )


def iqr_pass(limits: Sequence[Row], pct_base: str = "all") -> OnePass:
    """Counts outside known limits, one row of limits per column."""
    aggregates, lines = {"rows": F.count("*")}, []
    for i, r in enumerate(limits):
        x = known_number(r["column"])
        aggregates[f"n{i}"] = F.count(x)
        aggregates[f"o{i}"] = F.count_if((x < r["low"]) | (x > r["high"]))
        whole = F.col("rows") if pct_base == "all" else F.col(f"n{i}")
        lines.append(
            F.struct(
                F.lit(r["column"]).alias("column"),
                *[F.round(F.lit(r[k]), 6).alias(k) for k in ("q1", "q3", "iqr", "low", "high")],
                F.col(f"o{i}").alias("outliers"),
                F.round(_pct(F.col(f"o{i}"), whole), 4).alias("pct"),
            )
        )
    return OnePass(aggregates, lambda flat: rows_of(flat, lines))


def iqr_outliers(df: DataFrame, cols: Sequence[str], pct_base: str = "all", factor: float = 1.5) -> DataFrame:
    """Values outside q1 - f·iqr .. q3 + f·iqr. The share is over all rows or over non-null values."""
    limits = iqr_limits(df, cols, factor).collect()  # one row per column
    return run(df, iqr_pass(limits, pct_base))


def zscore_outliers(df: DataFrame, cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Values further than ``limit`` population standard deviations from the mean; share over all rows."""
    moments = df.agg(
        *[F.avg(known_number(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(known_number(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    hits = []
    for i, c in enumerate(cols):
        mean, std = moments[f"m{i}"], moments[f"s{i}"]
        far = F.lit(False) if not std else F.abs(known_number(c) - F.lit(mean)) / F.lit(std) > limit
        hits.append(F.count_if(far).alias(f"o{i}"))
    flat = df.agg(F.count("*").alias("rows"), *hits)
    return rows_of(
        flat,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"o{i}").alias("outliers"),
                F.round(_pct(F.col(f"o{i}"), F.col("rows")), 4).alias("pct"),
            )
            for i, c in enumerate(cols)
        ],
    )


def outlier_columns_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return iqr_outliers(df, cols).agg(
        F.count_if(F.col("outliers") > 0).alias("columns_with_outliers"), F.count("*").alias("columns")
    )


def zero_negative_pass(cols: Sequence[str]) -> OnePass:
    counts = {f"z{i}": F.count_if(F.col(f"`{c}`") == 0) for i, c in enumerate(cols)}
    counts |= {f"n{i}": F.count_if(F.col(f"`{c}`") < 0) for i, c in enumerate(cols)}
    lines = [
        F.struct(F.lit(c).alias("column"), F.col(f"z{i}").alias("zeros"), F.col(f"n{i}").alias("negatives"))
        for i, c in enumerate(cols)
    ]
    return OnePass(counts, lambda flat: rows_of(flat, lines))


def zero_negative_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return run(df, zero_negative_pass(cols))


def spaced_ranks(share: float = 0.25) -> list[float]:
    """Quantiles spaced closer than ``share``: a value that holds more than that much is at one of them."""
    return [i / (math.floor(1 / share) + 1) for i in range(math.floor(1 / share) + 2)]


def dominant_candidates(seen: DataFrame, share: float = 0.25) -> list[tuple[str, float]]:
    """(column, value) pairs that may hold more than ``share`` of a column, from order statistics at ``spaced_ranks``."""
    at = [F.element_at("at", F.floor(F.lit(q) * (F.col("n") - 1)).cast("long")) for q in spaced_ranks(share)]
    rows = seen.select("column", F.array_distinct(F.array(*at)).alias("at")).collect()  # one row per column
    return [(r["column"], v) for r in rows for v in r["at"]]


def dominant_pass(candidates: Sequence[tuple[str, float]], share: float = 0.25) -> OnePass:
    """Exact counts of the candidates; keeps the most frequent one per column if it passes the share."""
    cols = list(dict.fromkeys(c for c, _ in candidates))
    aggregates = {f"n{i}": F.count(known_number(c)) for i, c in enumerate(cols)}
    lines = []
    for j, (c, v) in enumerate(candidates):
        aggregates[f"h{j}"] = F.count_if(F.col(f"`{c}`").cast("double") == F.lit(v))
        lines.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(float(v)).alias("value"),
                F.col(f"h{j}").alias("rows"),
                F.try_divide(F.col(f"h{j}").cast("double"), F.col(f"n{cols.index(c)}")).alias("share"),
            )
        )
    first = F.max_by(F.struct("value", "rows", "share"), F.struct("rows", -F.col("value")))
    return OnePass(
        aggregates,
        lambda flat: rows_of(flat, lines)
        .groupBy("column")
        .agg(first.alias("b"))
        .filter(F.col("b.share") > share)
        .select("column", "b.value", "b.rows", F.round(F.col("b.share") * 100, 4).alias("pct")),
    )


def dominant_value(df: DataFrame, cols: Sequence[str], share: float = 0.25) -> DataFrame:
    """Columns where one value holds more than ``share`` of the non-null values. Nothing but digits and
    counters is shuffled."""
    candidates = dominant_candidates(order_statistics(df, cols, spaced_ranks(share)), share)
    if not candidates:
        return df.sparkSession.createDataFrame([], "column string, value double, rows bigint, pct double")
    return run(df, dominant_pass(candidates, share))


def category_proportions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count of every category, its share of all rows and of the non-null rows. The counts are stored, so
    the rows are read once; the totals have one row per column, so they are broadcast. Null counts stay in
    until the totals are taken, which gives the number of rows without another scan."""
    counts = stage(value_counts(df, cols, nulls=True), "category-counts")
    totals = counts.groupBy("column").agg(
        F.sum("rows").alias("all_rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))).alias("present")
    )
    return (
        counts.filter(F.col("value").isNotNull())
        .join(F.broadcast(totals), "column")
        .select(
            "column",
            "value",
            "rows",
            F.round(_pct(F.col("rows"), F.col("all_rows")), 2).alias("pct_of_rows"),
            F.round(F.col("rows") / F.col("present"), 6).alias("share_of_present"),
        )
    )


def category_shares_of(counts: DataFrame) -> DataFrame:
    """(column, value, rows, pct) from stored (column, value, rows) counts: each category's share of the present values."""
    totals = counts.groupBy(F.col("column").alias("t_column")).agg(F.sum("rows").alias("present"))
    shares = counts.join(F.broadcast(totals), F.col("column") == F.col("t_column"))  # one row per column
    return shares.select("column", "value", "rows", F.round(F.col("rows") * 100.0 / F.col("present"), 4).alias("pct"))


def category_summary(
    df: DataFrame, cols: Sequence[str], many: int = 30, dominant: float = 0.80, rare: float = 0.01
) -> DataFrame:
    """Per categorical column: number of categories, most frequent one and its share, and how many
    categories lie below the rare share."""
    return category_summary_of(stage(value_counts(df, cols), "category-counts"), many, dominant, rare)


def category_summary_of(counts: DataFrame, many: int = 30, dominant: float = 0.80, rare: float = 0.01) -> DataFrame:
    """The same from stored (column, value, rows) counts; the totals have one row per column."""
    totals = counts.groupBy("column").agg(F.sum("rows").alias("present"))
    share = F.col("rows") / F.col("present")
    return (
        counts.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(
            F.count("*").alias("categories"),
            F.min_by("value", F.struct(-F.col("rows"), "value")).alias("top_value"),
            F.round(F.max(share), 6).alias("top_share"),
            F.max(share).alias("raw_share"),
            F.count_if(share < rare).alias("rare_categories"),
        )
        .select(
            "*",
            (F.col("categories") > many).alias("high_cardinality"),
            (F.col("raw_share") > dominant).alias("dominant_category"),
        )
        .drop("raw_share")
    )


def high_cardinality(df: DataFrame, cols: Sequence[str], many: int = 30) -> DataFrame:
    return category_summary(df, cols, many=many).select("column", "categories", "high_cardinality")


def dominant_category(df: DataFrame, cols: Sequence[str], dominant: float = 0.80) -> DataFrame:
    return category_summary(df, cols, dominant=dominant).select("column", "top_value", "top_share", "dominant_category")


def rare_categories(df: DataFrame, cols: Sequence[str], rare: float = 0.01) -> DataFrame:
    return category_summary(df, cols, rare=rare).select("column", "rare_categories")
