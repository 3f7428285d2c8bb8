"""Cleaning and feature building: deduplicate, impute, scale, encode; fit once, apply anywhere."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.columns import category_text, decimal_hour, extract_hour_of, known_number, time_band_5
from ratewise.operators.filters import Rule, apply_rules, filter_report
from ratewise.operators.quantiles import exact_quantiles
from ratewise.operators.reshape import value_counts
from ratewise.operators.roles import classify_columns, drop_columns, require_columns, target_last
from ratewise.sources.scratch import stage

MAX_CATEGORIES = 500


def drop_duplicates(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop the ignored (id) columns, then keep one row of every group of equal rows."""
    return drop_columns(df, ignore).dropDuplicates()


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, cols, [0.5]).select("column", F.col("value").alias("median"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent category per column, the smallest text on ties."""
    return modes_of(value_counts(df, cols))


def modes_of(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("rows"), "value")).alias("mode"))


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = {r["column"]: r["median"] for r in medians(df, cols).collect()}  # one row per column
    return df.withColumns({c: F.coalesce(known_number(c), F.lit(found.get(c))) for c in cols})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = {r["column"]: r["mode"] for r in modes(df, cols).collect()}  # one row per column
    return df.withColumns({c: F.coalesce(category_text(df, c), F.lit(found.get(c))) for c in cols})


def scaled(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """(x - lo) / (hi - lo); 0 for a constant column."""
    x = known_number(c) if isinstance(c, str) else c.cast("double")
    x = F.when(~F.isnan(x), x)
    if lo is None or hi is None or lo == hi:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(lo))) / F.lit(float(hi) - float(lo))


def ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """min and max of every column, one aggregate."""
    if not cols:
        return {}
    row = df.agg(
        *[F.min(known_number(c)).alias(f"l{i}") for i, c in enumerate(cols)],
        *[F.max(known_number(c)).alias(f"h{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(cols)}


def min_max_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = ranges(df, cols)
    return df.withColumns({c: scaled(c, *found[c]) for c in cols})


def categories(df: DataFrame, cols: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted categories per column, refusing columns with more than ``limit``."""
    return categories_of(stage(value_counts(df, cols), "categories"), cols, limit) if cols else {}


def categories_of(counts: DataFrame, cols: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """The same from stored (column, value, rows) counts. The sizes are checked before any value is fetched."""
    sizes = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.count("*").alias("n")).collect()}
    wide = [c for c in cols if sizes.get(c, 0) > limit]
    if wide:
        raise ValueError(f"too many categories to encode in: {', '.join(wide)}; drop them or use one_hot_vector")
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in counts.select("column", "value").collect():  # at most len(cols) x limit rows
        found[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def indicator_columns(df: DataFrame, levels: dict[str, list[str]]) -> list[Column]:
    """0/1 columns ``column_value`` for every category but the first; null gives zeros everywhere."""
    return [
        F.coalesce((category_text(df, c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in levels.items()
        for v in values[1:]
    ]


def one_hot_drop_first(df: DataFrame, cols: Sequence[str], limit: int = MAX_CATEGORIES) -> DataFrame:
    levels = categories(df, cols, limit)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in set(cols)]
    return df.select(*kept, *indicator_columns(df, levels))


def one_hot_vector(df: DataFrame, cols: Sequence[str], name: str = "encoded") -> tuple[DataFrame, DataFrame]:
    """The same encoding for columns of any number of categories: the columns are replaced by one sparse vector,
    and a second frame (position, column, value) says what each place of the vector stands for. The smallest
    category of a column and null have no place. A column with less than two categories adds nothing."""
    sizes = df.agg(
        *[F.min(category_text(df, c)).alias(f"f{i}") for i, c in enumerate(cols)],
        *[F.max(category_text(df, c)).alias(f"l{i}") for i, c in enumerate(cols)],
    ).first()
    used = [(c, sizes[f"f{i}"]) for i, c in enumerate(cols) if sizes[f"f{i}"] != sizes[f"l{i}"]]
    labels = df.sparkSession.createDataFrame([], "position int, column string, value string")
    if not used:
        return df.drop(*cols).withColumn(name, array_to_vector(F.array().cast("array<double>"))), labels
    text, code, slots = ([f"_{kind}{i}" for i in range(len(used))] for kind in ("text", "code", "slots"))
    filled = df.withColumns({t: F.coalesce(category_text(df, c), F.lit(first)) for t, (c, first) in zip(text, used)})
    # Descending order puts the smallest category last, which is the one the encoder leaves out.
    index = StringIndexer(inputCols=text, outputCols=code, stringOrderType="alphabetDesc").fit(filled)
    coded = index.transform(filled)
    encoded = OneHotEncoder(inputCols=code, outputCols=slots).fit(coded).transform(coded)
    joined = VectorAssembler(inputCols=slots, outputCol=name).transform(encoded).drop(*cols, *text, *code, *slots)
    places = [(c, v) for (c, _), values in zip(used, index.labelsArray) for v in values[:-1]]
    rows = [(i, c, v) for i, (c, v) in enumerate(places)]
    return joined, df.sparkSession.createDataFrame(rows, labels.schema)


@dataclass
class ViewSpec:
    """What to prepare: the target, columns to drop, row rules, and how to use a departure-hour column."""

    target: str
    drop: Sequence[str] = ()
    rules: Sequence[Rule] = ()
    hour: str | None = None
    band_name: str = "franja_horaria"
    decimal_name: str = "timestamp_vuelo"
    add_band: bool = True
    add_decimal: bool = True
    deduplicate: bool = True
    max_categories: int = MAX_CATEGORIES


@dataclass
class ViewParams:
    """Everything learned from the fitting rows; enough to transform unseen rows the same way."""

    numeric: list[str]
    categorical: list[str]
    median: dict[str, float | None] = field(default_factory=dict)
    mode: dict[str, str | None] = field(default_factory=dict)
    low: dict[str, float | None] = field(default_factory=dict)
    high: dict[str, float | None] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)
    rows: int = 0

    def feature_names(self) -> list[str]:
        return self.numeric + [f"{c}_{v}" for c, vs in self.levels.items() for v in vs[1:]]


def derive(df: DataFrame, spec: ViewSpec) -> DataFrame:
    """Row rules, then the hour-derived columns, then the column drops. Purely narrow."""
    require_columns(df, spec.target, *([spec.hour] if spec.hour else []))
    out = apply_rules(df, spec.rules) if spec.rules else df
    if spec.hour is not None:
        if spec.add_band:
            out = out.withColumn(spec.band_name, time_band_5(extract_hour_of(df, spec.hour)))
        if spec.add_decimal:
            out = out.withColumn(spec.decimal_name, decimal_hour(spec.hour))
    return drop_columns(out, spec.drop)


def fit_view(clean: DataFrame, spec: ViewSpec) -> ViewParams:
    """Learn medians, modes, ranges and categories: one aggregate for sizes, nulls and ranges (imputed
    medians never leave the range, so ranges may be taken first), one table of category counts for
    categories and modes, and quantile passes over the columns that need a median."""
    numeric, categorical, _ = classify_columns(clean, [spec.target])
    flat = clean.agg(
        F.count("*").alias("rows"),
        *[F.count_if(known_number(c).isNull() if c in numeric else F.col(f"`{c}`").isNull()).alias(f"x{i}") for i, c in enumerate(numeric + categorical)],
        *[F.min(known_number(c)).alias(f"l{i}") for i, c in enumerate(numeric)],
        *[F.max(known_number(c)).alias(f"h{i}") for i, c in enumerate(numeric)],
    ).first()
    params = ViewParams(numeric, categorical, rows=flat["rows"])
    params.nulls = {c: flat[f"x{i}"] for i, c in enumerate(numeric + categorical) if flat[f"x{i}"]}
    params.low = {c: flat[f"l{i}"] for i, c in enumerate(numeric)}
    params.high = {c: flat[f"h{i}"] for i, c in enumerate(numeric)}
    if categorical:
        counts = stage(value_counts(clean, categorical), "categories")
        params.levels = categories_of(counts, categorical, spec.max_categories)
    gaps = [c for c in numeric if c in params.nulls]
    if gaps:
        params.median = {r["column"]: r["median"] for r in medians(clean, gaps).collect()}
    gaps = [c for c in categorical if c in params.nulls]
    if gaps:
        params.mode = {r["column"]: r["mode"] for r in modes_of(counts).collect() if r["column"] in gaps}
    return params


def encode(clean: DataFrame, params: ViewParams, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Impute, scale and encode derived rows with fitted parameters; literals only, no join."""
    filled = clean.withColumns(
        {c: F.coalesce(known_number(c), F.lit(params.median.get(c))) for c in params.numeric}
        | {c: F.coalesce(category_text(clean, c), F.lit(params.mode.get(c))) for c in params.categorical}
    )
    numeric = [scaled(c, params.low[c], params.high[c]).alias(c) for c in params.numeric]
    out = filled.select(*keep, *numeric, *indicator_columns(filled, params.levels), F.col(f"`{target}`"))
    return target_last(out, target)


def apply_view(df: DataFrame, spec: ViewSpec, params: ViewParams, keep: Sequence[str] = ()) -> DataFrame:
    """Prepare unseen rows with stored parameters: no deduplication and no new fitting."""
    kept_spec = ViewSpec(**{**spec.__dict__, "drop": [c for c in spec.drop if c not in set(keep)]})
    return encode(derive(df, kept_spec), params, spec.target, keep)


def build_view(df: DataFrame, spec: ViewSpec) -> tuple[DataFrame, ViewParams]:
    """The whole preparation. The cleaned rows are written once, since fitting and encoding read them
    several times and the deduplication shuffle must not be repeated."""
    clean = derive(df, spec)
    if spec.deduplicate:
        clean = stage(clean.dropDuplicates(), "clean")
    params = fit_view(clean, spec)
    return encode(clean, params, spec.target), params


def params_table(df_session: DataFrame, params: ViewParams) -> DataFrame:
    """Fitted parameters as rows (column, kind, text, number); bounded by columns and categories."""
    rows = []
    for c in params.numeric:
        rows.append((c, "min", None, params.low[c]))
        rows.append((c, "max", None, params.high[c]))
        if c in params.median:
            rows.append((c, "median", None, params.median[c]))
    for c in params.categorical:
        if c in params.mode:
            rows.append((c, "mode", params.mode[c], None))
        rows += [(c, "level", v, float(i)) for i, v in enumerate(params.levels[c])]
    return df_session.sparkSession.createDataFrame(rows, "column string, kind string, text string, number double")


def params_from_table(table: DataFrame, order: Sequence[str]) -> ViewParams:
    """Rebuild parameters from their table; ``order`` is the column order of the prepared input."""
    rows = table.collect()  # bounded by columns and categories
    numeric = {r["column"] for r in rows if r["kind"] == "min"}
    categorical = {r["column"] for r in rows if r["kind"] == "level"}
    p = ViewParams([c for c in order if c in numeric], [c for c in order if c in categorical])
    levels: dict[str, list[tuple[float, str]]] = {c: [] for c in p.categorical}
    for r in rows:
        if r["kind"] == "min":
            p.low[r["column"]] = r["number"]
        elif r["kind"] == "max":
            p.high[r["column"]] = r["number"]
        elif r["kind"] == "median":
            p.median[r["column"]] = r["number"]
        elif r["kind"] == "mode":
            p.mode[r["column"]] = r["text"]
        else:
            levels[r["column"]].append((r["number"], r["text"]))
    p.levels = {c: [v for _, v in sorted(vs)] for c, vs in levels.items()}
    return p


def view_metadata(
    raw: DataFrame, view: DataFrame, spec: ViewSpec, params: ViewParams, view_id: str
) -> DataFrame:
    """Scaled columns, indicators per variable, filter counts, imputations, size and class counts."""
    spark = view.sparkSession
    rows: list[tuple] = [(view_id, "scaled", c, i, None, None) for i, c in enumerate(params.numeric)]
    for c, values in params.levels.items():
        rows += [(view_id, "indicator", c, i, f"{c}_{v}", None) for i, v in enumerate(values[1:])]
    rows += [(view_id, "dropped", c, i, None, None) for i, c in enumerate(spec.drop) if c in raw.columns]
    for c, n in params.nulls.items():
        fill = params.mode.get(c) if c in params.mode else None
        rows.append((view_id, "imputed", c, 0, fill, float(n)))
        if c in params.median and params.median[c] is not None:
            rows.append((view_id, "median", c, 0, None, float(params.median[c])))
    rows.append((view_id, "size", "features", 1, None, float(len(params.feature_names()))))
    schema = "view_id string, item string, name string, position int, text string, number double"
    fixed = spark.createDataFrame(rows, schema)
    y = F.col(f"`{spec.target}`")
    counts = view.agg(
        F.count("*").cast("double").alias("n"),
        F.count_if(y == 0).cast("double").alias("zero"),
        F.count_if(y == 1).cast("double").alias("one"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(view_id).alias("view_id"),
                        F.lit(item).alias("item"),
                        F.lit(name).alias("name"),
                        F.lit(pos).alias("position"),
                        F.lit(None).cast("string").alias("text"),
                        F.col(src).alias("number"),
                    )
                    for item, name, pos, src in (
                        ("size", "rows", 0, "n"),
                        ("class", "0", 0, "zero"),
                        ("class", "1", 1, "one"),
                    )
                ]
            )
        )
    )
    out = fixed.unionByName(counts)
    if spec.rules:
        removed = filter_report(raw, spec.rules).select(
            F.lit(view_id).alias("view_id"),
            F.lit("filter").alias("item"),
            F.col("item").alias("name"),
            F.lit(0).alias("position"),
            F.lit(None).cast("string").alias("text"),
            F.col("rows").cast("double").alias("number"),
        )
        out = out.unionByName(removed)
    return out
