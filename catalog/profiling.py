"""Profiles, cleaning checks, row filters, findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.audit_sql import SEVERITY, audit_sql
from catalog.registry import bookings, bookings_sql, logs, logs_sql, query, table, trips, trips_sql
from ratewise.operators import filters, findings, fingerprints, profile, roles
from ratewise.plans import flows
from ratewise.sources.scratch import stage

NUM = ("distance", "minutes", "load", "surcharge", "visibility")
CATS = ("weather", "congestion", "shape", "high_season")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _long(cols: tuple[str, ...]) -> str:
    return _union([f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM t" for c in cols])


def _long_text(cols: tuple[str, ...]) -> str:
    def text(c: str) -> str:
        return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END" if c == "high_season" else c

    return _union([f"SELECT '{c}' AS \"column\", {text(c)} AS value FROM t" for c in cols])


# --- schema, nulls, duplicates ----------------------------------------------------------------------

_EVENT_TYPES = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "load_known": "double"}


@query(
    "describe_schema",
    f"WITH t AS ({logs_sql(*_EVENT_TYPES)}) "
    + _union(
        [
            f"SELECT '{c}' AS \"column\", '{d}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
            f"count(DISTINCT {c}) AS \"distinct\" FROM t"
            for c, d in _EVENT_TYPES.items()
        ]
    ),
)
def _describe_schema(spark, sf):
    return profile.describe_schema(logs(spark, sf, *_EVENT_TYPES))


@query(
    "table_nulls",
    f"""WITH t AS ({trips_sql(*NUM, "weather")}), n AS (SELECT count(*) AS r,
    sum(({" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in (*NUM, "weather"))})) AS k FROM t)
    SELECT r AS "rows", CAST(6 AS BIGINT) AS "columns", CAST(k AS BIGINT) AS null_cells,
    round(CAST(k * 100.0 AS DOUBLE) / (r * 6), 2) AS null_pct FROM n""",
)
def _table_nulls(spark, sf):
    return profile.table_nulls(trips(spark, sf, *NUM, "weather"))


@query(
    "null_report",
    f"WITH t AS ({trips_sql(*NUM, 'weather')}) "
    + _union(
        [
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
            f"round(CAST((count(*) - count({c})) * 100.0 AS DOUBLE) / count(*), 2) AS null_pct FROM t"
            for c in (*NUM, "weather")
        ]
    ),
)
def _null_report(spark, sf):
    return profile.null_report(trips(spark, sf, *NUM, "weather"))


def _dup_sql(cols: str) -> str:
    return f"""WITH d AS (SELECT CAST(sum(n) AS BIGINT) AS r, count(*) AS k FROM (SELECT {cols}, count(*) AS n FROM lineitem GROUP BY ALL))
    SELECT r AS "rows", r - k AS duplicates, round(CAST((r - k) * 100.0 AS DOUBLE) / r, 2) AS duplicate_pct FROM d"""


@query("duplicate_count", _dup_sql("l_orderkey, l_linenumber"))
def _duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query("duplicate_count_without_id", _dup_sql("l_partkey, l_linenumber, l_returnflag"))
def _duplicate_count_without_id(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    return profile.duplicate_count(df, ["l_orderkey"])


@query(
    "duplicate_examples",
    """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    SELECT l_orderkey, l_linenumber, copies, CAST(i AS INTEGER) AS copy FROM g, unnest(range(1, copies + 1)) AS u(i)
    ORDER BY l_orderkey, l_linenumber, i LIMIT 6""",
)
def _duplicate_examples(spark, sf):
    return profile.duplicate_examples(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "id_uniqueness",
    """SELECT count(DISTINCT o_orderkey) AS distinct_ids, count(*) AS "rows", count(DISTINCT o_orderkey) = count(*) AS "unique" FROM orders""",
)
def _id_uniqueness(spark, sf):
    return profile.id_uniqueness(table(spark, sf, "orders"), "o_orderkey")


# --- numeric profiles -------------------------------------------------------------------------------

_SUMMARY = """count(value) AS "count", round(avg(value), 2) AS mean, round(stddev_samp(value), 2) AS std,
    round(min(value), 2) AS "min", round(max(value), 2) AS "max", round(quantile_cont(value, 0.25), 2) AS q1,
    round(quantile_cont(value, 0.5), 2) AS median, round(quantile_cont(value, 0.75), 2) AS q3"""


@query("numeric_summary", f'WITH t AS ({trips_sql(*NUM)}), u AS ({_long(NUM)}) SELECT "column", {_SUMMARY} FROM u GROUP BY "column"')
def _numeric_summary(spark, sf):
    return profile.numeric_summary(stage(trips(spark, sf, *NUM), "summary-input"), NUM)  # several passes over a join


@query(
    "numeric_summary_by_group",
    f"""WITH t AS ({trips_sql("visibility", "delayed")}), u AS (SELECT delayed, 'visibility' AS "column", visibility AS value FROM t)
    SELECT delayed, "column", {_SUMMARY} FROM u GROUP BY delayed, "column" """,
)
def _numeric_summary_by_group(spark, sf):
    return profile.numeric_summary(trips(spark, sf, "visibility", "delayed"), ["visibility"], ["delayed"])


@query(
    "numeric_summary_narrowed",
    f'WITH t AS ({trips_sql("distance", "visibility")}), u AS ({_long(("distance", "visibility"))}) SELECT "column", {_SUMMARY} FROM u GROUP BY "column"',
)
def _numeric_summary_narrowed(spark, sf):
    cols = ("distance", "visibility")
    return profile.numeric_summary(trips(spark, sf, *cols), cols)


_SHAPE = f"""WITH t AS ({logs_sql("load", "load_known")}), u AS ({_long(("load", "load_known"))}),
    s AS (SELECT "column", skewness(value) AS s, kurtosis(value) AS k FROM u GROUP BY "column") """


@query(
    "skewness_flag",
    _SHAPE
    + """SELECT "column", round(s, 6) AS skewness, CASE WHEN abs(s) > 2 THEN 'high' WHEN abs(s) > 1 THEN 'moderate' ELSE 'low' END AS skew_level FROM s""",
)
def _skewness_flag(spark, sf):
    return profile.skewness_flag(logs(spark, sf, "load", "load_known"), ["load", "load_known"])


@query("kurtosis_flag", _SHAPE + """SELECT "column", round(k, 6) AS kurtosis, abs(k) > 7 AS heavy_tails FROM s""")
def _kurtosis_flag(spark, sf):
    return profile.kurtosis_flag(logs(spark, sf, "load", "load_known"), ["load", "load_known"])


_IQR_COLS = ("load", "load_known")


def _iqr_sql(base: str) -> str:
    return f"""WITH t AS ({logs_sql(*_IQR_COLS)}), u AS ({_long(_IQR_COLS)}),
    q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM u GROUP BY "column"),
    l AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
    SELECT u."column", round(max(q1), 6) AS q1, round(max(q3), 6) AS q3, round(max(q3 - q1), 6) AS iqr,
    round(max(low), 6) AS low, round(max(high), 6) AS high, count(*) FILTER (WHERE value < low OR value > high) AS outliers,
    round(CAST(count(*) FILTER (WHERE value < low OR value > high) * 100.0 AS DOUBLE) / {base}, 4) AS pct
    FROM u JOIN l ON u."column" = l."column" GROUP BY u."column" """


@query("iqr_outliers", _iqr_sql("count(*)"))
def _iqr_outliers(spark, sf):
    return profile.iqr_outliers(logs(spark, sf, *_IQR_COLS), _IQR_COLS)


@query("iqr_outliers_non_null", _iqr_sql("count(value)"))
def _iqr_outliers_non_null(spark, sf):
    return profile.iqr_outliers(logs(spark, sf, *_IQR_COLS), _IQR_COLS, pct_base="non_null")


@query(
    "zscore_outliers",
    f"""WITH t AS ({logs_sql(*_IQR_COLS)}), u AS ({_long(_IQR_COLS)}),
    m AS (SELECT "column", avg(value) AS m, stddev_pop(value) AS s FROM u GROUP BY "column")
    SELECT u."column", count(*) FILTER (WHERE abs(value - m) / s > 3) AS outliers,
    round(CAST(count(*) FILTER (WHERE abs(value - m) / s > 3) * 100.0 AS DOUBLE) / count(*), 4) AS pct
    FROM u JOIN m ON u."column" = m."column" GROUP BY u."column" """,
)
def _zscore_outliers(spark, sf):
    return profile.zscore_outliers(logs(spark, sf, *_IQR_COLS), _IQR_COLS)


_NAN = f"WITH t AS ({logs_sql('load_nan')}), v AS (SELECT load_nan AS x FROM t WHERE load_nan IS NOT NULL)"


@query(
    "iqr_outliers_nan",
    _NAN
    + """, q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v),
    n AS (SELECT count(*) AS k FROM v, q WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1))
    SELECT 'load_nan' AS "column", k AS outliers FROM n""",
)
def _iqr_outliers_nan(spark, sf):
    return profile.iqr_outliers(logs(spark, sf, "load_nan"), ["load_nan"]).select("column", "outliers")


@query(
    "zscore_outliers_nan",
    _NAN
    + """, m AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM v)
    SELECT 'load_nan' AS "column", count(*) FILTER (WHERE abs(x - m) / s > 3) AS outliers FROM v, m""",
)
def _zscore_outliers_nan(spark, sf):
    return profile.zscore_outliers(logs(spark, sf, "load_nan"), ["load_nan"]).select("column", "outliers")


@query(
    "null_report_nan",
    _NAN
    + """ SELECT 'load_nan' AS "column", count(*) - count(load_nan) AS nulls,
    round(CAST((count(*) - count(load_nan)) * 100.0 AS DOUBLE) / count(*), 2) AS null_pct FROM t""",
)
def _null_report_nan(spark, sf):
    return profile.null_report(logs(spark, sf, "load_nan"))


@query(
    "outlier_columns_count",
    f"""WITH t AS ({trips_sql("distance", "load", "minutes")}), u AS ({_long(("distance", "load", "minutes"))}),
    q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM u GROUP BY "column"),
    o AS (SELECT u."column", count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n
    FROM u JOIN q ON u."column" = q."column" GROUP BY u."column")
    SELECT count(*) FILTER (WHERE n > 0) AS columns_with_outliers, count(*) AS "columns" FROM o""",
)
def _outlier_columns_count(spark, sf):
    cols = ("distance", "load", "minutes")
    return profile.outlier_columns_count(trips(spark, sf, *cols), cols)


@query(
    "zero_negative_counts",
    _union(
        [
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} = 0) AS zeros, count(*) FILTER (WHERE {c} < 0) AS negatives FROM {t}"
            for c, t in (("c_acctbal", "customer"), ("c_nationkey", "customer"))
        ]
    ),
)
def _zero_negative_counts(spark, sf):
    return profile.zero_negative_counts(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])


@query(
    "dominant_value",
    """WITH u AS (SELECT 'quality' AS "column", CAST(quality AS DOUBLE) AS value FROM labels UNION ALL
    SELECT 'toxic', CAST(toxic AS DOUBLE) FROM labels UNION ALL SELECT 'doc_id', CAST(doc_id AS DOUBLE) FROM labels),
    c AS (SELECT "column", value, count(*) AS n FROM u GROUP BY ALL),
    s AS (SELECT *, n / sum(n) OVER (PARTITION BY "column") AS share,
    row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS k FROM c)
    SELECT "column", value, n AS "rows", round(share * 100, 4) AS pct FROM s WHERE k = 1 AND share > 0.25""",
)
def _dominant_value(spark, sf):
    return profile.dominant_value(table(spark, sf, "labels"), ["quality", "toxic", "doc_id"])


# --- categorical profiles ---------------------------------------------------------------------------


@query(
    "category_proportions",
    f"""WITH t AS ({trips_sql(*CATS)}), u AS ({_long_text(CATS)}),
    n AS (SELECT "column", count(*) AS a, count(value) AS p FROM u GROUP BY "column")
    SELECT u."column", value, count(*) AS "rows", round(CAST(count(*) * 100.0 AS DOUBLE) / max(a), 2) AS pct_of_rows,
    round(count(*) / max(p), 6) AS share_of_present FROM u JOIN n ON u."column" = n."column"
    WHERE value IS NOT NULL GROUP BY u."column", value""",
)
def _category_proportions(spark, sf):
    return profile.category_proportions(trips(spark, sf, *CATS), CATS)


_SUMMARY_CATS = ("weather", "kind", "high_season")
_CATEGORY_CTE = f"""WITH t AS ({trips_sql(*_SUMMARY_CATS)}), u AS ({_long_text(_SUMMARY_CATS)}),
    c AS (SELECT "column", value, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY ALL),
    s AS (SELECT *, n / sum(n) OVER (PARTITION BY "column") AS share,
    row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS k FROM c) """


@query(
    "category_summary",
    _CATEGORY_CTE
    + """SELECT "column", count(*) AS categories, max(CASE WHEN k = 1 THEN value END) AS top_value,
    round(max(share), 6) AS top_share, count(*) FILTER (WHERE share < 0.041) AS rare_categories,
    count(*) > 20 AS high_cardinality, max(share) > 0.7 AS dominant_category FROM s GROUP BY "column" """,
)
def _category_summary(spark, sf):
    return profile.category_summary(trips(spark, sf, *_SUMMARY_CATS), _SUMMARY_CATS, many=20, dominant=0.7, rare=0.041)


@query(
    "high_cardinality",
    """SELECT 'c_mktsegment' AS "column", count(DISTINCT c_mktsegment) AS categories, count(DISTINCT c_mktsegment) > 30 AS high_cardinality FROM customer
    UNION ALL SELECT 'c_name', count(DISTINCT c_name), count(DISTINCT c_name) > 30 FROM customer""",
)
def _high_cardinality(spark, sf):
    return profile.high_cardinality(table(spark, sf, "customer"), ["c_mktsegment", "c_name"])


@query(
    "dominant_category",
    _CATEGORY_CTE
    + """SELECT "column", max(CASE WHEN k = 1 THEN value END) AS top_value, round(max(share), 6) AS top_share,
    max(share) > 0.7 AS dominant_category FROM s GROUP BY "column" """,
)
def _dominant_category(spark, sf):
    return profile.dominant_category(trips(spark, sf, *_SUMMARY_CATS), _SUMMARY_CATS, dominant=0.7)


@query(
    "rare_categories",
    _CATEGORY_CTE + """SELECT "column", count(*) FILTER (WHERE share < 0.041) AS rare_categories FROM s GROUP BY "column" """,
)
def _rare_categories(spark, sf):
    return profile.rare_categories(trips(spark, sf, *_SUMMARY_CATS), _SUMMARY_CATS, rare=0.041)


# --- row filters and domain checks ------------------------------------------------------------------


@query(
    "min_rate_filter",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "minutes")}) SELECT * FROM t WHERE distance / minutes * 60 >= 100000""",
)
def _min_rate_filter(spark, sf):
    return filters.min_rate_filter(trips(spark, sf, "order_id", "line", "distance", "minutes"), "distance", "minutes", 100000.0)


@query(
    "exclude_pair",
    f"""WITH t AS ({trips_sql("order_id", "line", "origin", "destination")}) SELECT * FROM t WHERE NOT (
    (origin = 'NATION_3' AND destination = 'NATION_7') OR (origin = 'NATION_7' AND destination = 'NATION_3'))""",
)
def _exclude_pair(spark, sf):
    return filters.exclude_pair(trips(spark, sf, "order_id", "line", "origin", "destination"), "origin", "destination", "NATION_3", "NATION_7")


def _rules():
    return [
        ("rate_too_low", filters.min_rate_rule("distance", "minutes", 50000.0)),
        ("impossible_pair", filters.exclude_pair_rule("origin", "destination", "NATION_3", "NATION_7")),
    ]


@query(
    "filter_report",
    f"""WITH t AS ({trips_sql("distance", "minutes", "origin", "destination")}),
    f AS (SELECT distance / minutes * 60 < 50000 AS a, (origin = 'NATION_3' AND destination = 'NATION_7')
    OR (origin = 'NATION_7' AND destination = 'NATION_3') AS b FROM t)
    SELECT 'rate_too_low' AS item, count(*) FILTER (WHERE a) AS "rows" FROM f UNION ALL
    SELECT 'impossible_pair', count(*) FILTER (WHERE b) FROM f UNION ALL
    SELECT 'rows_before', count(*) FROM f UNION ALL SELECT 'rows_removed', count(*) FILTER (WHERE a OR b) FROM f UNION ALL
    SELECT 'rows_after', count(*) FILTER (WHERE NOT (a OR b)) FROM f""",
)
def _filter_report(spark, sf):
    return filters.filter_report(trips(spark, sf, "distance", "minutes", "origin", "destination"), _rules())


@query("valid_range", f"WITH t AS ({logs_sql('event_id', 'hour')}) SELECT * FROM t WHERE hour BETWEEN 6 AND 17")
def _valid_range(spark, sf):
    return filters.valid_range(logs(spark, sf, "event_id", "hour"), "hour", 6, 17)


@query(
    "drop_null_rows",
    f"WITH t AS ({trips_sql('order_id', 'line', 'surcharge', 'weather')}) SELECT * FROM t WHERE surcharge IS NOT NULL AND weather IS NOT NULL",
)
def _drop_null_rows(spark, sf):
    return filters.drop_null_rows(trips(spark, sf, "order_id", "line", "surcharge", "weather"), ["surcharge", "weather"])


@query(
    "pair_set_check",
    f"""WITH t AS ({trips_sql("origin", "destination")}), c AS (SELECT count(*) AS r, count(*) FILTER (
    WHERE origin IN ('NATION_1', 'NATION_2') AND destination IN ('NATION_1', 'NATION_2') AND origin <> destination) AS h FROM t)
    SELECT r AS "rows", h AS hits, round(CAST(h * 100.0 AS DOUBLE) / r, 4) AS pct FROM c""",
)
def _pair_set_check(spark, sf):
    return filters.pair_set_check(trips(spark, sf, "origin", "destination"), "origin", "destination", ["NATION_1", "NATION_2"])


@query(
    "self_pair_check",
    f"""WITH t AS ({trips_sql("origin", "destination")}) SELECT count(*) AS "rows", count(*) FILTER (WHERE origin = destination) AS hits FROM t""",
)
def _self_pair_check(spark, sf):
    return filters.self_pair_check(trips(spark, sf, "origin", "destination"), "origin", "destination")


@query(
    "rate_band_check",
    f"""WITH t AS ({trips_sql("distance", "minutes")}), r AS (SELECT distance / minutes * 60 AS v FROM t)
    SELECT count(*) FILTER (WHERE v < 15000) AS too_slow, count(*) FILTER (WHERE v > 950000) AS too_fast FROM r""",
)
def _rate_band_check(spark, sf):
    return filters.rate_band_check(trips(spark, sf, "distance", "minutes"), "distance", "minutes", 15000.0, 950000.0)


@query(
    "slow_routes",
    f"""WITH t AS ({trips_sql("origin", "destination", "distance", "minutes")})
    SELECT origin, destination, count(*) AS "rows" FROM t WHERE distance / minutes * 60 < 15000 GROUP BY ALL""",
)
def _slow_routes(spark, sf):
    df = trips(spark, sf, "origin", "destination", "distance", "minutes")
    return filters.slow_routes(df, "origin", "destination", "distance", "minutes", 15000.0)


@query(
    "domain_range_check",
    f"""WITH t AS ({trips_sql("load")}) SELECT count(*) FILTER (WHERE load > 0.09) AS above,
    count(*) FILTER (WHERE load < 0.02) AS below, count(*) FILTER (WHERE load = 0.02) AS at_lower FROM t""",
)
def _domain_range_check(spark, sf):
    return filters.domain_range_check(trips(spark, sf, "load"), "load", 0.02, 0.09)


@query(
    "top_n_members_filter",
    """WITH m AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 20)
    SELECT user_id, event_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM m)""",
)
def _top_n_members_filter(spark, sf):
    return filters.top_n_members_filter(logs(spark, sf, "event_id", "user_id", "event_type"), "user_id", 20)


@query(
    "control_filter",
    f"WITH t AS ({trips_sql('order_id', 'line', 'weather', 'congestion')}) SELECT * FROM t WHERE weather = '5-LOW' AND congestion = 'O'",
)
def _control_filter(spark, sf):
    return filters.control_filter(trips(spark, sf, "order_id", "line", "weather", "congestion"), weather="5-LOW", congestion="O")


# --- roles ------------------------------------------------------------------------------------------


@query(
    "target_summary",
    f"""WITH t AS ({bookings_sql("id", "price", "priority", "segment", "delayed")}) SELECT CAST(3 AS BIGINT) AS features, count(*) AS "rows",
    count(*) FILTER (WHERE delayed = 0) AS zeros, count(*) FILTER (WHERE delayed = 1) AS ones,
    round(avg(delayed) * 100, 4) AS positive_pct FROM t""",
)
def _target_summary(spark, sf):
    return roles.target_summary(bookings(spark, sf, "id", "price", "priority", "segment", "delayed"), "delayed", ["id"])


# --- findings ---------------------------------------------------------------------------------------

AUDIT = findings.AuditRoles(
    target="delayed", origin="origin", destination="destination", distance="distance", minutes="minutes",
    load="load", kind="kind", impossible_pair=("NATION_3", "NATION_7"),
)
AUDIT_COLUMNS = ("distance", "minutes", "load", "surcharge", "visibility", "weather", "congestion", "kind", "high_season",
                 "origin", "destination", "delayed")


def _audit_rows(spark, sf):
    """The bound rows come from a join, so they are stored before the audit scans them several times."""
    return findings.audit(stage(trips(spark, sf, *AUDIT_COLUMNS), "audit-input"), AUDIT)


_CATEGORIES = ("weather", "congestion", "kind", "origin", "destination")


@query(
    "category_findings",
    f"""WITH t AS ({trips_sql(*_CATEGORIES, "delayed")}), u AS ({_union([f"SELECT '{c}' AS c, {c} AS v, delayed FROM t WHERE {c} IS NOT NULL" for c in _CATEGORIES])}),
    g AS (SELECT c, v, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY c), 4) AS pct, round(sum(delayed) * 100.0 / count(*), 4) AS rate FROM u GROUP BY c, v)
    SELECT 'categorical' AS section, c AS "column", 'INFO' AS level, 'category_share' AS rule, CAST(pct AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS threshold, v || ' ' || n AS "text" FROM g
    UNION ALL SELECT 'categorical', c, 'INFO', 'category_rate', CAST(rate AS DOUBLE), NULL, v || ' ' || n FROM g""",
)
def _category_findings(spark, sf):
    """The share and the rate of every category as the audit reports them; category and rows of the text only."""
    df = stage(trips(spark, sf, *_CATEGORIES, "delayed"), "audit-input")
    found = reduce(DataFrame.unionByName, findings.categorical_findings(df, list(_CATEGORIES), "delayed"))
    named = F.regexp_extract("text", "^'(.*)': ", 1)
    rows = F.regexp_extract("text", "([0-9]+) rows", 1)
    return found.filter(F.col("rule").isin("category_share", "category_rate")).withColumn("text", F.concat(named, F.lit(" "), rows))


@query(
    "column_roles",
    """SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS dtype,
    CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'other' END AS role FROM (DESCRIBE customer) WHERE column_name <> 'c_custkey'""",
)
def _column_roles(spark, sf):
    return roles.role_table(table(spark, sf, "customer"), ["c_custkey"])


@query(
    "place_columns",
    f"""WITH t AS ({trips_sql("origin", "destination")}) SELECT 'aeropuerto_origen' AS "column", count(origin) AS non_null, count(DISTINCT origin) AS "distinct" FROM t
    UNION ALL SELECT 'destino', count(destination), count(DISTINCT destination) FROM t""",
)
def _place_columns(spark, sf):
    """The columns that name places, among others, and how many places each holds."""
    df = trips(spark, sf, "origin", "destination", "weather", "distance").withColumnsRenamed({"origin": "aeropuerto_origen", "destination": "destino"})
    return fingerprints.distinct_counts(df, roles.place_columns(df)).drop("rows")


_AUDIT_SQL = audit_sql(trips_sql(*AUDIT_COLUMNS))


@query("audit", _AUDIT_SQL + "SELECT * FROM audit")
def _audit(spark, sf):
    return _audit_rows(spark, sf)


@query("audit_report", _AUDIT_SQL + f"SELECT *, {SEVERITY} AS severity FROM audit")
def _audit_report(spark, sf):
    return findings.audit_report(_audit_rows(spark, sf))


@query("audit_counts", _AUDIT_SQL + f"SELECT level, count(*) AS findings, {SEVERITY} AS severity FROM audit GROUP BY level")
def _audit_counts(spark, sf):
    return findings.audit_counts(_audit_rows(spark, sf))


@query(
    "finding_null_cells",
    f"""WITH t AS ({trips_sql(*NUM, "weather")}),
    n AS (SELECT CAST(sum({" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in (*NUM, "weather"))}) AS BIGINT) AS k FROM t)
    SELECT 'overview' AS section, '*' AS "column", CASE WHEN k > 0 THEN 'ANOMALY' ELSE 'INFO' END AS level, 'null_cells' AS rule,
    CAST(k AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold, k || ' null cells' AS "text" FROM n""",
)
def _finding_null_cells(spark, sf):
    return findings.overview_findings(trips(spark, sf, *NUM, "weather"), findings.AuditRoles())[0]


@query(
    "eda_report",
    f"""WITH t AS ({trips_sql("weather", "delayed")}) SELECT weather, count(*) AS total, round(avg(delayed) * 100, 2) AS rate_pct
    FROM t WHERE weather IS NOT NULL GROUP BY weather""",
)
def _eda_report(spark, sf):
    return _eda(trips(spark, sf, *EDA_COLUMNS))["rate_by_weather"]


EDA_COLUMNS = ("order_id", "distance", "minutes", "visibility", "weather", "congestion", "kind", "origin", "destination", "delayed")


def _eda(df):
    roles_ = flows.EdaRoles(
        id="order_id", target="delayed", places=("origin", "destination"), weather="weather", congestion="congestion",
        visibility="visibility", distance="distance", minutes="minutes", kind="kind",
    )
    return flows.eda_report(df, roles_)


@query("eda_table")
def _eda_table(spark, sf):
    """The whole report."""
    return flows.eda_table(_eda(trips(spark, sf, *EDA_COLUMNS)))


@query(
    "unordered_pair_key",
    f"""WITH t AS ({trips_sql("order_id", "line", "origin", "destination")})
    SELECT *, least(origin, destination) AS end_1, greatest(origin, destination) AS end_2 FROM t""",
)
def _unordered_pair_key(spark, sf):
    return filters.unordered_pairs(trips(spark, sf, "order_id", "line", "origin", "destination"), "origin", "destination")
