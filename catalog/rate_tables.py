"""Outcome rates, derived columns, routes and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.registry import logs, logs_sql, query, table, trips, trips_sql
from ratewise.functions import columns as fc
from ratewise.functions.stats import pearson
from ratewise.operators import rates, relations

RATE_CATS = ("weather", "congestion", "shape")


def _union(parts):
    return " UNION ALL ".join(parts)


def _long_text(cols):
    return _union([f"SELECT '{c}' AS \"column\", {c} AS value, delayed FROM t" for c in cols])


def _by_category(category: str, t: str) -> str:
    return f"""WITH t AS ({t}) SELECT {category}, count(*) AS total, round(avg(delayed) * 100, 2) AS rate_pct
    FROM t WHERE {category} IS NOT NULL GROUP BY {category}"""


@query("rate_by_category", _by_category("weather", trips_sql("weather", "delayed")))
def rate_by_category(spark, sf):
    return rates.rate_by_category(trips(spark, sf, "weather", "delayed"), "weather", "delayed")


@query("rate_by_category_congestion", _by_category("congestion", trips_sql("congestion", "delayed")))
def _rate_by_category_congestion(spark, sf):
    return rates.rate_by_category(trips(spark, sf, "congestion", "delayed"), "congestion", "delayed")


@query(
    "rate_by_category_all",
    f"""WITH t AS ({trips_sql(*RATE_CATS, "kind", "delayed")}), u AS ({_long_text((*RATE_CATS, "kind"))}),
    g AS (SELECT "column", value, count(*) AS r, round(avg(delayed) * 100, 4) AS p FROM u WHERE value IS NOT NULL GROUP BY ALL),
    n AS (SELECT "column", count(*) AS categories FROM g GROUP BY "column")
    SELECT g."column", value, r AS "rows", p AS rate_pct, categories, categories <= 20 AS drawable FROM g JOIN n ON g."column" = n."column" """,
)
def _rate_by_category_all(spark, sf):
    cols = (*RATE_CATS, "kind")
    return rates.rate_by_category_all(trips(spark, sf, *cols, "delayed"), cols, "delayed")


@query(
    "rate_spread_by_category",
    f"""WITH t AS ({trips_sql(*RATE_CATS, "kind", "delayed")}), u AS ({_long_text((*RATE_CATS, "kind"))}),
    g AS (SELECT "column", value, avg(delayed) * 100 AS p FROM u WHERE value IS NOT NULL GROUP BY ALL)
    SELECT "column", round(min(p), 4) AS min_rate, round(max(p), 4) AS max_rate, round(max(p) - min(p), 4) AS spread_pp,
    max(p) - min(p) > 15 AS important FROM g GROUP BY "column" """,
)
def _rate_spread_by_category(spark, sf):
    cols = (*RATE_CATS, "kind")
    return rates.rate_spread_by_category(trips(spark, sf, *cols, "delayed"), cols, "delayed")


@query(
    "crosstab_row_pct",
    f"""WITH t AS ({trips_sql("weather", "delayed")}) SELECT weather, round(avg(1 - delayed) * 100, 4) AS negative_pct,
    round(avg(delayed) * 100, 4) AS positive_pct FROM t WHERE weather IS NOT NULL GROUP BY weather""",
)
def _crosstab_row_pct(spark, sf):
    return rates.crosstab_row_pct(trips(spark, sf, "weather", "delayed"), "weather", "delayed")


_HOURLY = f"""WITH t AS ({logs_sql("hour", "load", "delayed")}), h AS (SELECT hour, count(*) AS "rows",
    round(avg(load), 6) AS mean_load, round(avg(delayed) * 100, 2) AS rate_pct FROM t GROUP BY hour) """


def _hours(spark, sf, *cols):
    df = logs(spark, sf, "hour_text", *cols)
    return df.withColumn("hour", fc.extract_hour("hour_text"))


@query("rate_by_hour", _HOURLY + 'SELECT hour, "rows", rate_pct FROM h')
def _rate_by_hour(spark, sf):
    return rates.rate_by_hour(_hours(spark, sf, "delayed"), "hour", "delayed")


@query("hour_occupancy_rate", _HOURLY + 'SELECT hour, "rows", mean_load, rate_pct FROM h')
def _hour_occupancy_rate(spark, sf):
    return rates.hour_occupancy_rate(_hours(spark, sf, "load", "delayed"), "hour", "load", "delayed")


@query("peak_group", _HOURLY + "SELECT hour, rate_pct FROM h ORDER BY rate_pct DESC, hour LIMIT 1")
def _peak_group(spark, sf):
    return rates.peak_group(rates.rate_by_hour(_hours(spark, sf, "delayed"), "hour", "delayed"), "hour", "rate_pct")


@query("peak_load_group", _HOURLY + "SELECT hour, mean_load FROM h ORDER BY mean_load DESC, hour LIMIT 1")
def _peak_load_group(spark, sf):
    hourly = rates.hour_occupancy_rate(_hours(spark, sf, "load", "delayed"), "hour", "load", "delayed")
    return rates.peak_group(hourly, "hour", "mean_load")


@query("group_correlation", _HOURLY + "SELECT round(corr(hour, rate_pct), 6) AS r FROM h")
def _group_correlation(spark, sf):
    return relations.group_correlation(rates.rate_by_hour(_hours(spark, sf, "delayed"), "hour", "delayed"), "hour", "rate_pct")


@query("group_correlation_load", _HOURLY + "SELECT round(corr(hour, mean_load), 6) AS r FROM h")
def _group_correlation_load(spark, sf):
    hourly = rates.hour_occupancy_rate(_hours(spark, sf, "load", "delayed"), "hour", "load", "delayed")
    return relations.group_correlation(hourly, "hour", "mean_load")


@query(
    "rate_by_time_band",
    f"""WITH t AS ({logs_sql("hour", "delayed")}) SELECT CASE WHEN hour < 6 THEN 'madrugada' WHEN hour < 12 THEN 'manana'
    WHEN hour < 18 THEN 'tarde' ELSE 'noche' END AS band, count(*) AS "rows", round(avg(delayed) * 100, 4) AS rate_pct FROM t GROUP BY 1""",
)
def _rate_by_time_band(spark, sf):
    return rates.rate_by_time_band(_hours(spark, sf, "delayed"), "hour", "delayed")


@query(
    "rate_by_bin",
    f"""WITH t AS ({trips_sql("visibility", "delayed")}), e AS (SELECT min(visibility) AS lo, (max(visibility) - min(visibility)) / 10 AS w FROM t),
    b AS (SELECT CAST(1 + (SELECT count(*) FROM range(1, 10) r(i) WHERE visibility > lo + i * w) AS INTEGER) AS bin, lo, w, delayed FROM t, e)
    SELECT bin, round(max(lo + (bin - 1) * w), 6) AS lo, round(max(lo + bin * w), 6) AS hi, count(*) AS total,
    round(avg(delayed) * 100, 2) AS rate_pct FROM b GROUP BY bin""",
)
def _rate_by_bin(spark, sf):
    return rates.rate_by_bin(trips(spark, sf, "visibility", "delayed"), "visibility", "delayed")


@query(
    "mean_by_class",
    f"""WITH t AS ({logs_sql("hour", "delayed")}) SELECT delayed, count(*) AS "rows", round(avg(hour), 6) AS mean FROM t GROUP BY delayed""",
)
def _mean_by_class(spark, sf):
    return rates.mean_by_class(_hours(spark, sf, "delayed"), "hour", "delayed")


@query(
    "hour_verdict",
    f"""WITH t AS ({logs_sql("hour", "delayed")}), h AS (SELECT hour, avg(delayed) * 100 AS p FROM t GROUP BY hour),
    s AS (SELECT count(*) AS n, round(avg(delayed) * 100, 4) AS g, round(corr(hour, delayed), 6) AS r FROM t),
    v AS (SELECT round(min(p), 4) AS lo, round(max(p), 4) AS hi, round(max(p) - min(p), 4) AS rg, round(stddev_samp(p), 4) AS sd FROM h)
    SELECT n AS "rows", g AS rate_pct, r, lo AS min_rate, hi AS max_rate, rg AS range_pp, sd AS std_pp,
    CASE WHEN abs(r) < 0.05 AND rg < 15 THEN 'no signal' ELSE 'some variation' END AS verdict FROM s, v""",
)
def _hour_verdict(spark, sf):
    return relations.hour_verdict(_hours(spark, sf, "delayed"), "hour", "delayed")


# --- types and routes -------------------------------------------------------------------------------

_RATED = f"""WITH t AS ({trips_sql("kind", "distance", "minutes")}), r AS (SELECT kind, distance / minutes * 60 AS rate FROM t) """


@query(
    "rate_stats_by_type",
    _RATED
    + """SELECT kind, round(avg(rate), 1) AS mean, round(stddev_samp(rate), 1) AS std, round(min(rate), 1) AS "min",
    round(max(rate), 1) AS "max" FROM r GROUP BY kind""",
)
def _rate_stats_by_type(spark, sf):
    return rates.rate_stats_by_type(trips(spark, sf, "kind", "distance", "minutes"), "kind", "distance", "minutes")


@query(
    "rate_summary_by_type",
    _RATED
    + """SELECT kind, count(*) AS "count", round(avg(rate), 1) AS mean, round(stddev_samp(rate), 1) AS std, round(min(rate), 1) AS "min",
    round(max(rate), 1) AS "max", round(quantile_cont(rate, 0.25), 1) AS q1, round(quantile_cont(rate, 0.5), 1) AS median,
    round(quantile_cont(rate, 0.75), 1) AS q3 FROM r GROUP BY kind""",
)
def _rate_summary_by_type(spark, sf):
    return rates.rate_summary_by_type(trips(spark, sf, "kind", "distance", "minutes"), "kind", "distance", "minutes")


@query(
    "type_mean_spread",
    _RATED
    + """, m AS (SELECT avg(rate) AS m FROM r GROUP BY kind) SELECT round(max(m) - min(m), 1) AS spread, max(m) - min(m) < 30 AS almost_equal FROM m""",
)
def _type_mean_spread(spark, sf):
    return rates.type_mean_spread(trips(spark, sf, "kind", "distance", "minutes"), "kind", "distance", "minutes")


_ROUTES = f"""WITH t AS ({trips_sql("origin", "destination")}), r AS (SELECT origin, destination, count(*) AS n FROM t GROUP BY ALL) """


@query("route_counts", _ROUTES + 'SELECT origin, destination, n AS "rows" FROM r')
def _route_counts(spark, sf):
    return rates.route_counts(trips(spark, sf, "origin", "destination"), "origin", "destination")


@query("top_routes", _ROUTES + 'SELECT origin, destination, n AS "rows" FROM r ORDER BY n DESC, origin, destination LIMIT 10')
def _top_routes(spark, sf):
    return rates.top_routes(trips(spark, sf, "origin", "destination"), "origin", "destination")


@query(
    "pair_totals",
    _ROUTES
    + """SELECT least(origin, destination) AS end_1, greatest(origin, destination) AS end_2, CAST(sum(n) AS BIGINT) AS "rows",
    count(*) AS directions FROM r GROUP BY 1, 2""",
)
def _pair_totals(spark, sf):
    return rates.pair_totals(trips(spark, sf, "origin", "destination"), "origin", "destination")


@query(
    "one_way_routes",
    """WITH r AS (SELECT o_custkey AS a, l_suppkey AS b, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    SELECT least(a, b) AS end_1, greatest(a, b) AS end_2, CAST(sum(n) AS BIGINT) AS "rows" FROM r GROUP BY 1, 2 HAVING count(*) = 1""",
)
def _one_way_routes(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"))
    return rates.one_way_routes(lines, "o_custkey", "l_suppkey")


@query(
    "class_balance",
    f"""WITH t AS ({trips_sql("delayed")}), c AS (SELECT delayed AS class, count(*) AS n FROM t GROUP BY delayed),
    s AS (SELECT sum(n) AS a, min(n) / max(n) AS q FROM c)
    SELECT class, n AS "rows", round(n * CAST(100 AS DOUBLE) / a, 4) AS pct, round(q, 6) AS ratio,
    CASE WHEN q < 0.25 THEN 'severe' WHEN q < 0.5 THEN 'moderate' ELSE 'acceptable' END AS level FROM c, s""",
)
def _class_balance(spark, sf):
    return rates.class_balance(trips(spark, sf, "delayed"), "delayed")


# --- correlations -----------------------------------------------------------------------------------

CORR = ("distance", "minutes", "load", "surcharge", "visibility", "size", "delayed")
_T = f"WITH t AS ({trips_sql(*CORR)}) "


@query("row_correlation", f"WITH t AS ({trips_sql('distance', 'surcharge')}) SELECT round(corr(distance, surcharge), 6) AS r FROM t")
def _row_correlation(spark, sf):
    return relations.row_correlation(trips(spark, sf, "distance", "surcharge"), "distance", "surcharge")


@query("hour_row_correlation", f"WITH t AS ({logs_sql('hour', 'delayed')}) SELECT round(corr(hour, delayed), 6) AS r FROM t")
def _hour_row_correlation(spark, sf):
    return rates.hour_correlation(_hours(spark, sf, "delayed"), "hour", "delayed")


@query(
    "correlation_matrix",
    _T
    + _union([f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM t" for a in CORR for b in CORR if a != b])
    + " UNION ALL "
    + _union([f"SELECT '{a}' AS x, '{a}' AS y, CAST(1 AS DOUBLE) AS r" for a in CORR]),
)
def _correlation_matrix(spark, sf):
    return relations.correlation_matrix(trips(spark, sf, *CORR), CORR)


@query(
    "target_correlation_ranking",
    _T
    + ", c AS ("
    + _union([f"SELECT '{a}' AS \"column\", corr({a}, delayed) AS r FROM t" for a in CORR[:-1]])
    + """) SELECT "column", round(r, 6) AS r, CASE WHEN abs(r) > 0.3 THEN 'strong' WHEN abs(r) > 0.1 THEN 'weak' ELSE 'none' END AS strength,
    abs(r) < 0.05 AS drop_candidate FROM c""",
)
def _target_correlation_ranking(spark, sf):
    return relations.target_correlation_ranking(trips(spark, sf, *CORR), CORR[:-1], "delayed")


_PART_COLS = ("p_partkey", "p_size", "p_retailprice", "price_copy")
_PARTS = "WITH t AS (SELECT p_partkey, p_size, p_retailprice, p_retailprice * 2 + p_size AS price_copy FROM part) "


@query(
    "collinear_pairs",
    _PARTS
    + ", c AS ("
    + _union([f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM t" for a, b in combinations(_PART_COLS, 2)])
    + ") SELECT * FROM c WHERE abs(r) > 0.7",
)
def _collinear_pairs(spark, sf):
    df = table(spark, sf, "part").withColumn("price_copy", F.expr("p_retailprice * 2 + p_size"))
    return relations.collinear_pairs(df, _PART_COLS)


@query(
    "visibility_outcome_correlation",
    f"WITH t AS ({trips_sql('visibility', 'delayed')}) SELECT round(corr(visibility, delayed), 6) AS r FROM t",
)
def _visibility_outcome_correlation(spark, sf):
    return trips(spark, sf, "visibility", "delayed").agg(F.round(pearson("visibility", "delayed"), 6).alias("r"))


# --- derived columns --------------------------------------------------------------------------------


@query(
    "ratio_rate",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "minutes", "surcharge")})
    SELECT order_id, line, distance, round(distance / minutes * 60, 6) AS rate, round(distance / surcharge * 60, 4) AS rate_or_null FROM t""",
)
def _ratio_rate(spark, sf):
    df = trips(spark, sf, "order_id", "line", "distance", "minutes", "surcharge")
    return df.select(
        "order_id",
        "line",
        "distance",
        F.round(fc.ratio_rate("distance", "minutes"), 6).alias("rate"),
        F.round(fc.ratio_rate("distance", "surcharge"), 4).alias("rate_or_null"),
    )


@query(
    "extract_hour",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS from_text, CAST(hour(ts) AS INTEGER) AS from_timestamp,
    try_cast(nullif(regexp_extract(props, '(\\d{1,2})', 1), '') AS INTEGER) AS from_props,
    try_cast(nullif(regexp_extract(event_type, '(\\d{1,2})', 1), '') AS INTEGER) AS unreadable FROM events""",
)
def _extract_hour(spark, sf):
    df = logs(spark, sf, "event_id", "hour_text", "ts", "event_type").join(
        table(spark, sf, "events").select("event_id", "props"), "event_id"
    )
    return df.select(
        "event_id",
        fc.extract_hour("hour_text").alias("from_text"),
        fc.extract_hour_of(df, "ts").alias("from_timestamp"),
        fc.extract_hour("props").alias("from_props"),
        fc.extract_hour("event_type").alias("unreadable"),
    )


@query(
    "decimal_hour",
    "SELECT event_id, round(hour(ts) + minute(ts) / 60.0::DOUBLE, 9) AS decimal_hour FROM events",
)
def _decimal_hour(spark, sf):
    df = logs(spark, sf, "event_id", "hour_text")
    return df.select("event_id", F.round(fc.decimal_hour("hour_text"), 9).alias("decimal_hour"))


@query(
    "time_bands",
    f"""WITH t AS ({logs_sql("event_id", "hour")}) SELECT event_id, hour,
    CASE WHEN hour BETWEEN 7 AND 11 THEN 'manana' WHEN hour BETWEEN 12 AND 15 THEN 'mediodia' WHEN hour BETWEEN 16 AND 19 THEN 'tarde'
    WHEN hour >= 20 OR hour = 0 THEN 'noche' ELSE 'madrugada' END AS band_5,
    CASE WHEN hour < 6 THEN 'madrugada' WHEN hour < 12 THEN 'manana' WHEN hour < 18 THEN 'tarde' ELSE 'noche' END AS band_4 FROM t""",
)
def _time_bands(spark, sf):
    df = _hours(spark, sf, "event_id")
    return df.select("event_id", "hour", fc.time_band_5("hour").alias("band_5"), fc.time_band_4("hour").alias("band_4"))


@query(
    "binary_indicator",
    f"""WITH t AS ({trips_sql("order_id", "line", "outcome_text", "high_season", "size")}) SELECT order_id, line,
    CAST(coalesce(lower(trim(outcome_text)) IN ('1', 'si', 'sí', 'true', 'demorado', 'delay', 'delayed'), false) AS INTEGER) AS from_text,
    CAST(high_season AS INTEGER) AS from_boolean, CAST(size = 1 AS INTEGER) AS from_number FROM t""",
)
def _binary_indicator(spark, sf):
    df = trips(spark, sf, "order_id", "line", "outcome_text", "high_season", "size")
    return df.select(
        "order_id",
        "line",
        fc.binary_indicator(df, "outcome_text").alias("from_text"),
        fc.binary_indicator(df, "high_season").alias("from_boolean"),
        fc.binary_indicator(df, "size").alias("from_number"),
    )


@query(
    "label_map",
    f"""WITH t AS ({logs_sql("event_id", "delayed")}) SELECT event_id, CASE delayed WHEN 0 THEN 'on time' WHEN 1 THEN 'delayed' END AS label FROM t""",
)
def _label_map(spark, sf):
    df = logs(spark, sf, "event_id", "delayed")
    return df.select("event_id", fc.label_map("delayed", {0: "on time", 1: "delayed"}).alias("label"))


@query(
    "equal_width_bins",
    f"""WITH t AS ({trips_sql("order_id", "line", "load")}), e AS (SELECT min(load) AS lo, (max(load) - min(load)) / 7 AS w FROM t)
    SELECT order_id, line, load, CAST(1 + (SELECT count(*) FROM range(1, 7) r(i) WHERE load > lo + i * w) AS INTEGER) AS bin FROM t, e""",
)
def _equal_width_bins(spark, sf):
    df = trips(spark, sf, "order_id", "line", "load")
    ends = df.agg(F.min("load"), F.max("load")).first()
    start, width = fc.bin_edges(ends[0], ends[1], 7)
    return df.withColumn("bin", fc.right_closed_bin("load", start, width, 7))


@query(
    "rate_half_width",
    f"""WITH t AS ({trips_sql("kind", "delayed")}), k AS (SELECT kind, count(*) AS n, avg(delayed) AS p FROM t GROUP BY kind)
    SELECT kind, n, round(1.96 * sqrt(p * (1 - p) / n), 9) AS half_width FROM k""",
)
def _rate_half_width(spark, sf):
    t = trips(spark, sf, "kind", "delayed").groupBy("kind").agg(F.count("*").alias("n"), F.avg("delayed").alias("p"))
    return t.select("kind", "n", F.round(fc.rate_half_width("p", "n"), 9).alias("half_width"))
