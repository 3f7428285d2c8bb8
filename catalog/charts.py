"""Chart tables."""

from __future__ import annotations

from catalog.registry import logs, logs_sql, query, trips, trips_sql
from ratewise.operators import chartdata

_CORR = ("distance", "minutes", "load", "visibility")


def _bins(n: int, extra: str = "") -> str:
    keys = f"{extra}, " if extra else ""
    t = trips_sql("visibility", *([extra] if extra else []))
    return f"""WITH t AS ({t}), e AS (SELECT min(visibility) AS lo, (max(visibility) - min(visibility)) / {n} AS w FROM t),
    b AS (SELECT {keys}CAST(1 + (SELECT count(*) FROM range(1, {n}) r(i) WHERE visibility >= lo + i * w) AS INTEGER) AS bin, lo, w FROM t, e)
    SELECT {keys}bin, round(max(lo + (bin - 1) * w), 6) AS lo, round(max(lo + bin * w), 6) AS hi, count(*) AS "rows" FROM b GROUP BY {keys}bin"""


@query("histogram_bins", _bins(30))
def _histogram_bins(spark, sf):
    return chartdata.histogram_bins(trips(spark, sf, "visibility"), "visibility", 30)


@query("histogram_bins_by_group", _bins(12, "kind"))
def _histogram_bins_by_group(spark, sf):
    return chartdata.histogram_bins(trips(spark, sf, "visibility", "kind"), "visibility", 12, ["kind"])


@query(
    "histogram_bins_auto",
    f"""WITH t AS ({logs_sql("load")}), s AS (SELECT min(load) AS lo, max(load) AS hi, count(*) AS n,
    2 * (quantile_cont(load, 0.75) - quantile_cont(load, 0.25)) / pow(count(*), 1 / 3) AS fd FROM t),
    e AS (SELECT lo, (hi - lo) / greatest(ceil((hi - lo) / fd), ceil(log2(n) + 1)) AS w, greatest(ceil((hi - lo) / fd), ceil(log2(n) + 1)) AS k FROM s),
    b AS (SELECT CAST(1 + (SELECT count(*) FROM range(1, 2000) r(i) WHERE i < k AND load >= lo + i * w) AS INTEGER) AS bin, lo, w FROM t, e)
    SELECT bin, round(max(lo + (bin - 1) * w), 6) AS lo, round(max(lo + bin * w), 6) AS hi, count(*) AS "rows" FROM b GROUP BY bin""",
)
def _histogram_bins_auto(spark, sf):
    return chartdata.histogram_bins(logs(spark, sf, "load"), "load")


@query(
    "density_curve",
    f"""WITH t AS ({logs_sql("load")}), s AS (SELECT min(load) AS lo, max(load) AS hi, count(*) AS n, stddev_samp(load) * pow(count(*), -0.2) AS h FROM t),
    g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 199 AS x, n, h FROM s, range(0, 200) r(i))
    SELECT point, round(max(x), 6) AS x, round(sum(exp(-0.5 * pow((x - load) / h, 2))) / max(n * h * sqrt(2 * pi())), 9) AS density FROM t, g GROUP BY point""",
)
def _density_curve(spark, sf):
    return chartdata.density_curve(logs(spark, sf, "load"), "load")


def _box_sql(t: str, keys: str = "") -> str:
    group = f'{keys}"column"'
    return f"""{t}, q AS (SELECT {group}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
    FROM u WHERE value IS NOT NULL GROUP BY {group}),
    j AS (SELECT u.*, q1, median, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM u JOIN q USING ({group}))
    SELECT {group}, count(value) AS "rows", round(min(value) FILTER (WHERE ok), 6) AS low, round(max(q1), 6) AS q1, round(max(median), 6) AS median,
    round(max(q3), 6) AS q3, round(max(value) FILTER (WHERE ok), 6) AS high, count(*) FILTER (WHERE NOT ok) AS outliers FROM j GROUP BY {group}"""


@query(
    "box_stats",
    _box_sql(
        f"""WITH t AS ({logs_sql("load", "load_known")}), u AS (SELECT 'load' AS "column", load AS value FROM t UNION ALL SELECT 'load_known', load_known FROM t)"""
    ),
)
def _box_stats(spark, sf):
    return chartdata.box_stats(logs(spark, sf, "load", "load_known"), ["load", "load_known"])


@query(
    "box_stats_by_group",
    _box_sql(
        f"""WITH t AS ({logs_sql("hour", "load", "event_type")}), u AS (SELECT event_type, 'hour' AS "column", CAST(hour AS DOUBLE) AS value FROM t
        UNION ALL SELECT event_type, 'load', load FROM t)""",
        "event_type, ",
    ),
)
def _box_stats_by_group(spark, sf):
    return chartdata.box_stats(logs(spark, sf, "hour", "load", "event_type"), ["hour", "load"], ["event_type"])


@query(
    "box_stats_normalized",
    _box_sql(
        f"""WITH t AS ({logs_sql("hour", "load")}), r AS (SELECT min(hour) AS a, max(hour) AS b, min(load) AS c, max(load) AS d FROM t),
        u AS (SELECT 'hour' AS "column", (hour - a) / CAST(b - a AS DOUBLE) AS value FROM t, r UNION ALL SELECT 'load', (load - c) / (d - c) FROM t, r)"""
    ),
)
def _box_stats_normalized(spark, sf):
    return chartdata.box_stats_normalized(logs(spark, sf, "hour", "load"), ["hour", "load"])


@query("scatter_sample", "SELECT event_id, user_id, value AS load FROM events ORDER BY md5('42:' || event_id) LIMIT 1000")
def _scatter_sample(spark, sf):
    return chartdata.scatter_sample(logs(spark, sf, "event_id", "user_id", "load"), "user_id", "load", ["event_id"])


@query(
    "scatter_pairs",
    """WITH t AS (SELECT event_id, CAST(user_id AS DOUBLE) AS u, value AS l, CAST(hour(ts) AS DOUBLE) AS h FROM events ORDER BY md5('42:' || event_id) LIMIT 500)
    SELECT event_id, 'user_id' AS x_name, 'load' AS y_name, u AS x, l AS y FROM t UNION ALL SELECT event_id, 'user_id', 'hour', u, h FROM t
    UNION ALL SELECT event_id, 'load', 'hour', l, h FROM t""",
)
def _scatter_pairs(spark, sf):
    return chartdata.scatter_pairs(logs(spark, sf, "event_id", "user_id", "load", "hour"), ["user_id", "load", "hour"], ["event_id"], 500)


@query(
    "scatter_grid",
    f"""WITH t AS ({trips_sql("distance", "visibility")}), e AS (SELECT min(distance) AS a, (max(distance) - min(distance)) / 50 AS w,
    min(visibility) AS b, (max(visibility) - min(visibility)) / 50 AS v FROM t)
    SELECT CAST(least(50, floor((distance - a) / w) + 1) AS INTEGER) AS bin_x, CAST(least(50, floor((visibility - b) / v) + 1) AS INTEGER) AS bin_y,
    count(*) AS "rows" FROM t, e GROUP BY 1, 2""",
)
def _scatter_grid(spark, sf):
    return chartdata.scatter_grid(trips(spark, sf, "distance", "visibility"), "distance", "visibility")


@query(
    "bar_counts_pct",
    f"""WITH t AS ({trips_sql("weather", "congestion")}), u AS (SELECT 'weather' AS "column", weather AS value FROM t UNION ALL SELECT 'congestion', congestion FROM t),
    n AS (SELECT "column", count(*) AS a FROM u GROUP BY 1)
    SELECT u."column", value, count(*) AS "rows", round(count(*) * CAST(100 AS DOUBLE) / max(a), 1) AS pct
    FROM u JOIN n ON u."column" = n."column" WHERE value IS NOT NULL GROUP BY ALL""",
)
def _bar_counts_pct(spark, sf):
    return chartdata.bar_counts_pct(trips(spark, sf, "weather", "congestion"), ["weather", "congestion"])


@query(
    "class_bars",
    f"""WITH t AS ({logs_sql("delayed")}), n AS (SELECT count(*) AS a FROM t)
    SELECT CASE delayed WHEN 1 THEN 'delayed' ELSE 'on time' END AS label, count(*) AS "rows",
    round(count(*) * CAST(100 AS DOUBLE) / max(a), 1) AS pct FROM t, n GROUP BY delayed""",
)
def _class_bars(spark, sf):
    return chartdata.class_bars(logs(spark, sf, "delayed"), "delayed", {0: "on time", 1: "delayed"})


@query(
    "heatmap_lower_triangle",
    f"WITH t AS ({trips_sql(*_CORR)}) "
    + " UNION ALL ".join(
        f"SELECT '{_CORR[i]}' AS \"row\", '{_CORR[j]}' AS \"col\", round(corr({_CORR[i]}, {_CORR[j]}), 2) AS r FROM t"
        for i in range(len(_CORR))
        for j in range(i)
    ),
)
def _heatmap_lower_triangle(spark, sf):
    return chartdata.heatmap_lower_triangle(trips(spark, sf, *_CORR), _CORR)
