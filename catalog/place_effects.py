"""Origin/destination analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table, trips, trips_sql
from ratewise.operators import chartdata, entities, rates, reshape

PLACES = ("origin", "destination")
WEATHER_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


def _long(*extra: str) -> str:
    """Two observations per row, one per place column."""
    cols = ", ".join(extra)
    t = trips_sql(*PLACES, *extra)
    return f"t AS ({t}), p AS (SELECT origin AS place, {cols} FROM t UNION ALL SELECT destination, {cols} FROM t)"


@query("melt_places", f'WITH {_long("delayed")} SELECT place, delayed, count(*) AS "rows" FROM p GROUP BY ALL')
def _melt_places(spark, sf):
    long = reshape.melt_places(trips(spark, sf, *PLACES, "delayed"), PLACES, ["delayed"])
    return long.groupBy("place", "delayed").agg(F.count("*").alias("rows"))


@query(
    "entity_rate",
    f"""WITH {_long("delayed")} SELECT place, count(*) AS total, CAST(sum(delayed) AS BIGINT) AS positives,
    round(avg(delayed) * 100, 2) AS rate_pct FROM p GROUP BY place""",
)
def _entity_rate(spark, sf):
    return rates.entity_rate(trips(spark, sf, *PLACES, "delayed"), PLACES, "delayed")


@query(
    "entity_volume_rate_topn",
    f"""WITH {_long("delayed")} SELECT place, count(*) AS total, round(avg(delayed) * 100, 2) AS rate_pct FROM p GROUP BY place
    ORDER BY total DESC, place LIMIT 20""",
)
def _entity_volume_rate_topn(spark, sf):
    return rates.entity_volume_rate_topn(trips(spark, sf, *PLACES, "delayed"), PLACES, "delayed")


@query(
    "entity_mean_topn",
    f"""WITH {_long("surcharge")} SELECT place, count(*) AS total, round(avg(surcharge), 6) AS mean FROM p WHERE surcharge IS NOT NULL
    GROUP BY place ORDER BY mean DESC, place LIMIT 20""",
)
def _entity_mean_topn(spark, sf):
    return rates.entity_mean_topn(trips(spark, sf, *PLACES, "surcharge"), PLACES, "surcharge")


_CONTRIBUTION = f"""WITH {_long("weather", "delayed")}, n AS (SELECT place, count(*) AS total FROM p GROUP BY place ORDER BY total DESC, place LIMIT 20),
    c AS (SELECT p.place, weather, CAST(sum(delayed) AS BIGINT) AS positives, max(total) AS total,
    round(sum(delayed) * CAST(100 AS DOUBLE) / max(total), 2) AS points FROM p JOIN n ON p.place = n.place WHERE weather IS NOT NULL GROUP BY ALL) """


@query("rate_contribution_long", _CONTRIBUTION + "SELECT place, weather, positives, total, points FROM c")
def _rate_contribution_long(spark, sf):
    return rates.rate_contribution_long(trips(spark, sf, *PLACES, "weather", "delayed"), PLACES, "weather", "delayed")


@query(
    "rate_contribution",
    _CONTRIBUTION
    + "SELECT place, "
    + ", ".join(f"coalesce(max(CASE WHEN weather = '{w}' THEN points END), 0.0) AS \"{w}\"" for w in WEATHER_LEVELS)
    + ", round(sum(points), 4) AS row_total FROM c GROUP BY place",
)
def _rate_contribution(spark, sf):
    return rates.rate_contribution(trips(spark, sf, *PLACES, "weather", "delayed"), PLACES, "weather", "delayed")


@query("stacked_contribution", _CONTRIBUTION + """SELECT place, weather, points, round(sum(points) OVER w - points, 4) AS "start", round(sum(points) OVER w, 4) AS "end"
    FROM c WINDOW w AS (PARTITION BY place ORDER BY weather ROWS UNBOUNDED PRECEDING)""")
def _stacked_contribution(spark, sf):
    return chartdata.stacked_contribution(trips(spark, sf, *PLACES, "weather", "delayed"), PLACES, "weather", "delayed")


@query(
    "attach_totals",
    f"""WITH {_long("weather")}, c AS (SELECT place, weather, count(*) AS n FROM p GROUP BY ALL)
    SELECT place, weather, n AS "rows", CAST(sum(n) OVER (PARTITION BY place) AS BIGINT) AS total FROM c""",
)
def _attach_totals(spark, sf):
    cells = (
        reshape.melt_places(trips(spark, sf, *PLACES, "weather"), PLACES, ["weather"])
        .groupBy("place", "weather")
        .agg(F.count("*").alias("rows"))
    )
    return rates.attach_totals(cells, "place", "rows")


def _control():
    return (F.col("weather") == "5-LOW") & (F.col("congestion") == "O")


_CONTROLLED = f"""WITH {_long("weather", "congestion", "delayed")}, k AS (SELECT place, count(*) AS total, avg(delayed) AS raw,
    count(*) FILTER (WHERE weather = '5-LOW' AND congestion = 'O') AS m,
    avg(delayed) FILTER (WHERE weather = '5-LOW' AND congestion = 'O') AS pure FROM p GROUP BY place) """


def _observations(spark, sf):
    return trips(spark, sf, *PLACES, "weather", "congestion", "delayed")


@query(
    "raw_vs_controlled",
    _CONTROLLED + "SELECT place, total, round(raw, 6) AS raw, m AS control_total, round(pure, 6) AS controlled FROM k",
)
def _raw_vs_controlled(spark, sf):
    t = entities.raw_vs_controlled(_observations(spark, sf), PLACES, "delayed", _control())
    return t.withColumns({"raw": F.round("raw", 6), "controlled": F.round("controlled", 6)})


@query(
    "adjusted_rate_table",
    _CONTROLLED
    + """SELECT place, total, round(raw * 100, 4) AS raw_pct, round(pure * 100, 4) AS controlled_pct, m AS control_total,
    round((raw - pure) * 100, 4) AS delta_pp, round((raw - pure) * 100 / raw, 4) AS explained_pct,
    round(1.96 * sqrt(pure * (1 - pure) / m) * 100, 4) AS half_width_pp FROM k""",
)
def _adjusted_rate_table(spark, sf):
    return entities.adjusted_rate_table(_observations(spark, sf), PLACES, "delayed", _control())


@query(
    "rate_confidence_interval",
    f"""WITH {_long("delayed")}, k AS (SELECT place, count(*) AS total, avg(delayed) AS r FROM p GROUP BY place),
    w AS (SELECT *, 1.96 * sqrt(r * (1 - r) / total) * 100 AS h FROM k)
    SELECT place, total, round(r * 100, 4) AS rate_pct, round(h, 4) AS half_width_pp, round(r * 100 - h, 4) AS low_pct,
    round(r * 100 + h, 4) AS high_pct FROM w""",
)
def _rate_confidence_interval(spark, sf):
    return entities.rate_confidence_interval(trips(spark, sf, *PLACES, "delayed"), PLACES, "delayed")


@query(
    "control_scenarios",
    f"""WITH {_long("weather", "congestion", "delayed")}, s AS (
    SELECT 'unfiltered' AS scenario, place, avg(delayed) * 100 AS r FROM p GROUP BY place UNION ALL
    SELECT 'clear weather', place, avg(delayed) * 100 FROM p WHERE weather = '5-LOW' GROUP BY place UNION ALL
    SELECT 'low congestion', place, avg(delayed) * 100 FROM p WHERE congestion = 'O' GROUP BY place UNION ALL
    SELECT 'both', place, avg(delayed) * 100 FROM p WHERE weather = '5-LOW' AND congestion = 'O' GROUP BY place)
    SELECT scenario, count(*) AS places, round(avg(r), 4) AS mean_pct, round(stddev_samp(r), 4) AS std_pp FROM s GROUP BY scenario""",
)
def _control_scenarios(spark, sf):
    strata = {
        "unfiltered": F.lit(True),
        "clear weather": F.col("weather") == "5-LOW",
        "low congestion": F.col("congestion") == "O",
        "both": _control(),
    }
    return entities.control_scenarios(_observations(spark, sf), PLACES, "delayed", strata)


_VOLUME = f"""WITH {_long("delayed")}, k AS (SELECT place, count(*) AS total, avg(delayed) * 100 AS rate_pct FROM p GROUP BY place) """


@query(
    "volume_rate_correlation",
    _VOLUME
    + """, c AS (SELECT count(*) AS n, corr(total, rate_pct) AS r FROM k), s AS (SELECT n, r, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t FROM c),
    g AS (SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(0, 4001) r(i)),
    q AS (SELECT max(n) AS n, max(r) AS r, max(t) AS t, sum(w * pow(1 + pow(t * i / 4000, 2) / (n - 2), -(n - 1) / 2)) * max(t) / 12000 AS area FROM s, g)
    SELECT n AS places, round(r, 6) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t,
    round(1 - 2 * area * exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2)) / sqrt((n - 2) * pi()), 6) AS p_value FROM q""",
)
def _volume_rate_correlation(spark, sf):
    t = entities.place_volume_rate(trips(spark, sf, *PLACES, "delayed"), PLACES, "delayed")
    return entities.volume_rate_correlation(t, "total", "rate_pct")


@query(
    "dispersion_by_size",
    """WITH k AS (SELECT l_partkey AS place, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100 AS r FROM lineitem GROUP BY 1),
    s AS (SELECT *, CASE WHEN n >= 35 THEN 'large' WHEN n < 25 THEN 'small' END AS size_class FROM k)
    SELECT size_class, count(*) AS places, round(stddev_samp(r), 4) AS std_pp FROM s WHERE size_class IS NOT NULL GROUP BY size_class""",
)
def _dispersion_by_size(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("origin"), F.expr("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS delayed")
    )
    t = entities.place_volume_rate(lines, ["origin"], "delayed")
    return entities.dispersion_by_size(t, "total", "rate_pct", large=35, small=25)


@query(
    "composition_by_entity",
    f"""WITH {_long("weather")}, c AS (SELECT place, weather, count(*) AS n FROM p WHERE weather IS NOT NULL GROUP BY ALL)
    SELECT place, weather, n AS "rows", round(n * CAST(100 AS DOUBLE) / sum(n) OVER (PARTITION BY place), 4) AS pct FROM c""",
)
def _composition_by_entity(spark, sf):
    return entities.composition_by_entity(trips(spark, sf, *PLACES, "weather"), PLACES, "weather")


_ROLES = f"""WITH t AS ({trips_sql(*PLACES, "delayed")}), o AS (SELECT origin AS place, count(*) AS n, avg(delayed) * 100 AS r FROM t GROUP BY 1),
    d AS (SELECT destination AS place, count(*) AS n, avg(delayed) * 100 AS r FROM t GROUP BY 1),
    c AS (SELECT coalesce(o.place, d.place) AS place, coalesce(o.n, 0) AS origin_rows, coalesce(d.n, 0) AS destination_rows,
    round(o.r, 4) AS origin_pct, round(d.r, 4) AS destination_pct, round(o.r - d.r, 4) AS difference_pp FROM o FULL JOIN d ON o.place = d.place),
    e AS (SELECT o.r AS o, d.r AS d, o.r - d.r AS apart FROM o FULL JOIN d ON o.place = d.place) """


@query("role_compare", _ROLES + "SELECT * FROM c")
def _role_compare(spark, sf):
    return entities.role_compare(trips(spark, sf, *PLACES, "delayed"), "origin", "destination", "delayed")


@query(
    "role_asymmetry",
    _ROLES
    + """, s AS (SELECT count(apart) AS n, corr(o, d) AS r FROM e), m AS (SELECT n, r, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t FROM s),
    g AS (SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(0, 4001) r(i)),
    q AS (SELECT max(n) AS n, max(r) AS r, sum(w * pow(1 + pow(t * i / 4000, 2) / (n - 2), -(n - 1) / 2)) * max(t) / 12000 AS area FROM m, g)
    SELECT max(n) AS places, round(max(r), 5) AS r, round(1 - 2 * max(area) * exp(lgamma((max(n) - 1) / 2) - lgamma((max(n) - 2) / 2)) / sqrt((max(n) - 2) * pi()), 5) AS p_value,
    round(stddev_samp(o), 3) AS origin_std, round(stddev_samp(d), 3) AS destination_std, round(min(o), 4) AS origin_min, round(max(o), 4) AS origin_max,
    round(min(d), 4) AS destination_min, round(max(d), 4) AS destination_max, round(avg(abs(apart)), 3) AS mean_abs_difference,
    count(*) FILTER (WHERE abs(apart) > 1) AS above_limit FROM e, q""",
)
def _role_asymmetry(spark, sf):
    return entities.role_asymmetry(trips(spark, sf, *PLACES, "delayed"), "origin", "destination", "delayed", limit=1.0)
