"""Cleaning, scaling, encoding and whole views."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.registry import bookings, bookings_sql, logs, logs_sql, query, trips, trips_sql
from ratewise.operators import filters, prepare
from ratewise.operators.prepare import ViewSpec


@query("drop_duplicates", "SELECT DISTINCT user_id, event_type FROM events")
def _drop_duplicates(spark, sf):
    return prepare.drop_duplicates(logs(spark, sf, "event_id", "user_id", "event_type"), ["event_id"])


@query(
    "impute_median",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "surcharge")}), m AS (SELECT quantile_cont(surcharge, 0.5) AS m FROM t)
    SELECT order_id, line, distance, round(coalesce(surcharge, m), 9) AS surcharge FROM t, m""",
)
def _impute_median(spark, sf):
    df = prepare.impute_median(trips(spark, sf, "order_id", "line", "distance", "surcharge"), ["surcharge"])
    return df.withColumn("surcharge", F.round("surcharge", 9))


@query(
    "impute_mode",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "weather")}),
    m AS (SELECT weather AS w FROM t WHERE weather IS NOT NULL GROUP BY weather ORDER BY count(*) DESC, weather LIMIT 1)
    SELECT order_id, line, distance, coalesce(weather, w) AS weather FROM t, m""",
)
def _impute_mode(spark, sf):
    return prepare.impute_mode(trips(spark, sf, "order_id", "line", "distance", "weather"), ["weather"])


@query(
    "medians",
    f"""WITH t AS ({trips_sql("distance", "surcharge")}) SELECT 'distance' AS "column", round(quantile_cont(distance, 0.5), 9) AS median FROM t
    UNION ALL SELECT 'surcharge', round(quantile_cont(surcharge, 0.5), 9) FROM t""",
)
def _medians(spark, sf):
    t = prepare.medians(trips(spark, sf, "distance", "surcharge"), ["distance", "surcharge"])
    return t.withColumn("median", F.round("median", 9))


@query(
    "modes",
    f"""WITH t AS ({trips_sql("weather", "congestion")}), c AS (SELECT 'weather' AS "column", weather AS v, count(*) AS n FROM t WHERE weather IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'congestion', congestion, count(*) FROM t GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS k FROM c) SELECT "column", v AS "mode" FROM k WHERE k = 1""",
)
def _modes(spark, sf):
    return prepare.modes(trips(spark, sf, "weather", "congestion"), ["weather", "congestion"])


@query(
    "min_max_scale",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "surcharge")}), r AS (SELECT min(distance) AS a, max(distance) AS b, min(surcharge) AS c, max(surcharge) AS d FROM t)
    SELECT order_id, line, round((distance - a) / (b - a), 9) AS distance, round((surcharge - c) / (d - c), 9) AS surcharge FROM t, r""",
)
def _min_max_scale(spark, sf):
    df = prepare.min_max_scale(trips(spark, sf, "order_id", "line", "distance", "surcharge"), ["distance", "surcharge"])
    return df.withColumns({c: F.round(c, 9) for c in ("distance", "surcharge")})


@query(
    "one_hot_drop_first",
    f"""WITH t AS ({trips_sql("order_id", "line", "weather", "high_season")}) SELECT order_id, line,
    CAST(coalesce(weather = '2-HIGH', false) AS INTEGER) AS "weather_2-HIGH", CAST(coalesce(weather = '3-MEDIUM', false) AS INTEGER) AS "weather_3-MEDIUM",
    CAST(coalesce(weather = '5-LOW', false) AS INTEGER) AS "weather_5-LOW", CAST(high_season AS INTEGER) AS "high_season_True" FROM t""",
)
def _one_hot_drop_first(spark, sf):
    return prepare.one_hot_drop_first(trips(spark, sf, "order_id", "line", "weather", "high_season"), ["weather", "high_season"])


_WIDE = ("kind", "shape", "weather")


@query(
    "one_hot_vector",
    f"""WITH t AS ({trips_sql("order_id", "line", *_WIDE)}),
    u AS ({" UNION ALL ".join(f"SELECT order_id, line, '{c}' AS \"column\", {c} AS value FROM t" for c in _WIDE)}),
    f AS (SELECT "column", min(value) AS lowest FROM u GROUP BY "column")
    SELECT order_id, line, u."column", value FROM u JOIN f ON u."column" = f."column" WHERE value > lowest""",
)
def _one_hot_vector(spark, sf):
    """Places set to one, with what they stand for."""
    rows, labels = prepare.one_hot_vector(trips(spark, sf, "order_id", "line", *_WIDE), _WIDE)
    ones = rows.select("order_id", "line", F.posexplode(vector_to_array("encoded")).alias("position", "one"))
    return ones.filter("one = 1").join(labels, "position").select("order_id", "line", "column", "value")


@query(
    "min_max_scale_nan",
    f"""WITH t AS ({logs_sql("event_id", "load_nan")}), r AS (SELECT min(load_nan) AS a, max(load_nan) AS b FROM t)
    SELECT event_id, round((load_nan - a) / (b - a), 9) AS load_nan FROM t, r""",
)
def _min_max_scale_nan(spark, sf):
    scaled = prepare.min_max_scale(logs(spark, sf, "event_id", "load_nan"), ["load_nan"])
    return scaled.withColumn("load_nan", F.round("load_nan", 9))


BOOKING_COLUMNS = ("id", "price", "balance", "priority", "segment", "high_season", "delayed")


def booking_spec(deduplicate: bool = True) -> ViewSpec:
    rule = ("price_too_low", F.col("price") >= 5000)
    return ViewSpec(target="delayed", drop=["id"], rules=[rule], deduplicate=deduplicate)


def _rounded(view):
    return view.withColumns({c: F.round(c, 9) for c in ("price", "balance")})


BOOKING_VIEW = """p AS (SELECT quantile_cont(balance, 0.5) AS med, min(balance) AS lo, max(balance) AS hi, min(price) AS plo, max(price) AS phi FROM t),
    m AS (SELECT priority AS md FROM t WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1),
    f AS (SELECT *, coalesce(balance, med) AS b, coalesce(priority, md) AS pr FROM {source}, p, m) SELECT {keep}
    round((price - plo) / (phi - plo), 9) AS price, round((b - lo) / (hi - lo), 9) AS balance,
    CAST(pr = '2-HIGH' AS INTEGER) AS "priority_2-HIGH", CAST(pr = '3-MEDIUM' AS INTEGER) AS "priority_3-MEDIUM", CAST(pr = '5-LOW' AS INTEGER) AS "priority_5-LOW",
    CAST(segment = 'BUILDING' AS INTEGER) AS "segment_BUILDING", CAST(segment = 'FURNITURE' AS INTEGER) AS "segment_FURNITURE",
    CAST(segment = 'HOUSEHOLD' AS INTEGER) AS "segment_HOUSEHOLD", CAST(segment = 'MACHINERY' AS INTEGER) AS "segment_MACHINERY",
    CAST(high_season AS INTEGER) AS "high_season_True", delayed FROM f"""


@query(
    "build_view",
    f"WITH r AS ({bookings_sql(*BOOKING_COLUMNS)}), t AS (SELECT DISTINCT price, balance, priority, segment, high_season, delayed FROM r WHERE price >= 5000), "
    + BOOKING_VIEW.format(source="t", keep=""),
)
def build_view(spark, sf):
    view, _ = prepare.build_view(bookings(spark, sf, *BOOKING_COLUMNS), booking_spec())
    return _rounded(view)


@query(
    "apply_view",
    f"WITH t AS ({bookings_sql(*BOOKING_COLUMNS)}), " + BOOKING_VIEW.format(source="t", keep="id,"),
)
def _apply_view(spark, sf):
    raw = bookings(spark, sf, *BOOKING_COLUMNS)
    spec = ViewSpec(target="delayed", drop=["id"], deduplicate=False)
    params = prepare.fit_view(prepare.derive(raw, spec), spec)
    stored = prepare.params_table(raw, params)
    restored = prepare.params_from_table(stored, raw.columns)
    return _rounded(prepare.apply_view(raw, spec, restored, keep=["id"]))


_HOUR_COLUMNS = ("event_id", "hour_text", "load_known", "delayed")


@query(
    "build_view_hours",
    f"""WITH r AS ({logs_sql("hour_text", "hour", "load_known", "delayed")}), t AS (SELECT DISTINCT load_known, delayed,
    CASE WHEN hour BETWEEN 7 AND 11 THEN 'manana' WHEN hour BETWEEN 12 AND 15 THEN 'mediodia' WHEN hour BETWEEN 16 AND 19 THEN 'tarde'
    WHEN hour >= 20 OR hour = 0 THEN 'noche' ELSE 'madrugada' END AS band,
    hour + CAST(substr(hour_text, 4, 2) AS DOUBLE) / 60 AS dec FROM r),
    p AS (SELECT quantile_cont(load_known, 0.5) AS med, min(load_known) AS a, max(load_known) AS b, min(dec) AS c, max(dec) AS d FROM t)
    SELECT round((coalesce(load_known, med) - a) / (b - a), 9) AS load_known, round((dec - c) / (d - c), 9) AS timestamp_vuelo,
    CAST(band = 'manana' AS INTEGER) AS franja_horaria_manana, CAST(band = 'mediodia' AS INTEGER) AS franja_horaria_mediodia,
    CAST(band = 'noche' AS INTEGER) AS franja_horaria_noche, CAST(band = 'tarde' AS INTEGER) AS franja_horaria_tarde, delayed FROM t, p""",
)
def _build_view_hours(spark, sf):
    spec = ViewSpec(target="delayed", drop=["event_id", "hour_text"], hour="hour_text")
    view, _ = prepare.build_view(logs(spark, sf, *_HOUR_COLUMNS), spec)
    return view.withColumns({c: F.round(c, 9) for c in ("load_known", "timestamp_vuelo")})


@query(
    "view_metadata",
    f"""WITH r AS ({bookings_sql(*BOOKING_COLUMNS)}), t AS (SELECT DISTINCT price, balance, priority, segment, high_season, delayed FROM r WHERE price >= 5000)
    SELECT 'size' AS item, 'rows' AS name, CAST(count(*) AS DOUBLE) AS number FROM t UNION ALL SELECT 'size', 'features', 10 UNION ALL
    SELECT 'class', CAST(delayed AS VARCHAR), count(*) FROM t GROUP BY delayed UNION ALL
    SELECT 'filter', 'price_too_low', count(*) FILTER (WHERE price < 5000) FROM r UNION ALL
    SELECT 'filter', 'rows_before', count(*) FROM r UNION ALL SELECT 'filter', 'rows_removed', count(*) FILTER (WHERE price < 5000) FROM r UNION ALL
    SELECT 'filter', 'rows_after', count(*) FILTER (WHERE price >= 5000) FROM r UNION ALL
    SELECT 'imputed', 'balance', count(*) - count(balance) FROM t UNION ALL SELECT 'imputed', 'priority', count(*) - count(priority) FROM t""",
)
def _view_metadata(spark, sf):
    raw, spec = bookings(spark, sf, *BOOKING_COLUMNS), booking_spec()
    view, params = prepare.build_view(raw, spec)
    meta = prepare.view_metadata(raw, view, spec, params, "001")
    return meta.filter(F.col("item").isin("size", "class", "filter", "imputed")).select("item", "name", "number")


@query(
    "apply_rules",
    f"""WITH t AS ({trips_sql("order_id", "line", "distance", "minutes", "origin", "destination")}) SELECT * FROM t WHERE distance / minutes * 60 >= 50000
    AND NOT ((origin = 'NATION_3' AND destination = 'NATION_7') OR (origin = 'NATION_7' AND destination = 'NATION_3'))""",
)
def _apply_rules(spark, sf):
    df = trips(spark, sf, "order_id", "line", "distance", "minutes", "origin", "destination")
    rules = [
        ("rate_too_low", filters.min_rate_rule("distance", "minutes", 50000.0)),
        ("impossible_pair", filters.exclude_pair_rule("origin", "destination", "NATION_3", "NATION_7")),
    ]
    return filters.apply_rules(df, rules)
