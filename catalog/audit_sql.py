"""The whole audit in SQL: one SELECT per rule over the bound rows ``t``."""

from __future__ import annotations

NUMERIC = ("distance", "minutes", "load", "surcharge", "visibility", "delayed")
TEXTS = ("weather", "congestion", "kind", "high_season", "origin", "destination")
COLUMNS = ("distance", "minutes", "load", "surcharge", "visibility", "weather", "congestion", "kind", "high_season", "origin", "destination", "delayed")


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _shown(value: str, digits: int) -> str:
    """As printed with so many digits, ties away from zero."""
    return f"format('{{:.{digits}f}}', round(CAST({value} AS DOUBLE), {digits}))"


def _rule(section: str, column: str, level: str, rule: str, value: str, threshold: str, text: str, source: str, when: str = "true") -> str:
    return f"""SELECT '{section}' AS section, {column} AS "column", {level} AS level, '{rule}' AS rule, CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, {text} AS "text" FROM {source} WHERE {when}"""


def _either(condition: str, yes: str, no: str = "INFO") -> str:
    return f"CASE WHEN {condition} THEN '{yes}' ELSE '{no}' END"


def audit_sql(rows: str) -> str:
    text = lambda c: f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' END" if c == "high_season" else c
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]]
    tables = f"""WITH t AS MATERIALIZED ({rows}),
    u AS ({_union(f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS v FROM t WHERE {c} IS NOT NULL" for c in NUMERIC)}),
    w AS ({_union(f"SELECT '{c}' AS c, {text(c)} AS v, delayed FROM t WHERE {c} IS NOT NULL" for c in TEXTS)}),
    gaps AS ({_union(f"SELECT '{c}' AS c, count(*) - count({c}) AS n, round(CAST((count(*) - count({c})) * 100.0 AS DOUBLE) / count(*), 2) AS pct FROM t" for c in COLUMNS)}),
    holes AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM gaps),
    copies AS (SELECT (SELECT count(*) FROM t) - count(*) AS n FROM (SELECT DISTINCT * FROM t)),
    m AS (SELECT c, avg(v) AS mean, count(*) AS n FROM u GROUP BY c),
    k AS (SELECT u.c, max(n) AS n, sum(pow(v - mean, 2)) / max(n) AS m2, sum(pow(v - mean, 3)) / max(n) AS m3, sum(pow(v - mean, 4)) / max(n) AS m4 FROM u JOIN m USING (c) GROUP BY u.c),
    shape AS (SELECT c, m3 / pow(m2, 1.5) * sqrt(CAST(n AS DOUBLE) * (n - 1)) / (n - 2) AS s, (n - 1) / (CAST(n - 2 AS DOUBLE) * (n - 3)) * ((n + 1) * (m4 / (m2 * m2) - 3) + 6) AS k FROM k),
    q AS (SELECT c, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM u GROUP BY c),
    l AS (SELECT c, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q),
    far AS (SELECT u.c, count(*) FILTER (WHERE v < low OR v > high) AS n, round(CAST(count(*) FILTER (WHERE v < low OR v > high) * 100.0 AS DOUBLE) / count(*), 4) AS pct, round(max(low), 6) AS low, round(max(high), 6) AS high FROM u JOIN l USING (c) GROUP BY u.c),
    signs AS (SELECT c, count(*) FILTER (WHERE v = 0) AS zeros, count(*) FILTER (WHERE v < 0) AS negatives FROM u GROUP BY c),
    tops AS (SELECT c, v, n, n / sum(n) OVER (PARTITION BY c) AS share FROM (SELECT c, v, count(*) AS n FROM u GROUP BY c, v) QUALIFY row_number() OVER (PARTITION BY c ORDER BY n DESC, v) = 1),
    cells AS (SELECT c, v, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY c) AS share, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY c), 4) AS pct, sum(delayed) * 100.0 / count(*) AS rate FROM w GROUP BY c, v),
    categories AS (SELECT c, count(*) AS n, arg_max(v, n) AS top, max(share) AS share, count(*) FILTER (WHERE share < 0.01) AS rare, round(min(rate), 4) AS lo, round(max(rate), 4) AS hi, max(rate) - min(rate) AS spread FROM cells GROUP BY c),
    ends AS (SELECT count(*) FILTER (WHERE origin IN ('NATION_3', 'NATION_7') AND destination IN ('NATION_3', 'NATION_7') AND origin <> destination) AS hits, count(*) AS n, count(*) FILTER (WHERE origin = destination) AS same FROM t),
    routes AS (SELECT origin, destination, count(*) AS n FROM t WHERE origin IS NOT NULL AND destination IS NOT NULL GROUP BY ALL),
    busiest AS (SELECT * FROM routes ORDER BY n DESC, origin, destination LIMIT 10),
    ways AS (SELECT count(*) AS n FROM (SELECT least(origin, destination), greatest(origin, destination) FROM routes GROUP BY 1, 2 HAVING count(*) = 1)),
    rated AS (SELECT *, distance / nullif(minutes, 0) * 60 AS rate FROM t),
    band AS (SELECT count(*) FILTER (WHERE rate < 150) AS slow, count(*) FILTER (WHERE rate > 950 OR (minutes = 0 AND distance > 0)) AS fast FROM rated),
    crawls AS (SELECT origin, destination, count(*) AS n FROM rated WHERE rate < 150 AND origin IS NOT NULL AND destination IS NOT NULL GROUP BY ALL),
    r AS (SELECT round(corr(distance, minutes), 6) AS r FROM t),
    speeds AS (SELECT kind, avg(rate) AS mean, min(rate) AS least, max(rate) AS most FROM rated WHERE kind IS NOT NULL GROUP BY kind),
    spread AS (SELECT round(max(mean) - min(mean), 1) AS shown, max(mean) - min(mean) AS raw FROM speeds),
    loads AS (SELECT count(*) FILTER (WHERE load > 100) AS above, count(*) FILTER (WHERE load < 0) AS below, count(*) FILTER (WHERE load = 0) AS zero FROM t),
    classes AS (SELECT min(n) / max(n) AS ratio FROM (SELECT delayed, count(*) AS n FROM t WHERE delayed IS NOT NULL GROUP BY delayed)),
    related AS ({_union(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM t" for a, b in pairs)}),
    strong AS (SELECT count(*) FILTER (WHERE abs(r) > 0.7) AS n FROM related) """
    route = "origin || ' to ' || destination || ': ' || n || ' rows"
    grade = "CASE WHEN ratio < 0.25 THEN 'severe' WHEN ratio < 0.5 THEN 'moderate' ELSE 'acceptable' END"
    level = "CASE WHEN abs(s) > 2 THEN 'high' WHEN abs(s) > 1 THEN 'moderate' ELSE 'low' END"
    rules = [
        _rule("overview", "'*'", _either("n > 0", "ANOMALY"), "null_cells", "n", "0", "n || ' null cells'", "holes"),
        _rule("overview", "c", "'INFO'", "null_column", "n", "0", f"c || ': ' || n || ' nulls (' || {_shown('pct', 1)} || '%)'", "gaps", "n > 0"),
        _rule("overview", "'*'", _either("n > 0", "ANOMALY"), "duplicate_rows", "n", "0", "n || ' duplicate rows'", "copies"),
        _rule("numeric", "c", _either("abs(s) > 2", "FINDING"), "skewness", "round(s, 6)", "CASE WHEN abs(s) > 2 THEN 2 ELSE 1 END", f"{level} || ' skewness: ' || {_shown('round(s, 6)', 2)}", "shape", "abs(s) > 1"),
        _rule("numeric", "c", "'FINDING'", "kurtosis", "round(k, 6)", "7", f"'heavy tails, kurtosis ' || {_shown('round(k, 6)', 2)}", "shape", "abs(k) > 7"),
        _rule("numeric", "c", _either("n > 0", "FINDING"), "iqr_outliers", "n", "1.5", f"n || ' outliers (' || {_shown('pct', 1)} || '%) outside ' || {_shown('low', 1)} || ' to ' || {_shown('high', 1)}", "far"),
        _rule("numeric", "c", "'FINDING'", "zeros", "zeros", "0", "zeros || ' zeros'", "signs", "zeros > 0"),
        _rule("numeric", "c", "'ANOMALY'", "negatives", "negatives", "0", "negatives || ' negative values'", "signs", "negatives > 0"),
        _rule("numeric", "c", "'FINDING'", "dominant_value", "round(share * 100, 4)", "25", f"CAST(v AS VARCHAR) || ' holds ' || {_shown('round(share * 100, 4)', 1)} || '% of the values'", "tops", "share > 0.25"),
        _rule("categorical", "c", "'FINDING'", "high_cardinality", "n", "30", "n || ' categories'", "categories", "n > 30"),
        _rule("categorical", "c", "'ANOMALY'", "dominant_category", "round(share, 6) * 100", "80", f"'''' || top || ''' holds ' || {_shown('round(share, 6) * 100', 1)} || '%'", "categories", "share > 0.8"),
        _rule("categorical", "c", "'FINDING'", "rare_categories", "rare", "1", "rare || ' categories below 1%'", "categories", "rare > 0"),
        _rule("categorical", "c", "'INFO'", "category_share", "pct", "NULL", f"'''' || v || ''': ' || n || ' rows (' || {_shown('pct', 1)} || '%)'", "cells"),
        _rule("categorical", "c", "'INFO'", "category_rate", "round(rate, 4)", "NULL", f"'''' || v || ''': rate ' || {_shown('round(rate, 4)', 1)} || '% of ' || n || ' rows'", "cells"),
        _rule("categorical", "c", _either("spread > 15", "FINDING"), "rate_spread", "round(spread, 4)", "15", f"'rate from ' || {_shown('lo', 1)} || '% to ' || {_shown('hi', 1)} || '% (' || {_shown('round(spread, 4)', 1)} || ' pp)'", "categories"),
        _rule("coherence", "'origin,destination'", "'CRITICAL'", "impossible_route", "hits", "0", f"hits || ' rows (' || {_shown('round(CAST(hits * 100.0 AS DOUBLE) / n, 4)', 1)} || '%) on a route that does not exist'", "ends", "hits > 0"),
        _rule("coherence", "'origin,destination'", _either("same > 0", "ANOMALY"), "same_ends", "same", "0", "same || ' rows with equal ends'", "ends"),
        _rule("coherence", "'origin,destination'", "'INFO'", "top_route", "n", "NULL", route + "'", "busiest"),
        _rule("coherence", "'origin,destination'", _either("n > 0", "FINDING"), "one_way_routes", "n", "0", "n || ' routes run in one direction only'", "ways"),
        _rule("coherence", "'distance,minutes'", "'FINDING'", "rate_too_low", "slow", "150", "slow || ' rows below 150 per hour'", "band", "slow > 0"),
        _rule("coherence", "'origin,destination'", "'INFO'", "slow_route", "n", "NULL", route + " below 150 per hour'", "crawls"),
        _rule("coherence", "'distance,minutes'", _either("fast > 0", "ANOMALY"), "rate_too_high", "fast", "950", "fast || ' rows above 950 per hour'", "band"),
        _rule("coherence", "'distance,minutes'", "'INFO'", "distance_time_correlation", "r", "NULL", f"'correlation ' || {_shown('r', 4)}", "r"),
        _rule("coherence", "'distance,minutes'", "'ANOMALY'", "distance_time_low", "r", "0.9", f"'correlation ' || {_shown('r', 4)} || ' below the expected 0.90'", "r", "r < 0.9"),
        _rule("coherence", "'kind'", "'INFO'", "type_rate", "round(mean, 1)", "NULL", f"kind || ': mean ' || {_shown('mean', 1)} || ', from ' || {_shown('least', 1)} || ' to ' || {_shown('most', 1)}", "speeds"),
        _rule("coherence", "'kind'", "'FINDING'", "type_mean_spread", "shown", "30", f"'type means differ by only ' || {_shown('shown', 1)}", "spread", "raw < 30"),
        *[_rule("coherence", "'load'", f"'{lv}'", rule, c, limit, f"{c} || ' rows'", "loads", f"{c} > 0") for rule, c, lv, limit in (("above_100", "above", "ANOMALY", "100"), ("below_0", "below", "ANOMALY", "0"), ("exactly_0", "zero", "FINDING", "0"))],
        _rule("target", "'delayed'", "CASE WHEN ratio < 0.25 THEN 'ANOMALY' WHEN ratio < 0.5 THEN 'FINDING' ELSE 'INFO' END", "class_balance", "round(ratio, 6)", "0.5", f"{grade} || ' balance, ratio ' || {_shown('round(ratio, 6)', 2)}", "classes"),
        _rule("correlation", "CASE WHEN x = 'delayed' THEN y ELSE x END", "'FINDING'", "drop_candidate", "r", "0.05", f"'correlation ' || {_shown('r', 4)} || ', candidate to drop'", "related", "'delayed' IN (x, y) AND abs(r) < 0.05"),
        _rule("correlation", "x || ',' || y", "'FINDING'", "collinear", "r", "0.7", f"'correlation ' || {_shown('r', 4)} || ', possibly redundant'", "related", "abs(r) > 0.7"),
        _rule("correlation", "'*'", "'INFO'", "no_collinearity", "n", "0.7", "'no pair above 0.7'", "strong", "n = 0"),
    ]
    return tables + ", audit AS (" + _union(rules) + ") "


SEVERITY = "CASE level WHEN 'CRITICAL' THEN 0 WHEN 'ANOMALY' THEN 1 WHEN 'FINDING' THEN 2 ELSE 3 END"
