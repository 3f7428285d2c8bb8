"""Decision trees in SQL: the same rules as the library's, grown by a recursive query over all rows.

``rows`` is a table (id, fold, y, known): thresholds come from known rows; ``x`` is (id, feature, value); ``g`` is (tree, held,
criterion, leaf, depth, split): rows of fold ``held`` move along without being counted, depth -1 is no limit.
"""

from __future__ import annotations

from ratewise.operators.trees import GAIN_DIGITS, MAX_BINS


def _gini(n: str, p: str) -> str:
    s = f"({p} / {n})"
    return f"(1.0 - {s} * {s} - (1.0 - {s}) * (1.0 - {s}))"


def _entropy(n: str, p: str) -> str:
    part = lambda s: f"CASE WHEN {s} > 0 THEN {s} * log2({s}) ELSE 0.0 END"
    return f"(-({part(f'({p} / {n})')}) - ({part(f'(1.0 - {p} / {n})')}))"


def _gain(impurity) -> str:
    parts = f"(ln / n * {impurity('ln', 'lp')} + (n - ln) / n * {impurity('(n - ln)', '(p - lp)')})"
    return f"round({impurity('n', 'p')} - {parts}, {GAIN_DIGITS})"


def grown(prefix: str, rows: str, x: str, g: str) -> str:
    """CTEs up to {prefix}a (tree, level, node, id), every row's path in every tree, and {prefix}nodes."""
    p = prefix
    return f"""{p}known AS (SELECT feature, value FROM {x} JOIN {rows} USING (id) WHERE known),
    {p}values AS (SELECT DISTINCT feature, value FROM {p}known),
    {p}sizes AS (SELECT feature, count(*) AS d FROM {p}values GROUP BY feature),
    {p}ranked AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY feature) AS n FROM {p}known),
    {p}spaced AS (SELECT DISTINCT k.feature, k.value FROM {p}ranked k JOIN {p}sizes USING (feature) JOIN range(1, {MAX_BINS}) AS i(i) ON k.r = (i.i * (k.n - 1)) // {MAX_BINS} WHERE d > {MAX_BINS}),
    {p}cuts AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS b FROM
        (SELECT v.feature, v.value FROM {p}values v JOIN {p}sizes USING (feature) WHERE d <= {MAX_BINS} UNION ALL SELECT * FROM {p}spaced)),
    {p}bins AS MATERIALIZED (SELECT x.id, x.feature, coalesce(c.b, 0) AS bin, r.fold, r.y FROM {x} x JOIN {rows} r USING (id) ASOF LEFT JOIN {p}cuts c ON x.feature = c.feature AND x.value > c.value),
    {p}a AS (
        SELECT 0 AS level, tree, CAST(1 AS HUGEINT) AS node, id FROM {g}, {rows}
        UNION ALL (
        WITH h AS (SELECT a.tree, a.node, a.level, x.feature, x.bin, count(*) AS n, sum(x.y) AS p FROM {p}a a JOIN {g} g ON g.tree = a.tree AND (g.depth < 0 OR a.level < g.depth) JOIN {p}bins x ON x.id = a.id AND x.fold <> g.held GROUP BY ALL),
        c AS (SELECT tree, node, level, feature, bin, sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(n) OVER f AS n, sum(p) OVER f AS p FROM h
            WINDOW w AS (PARTITION BY tree, node, feature ORDER BY bin), f AS (PARTITION BY tree, node, feature)),
        b AS (SELECT c.tree, node, level, feature, bin FROM c JOIN {g} g ON g.tree = c.tree AND ln >= g.leaf AND n - ln >= g.leaf AND n >= g.split WHERE n > ln AND p > 0 AND p < n
            QUALIFY row_number() OVER (PARTITION BY c.tree, node ORDER BY CASE criterion WHEN 'gini' THEN {_gain(_gini)} ELSE {_gain(_entropy)} END DESC, feature, bin) = 1)
        SELECT a.level + 1, a.tree, 2 * a.node + CAST(x.bin > b.bin AS INTEGER), a.id FROM {p}a a JOIN b ON b.tree = a.tree AND b.node = a.node AND b.level = a.level JOIN {p}bins x ON x.id = a.id AND x.feature = b.feature)
    ),
    {p}nodes AS MATERIALIZED (SELECT tree, level, node, count(*) FILTER (WHERE fold <> held) AS n, coalesce(sum(y) FILTER (WHERE fold <> held), 0) AS p,
        count(*) FILTER (WHERE fold = held) AS held_n, coalesce(sum(y) FILTER (WHERE fold = held), 0) AS held_p FROM {p}a JOIN {g} USING (tree) JOIN {rows} USING (id) GROUP BY ALL)"""


GRID = """{0}g AS (SELECT (row_number() OVER (ORDER BY held, criterion, leaf)) AS tree, held, criterion, leaf, -1 AS depth, 2 AS split FROM
        (SELECT unnest(range(5)) AS held), (SELECT unnest(['gini', 'entropy']) AS criterion), (SELECT unnest([1, 2, 5, 10]) AS leaf))"""


def searched(prefix: str) -> str:
    """CTEs up to {prefix}search, the table of the grid search, from {prefix}g and {prefix}nodes."""
    p = prefix
    return f"""{p}settings AS (SELECT (row_number() OVER (ORDER BY c.i, d.i, l.i, s.i)) - 1 AS position, c.v AS criterion, d.v AS depth, l.v AS leaf, s.v AS split FROM
        (SELECT unnest(range(2)) AS i, unnest(['gini', 'entropy']) AS v) c, (SELECT unnest(range(6)) AS i, unnest([3, 5, 7, 10, 15, -1]) AS v) d,
        (SELECT unnest(range(4)) AS i, unnest([1, 2, 5, 10]) AS v) l, (SELECT unnest(range(4)) AS i, unnest([2, 5, 10, 20]) AS v) s),
    {p}kin AS (SELECT m.*, up.n AS above, down.node IS NULL AS is_leaf FROM {p}nodes m LEFT JOIN {p}nodes up ON up.tree = m.tree AND up.level = m.level - 1 AND up.node = m.node // 2
        LEFT JOIN {p}nodes down ON down.tree = m.tree AND down.level = m.level + 1 AND down.node = 2 * m.node),
    {p}hits AS (SELECT position, g.held, sum(CASE WHEN 2 * k.p > k.n THEN held_p ELSE held_n - held_p END) / sum(held_n) AS accuracy
        FROM {p}kin k JOIN {p}g g USING (tree) JOIN {p}settings t ON t.criterion = g.criterion AND t.leaf = g.leaf
        WHERE (level = 0 OR above >= t.split) AND (t.depth < 0 OR level <= t.depth) AND (is_leaf OR k.n < t.split OR level = t.depth) GROUP BY position, g.held),
    {p}scores AS (SELECT position, round(avg(accuracy), 9) AS accuracy_mean, round(stddev_pop(accuracy), 9) AS accuracy_std FROM {p}hits GROUP BY position),
    {p}search AS (SELECT t.*, accuracy_mean, accuracy_std, row_number() OVER (ORDER BY accuracy_mean DESC, position) = 1 AS best FROM {p}scores JOIN {p}settings t USING (position))"""


def predicted(prefix: str, rows: str) -> str:
    """CTE p (id, y, pred, score): where the rows outside training (fold 1) end in the only tree."""
    return f"""p AS (SELECT id, y, CAST(score > 0.5 AS INTEGER) AS pred, score FROM (SELECT r.id, r.y, arg_max(m.p / m.n, a.level) AS score
        FROM {prefix}a a JOIN {prefix}nodes m USING (tree, level, node) JOIN {rows} r USING (id) WHERE r.fold = 1 GROUP BY r.id, r.y))"""
