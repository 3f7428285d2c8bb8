"""Nearest neighbours, trees and whole training flows over the embedding vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.feature_building import BOOKING_COLUMNS, BOOKING_VIEW
from catalog.registry import bookings, bookings_sql, query, table
from catalog.sampling import quota_sql
from catalog.tree_sql import GRID, grown, predicted, searched
from ratewise.operators import chartdata, neighbors, prepare, sampling, trees
from ratewise.plans import flows
from ratewise.sources.scratch import stage

_T = "t AS (SELECT vec_id AS id, embedding AS v, CAST(label < 5 AS INTEGER) AS delayed FROM embeddings)"
_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY delayed ORDER BY md5('42:' || id)) AS k, count(*) OVER (PARTITION BY delayed) AS n FROM t)"
# The stored components are single precision; distances are taken in doubles.
_DISTANCE = "list_distance(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("v"), (F.col("label") < 5).cast("int").alias("delayed")
    )


def _columns(spark, sf):
    """The same vectors as 64 plain feature columns."""
    v = vectors(spark, sf)
    return v.select("id", *[F.col("v")[i].cast("double").alias(f"e{i}") for i in range(64)], "delayed"), [f"e{i}" for i in range(64)]


@query(
    "knn_neighbors",
    f"""WITH {_T}, d AS (SELECT a.id AS id, b.id AS neighbor, b.delayed AS neighbor_y, {_DISTANCE.format("a.v", "b.v")} AS distance FROM t a, t b),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbor) AS rank FROM d)
    SELECT id, CAST(rank AS INTEGER) AS rank, neighbor, neighbor_y, round(distance, 9) AS distance FROM k WHERE rank <= 6""",
)
def _knn_neighbors(spark, sf):
    p = neighbors.points(vectors(spark, sf), "id", "v", "delayed")
    found = neighbors.knn_neighbors(p, p, 6)
    return found.select("id", "rank", "neighbor", "neighbor_y", F.round("distance", 9).alias("distance"))


@query(
    "knn_text_ids",
    f"""WITH {_T}, d AS (SELECT 'q' || a.id AS id, 'v-' || b.id AS neighbor, b.delayed AS neighbor_y, {_DISTANCE.format("a.v", "b.v")} AS distance FROM t a, t b),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbor) AS rank FROM d)
    SELECT id, CAST(rank AS INTEGER) AS rank, neighbor, neighbor_y, round(distance, 9) AS distance FROM k WHERE rank <= 4""",
)
def _knn_text_ids(spark, sf):
    v = vectors(spark, sf)
    named = lambda prefix: neighbors.points(v.withColumn("id", F.concat(F.lit(prefix), "id")), "id", "v", "delayed")
    found = neighbors.knn_neighbors(named("v-"), named("q"), 4)
    return found.select("id", "rank", "neighbor", "neighbor_y", F.round("distance", 9).alias("distance"))


_SPLIT = f"""WITH {_T}, {_RANKED}, {quota_sql("t")}, s AS (SELECT r.*, k <= quota AS is_test FROM r JOIN q_t ON r.delayed = q_t.delayed) """


@query(
    "knn_classify",
    _SPLIT
    + f""", d AS (SELECT a.id AS id, a.delayed AS y, b.id AS nid, b.delayed AS ny, {_DISTANCE.format("a.v", "b.v")} AS distance
    FROM s a JOIN s b ON a.is_test AND NOT b.is_test), g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nid) AS rank FROM d)
    SELECT id, y, CAST(sum(ny) * 2 > 15 AS INTEGER) AS pred, round(sum(ny) / 15, 9) AS score FROM g WHERE rank <= 15 GROUP BY id, y""",
)
def _knn_classify(spark, sf):
    split = sampling.stratified_split(vectors(spark, sf), "delayed", ["id"])
    train = neighbors.points(split.filter("NOT is_test"), "id", "v", "delayed")
    test = neighbors.points(split.filter("is_test"), "id", "v", "delayed")
    return neighbors.knn_classify(train, test, 15).withColumn("score", F.round("score", 9))


_SEARCH = f"""WITH {_T}, {_RANKED}, s AS (SELECT *, (5 * (k - 1)) // n AS fold FROM r),
    d AS (SELECT a.id AS id, a.fold AS fold, a.delayed AS y, b.id AS nid, b.delayed AS ny, {_DISTANCE.format("a.v", "b.v")} AS distance FROM s a JOIN s b ON a.fold <> b.fold),
    g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nid) AS rank FROM d),
    v AS (SELECT *, sum(ny) OVER (PARTITION BY id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS votes FROM g WHERE rank <= 30),
    f AS (SELECT rank, fold, avg(CASE WHEN CAST(votes * 2 > rank AS INTEGER) = y THEN 1.0 ELSE 0.0 END) AS acc FROM v GROUP BY rank, fold),
    e AS (SELECT CAST(rank AS INTEGER) AS k, round(avg(acc), 9) AS accuracy_mean, round(stddev_pop(acc), 9) AS accuracy_std FROM f GROUP BY rank),
    b AS (SELECT *, row_number() OVER (ORDER BY accuracy_mean DESC, k) = 1 AS best FROM e) """


def _k_search(spark, sf):
    folded = sampling.stratified_kfold(vectors(spark, sf), "delayed", ["id"])
    return neighbors.knn_k_search(neighbors.points(folded, "id", "v", "delayed", "fold"), 30)


@query("knn_k_search", _SEARCH + "SELECT k, accuracy_mean, accuracy_std, best FROM b")
def _knn_k_search(spark, sf):
    return _k_search(spark, sf)


@query(
    "error_band",
    _SEARCH + "SELECT k, accuracy_mean, round(accuracy_mean - accuracy_std, 9) AS low, round(accuracy_mean + accuracy_std, 9) AS high, best FROM b",
)
def _error_band(spark, sf):
    return chartdata.error_band(_k_search(spark, sf))


def _booking_rows(spark, sf):
    raw = bookings(spark, sf, *BOOKING_COLUMNS)
    spec = prepare.ViewSpec(target="delayed", drop=["id"], deduplicate=False)
    params = prepare.fit_view(prepare.derive(raw, spec), spec)
    return stage(prepare.apply_view(raw, spec, params, keep=["id"]), "booking-view"), params.feature_names()


# The view's rows with their features in long form, split; thresholds come from the training rows (fold 0).
_BOOKING_FEATURES = ("price", "balance", "priority_2-HIGH", "priority_3-MEDIUM", "priority_5-LOW", "segment_BUILDING", "segment_FURNITURE", "segment_HOUSEHOLD", "segment_MACHINERY", "high_season_True")
BOOKING_TREE = (
    f"t AS ({bookings_sql(*BOOKING_COLUMNS)}), view AS (WITH "
    + BOOKING_VIEW.format(source="t", keep="id,").replace("round((price - plo) / (phi - plo), 9)", "(price - plo) / (phi - plo)").replace("round((b - lo) / (hi - lo), 9)", "(b - lo) / (hi - lo)")
    + f"""), r AS (SELECT id, delayed, row_number() OVER (PARTITION BY delayed ORDER BY md5('42:' || id)) AS k FROM view), {quota_sql("view")},
    rows AS (SELECT id, CAST(k <= quota AS INTEGER) AS fold, r.delayed AS y, NOT k <= quota AS known FROM r JOIN q_view ON r.delayed = q_view.delayed),
    x AS ("""
    + " UNION ALL ".join(f'SELECT id, {i} AS feature, CAST("{c}" AS DOUBLE) AS value FROM view' for i, c in enumerate(_BOOKING_FEATURES))
    + ")"
)


@query(
    "tree_predict",
    f"WITH RECURSIVE {BOOKING_TREE}, g AS (SELECT 0 AS tree, 1 AS held, 'gini' AS criterion, 10 AS leaf, 5 AS depth, 2 AS split), {grown('', 'rows', 'x', 'g')}, {predicted('', 'rows')} SELECT id, y, pred, round(score, 12) AS score FROM p",
)
def _tree_predict(spark, sf):
    rows, features = _booking_rows(spark, sf)
    split = sampling.stratified_split(rows, "delayed", ["id"])
    params = trees.TreeParams("gini", 5, 10, 2)
    model = trees.tree_fit(trees.assemble(split.filter("NOT is_test"), features, "delayed"), params)
    found = trees.tree_predict(model, trees.assemble(split.filter("is_test"), features, "delayed", ["id"]), ["id"])
    return found.withColumn("score", F.round("score", 12))


_LONG_VECTORS = "SELECT vec_id AS id, unnest(range(64)) AS feature, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings"


@query(
    "tree_grid_search",
    f"""WITH RECURSIVE {_T}, {_RANKED}, rows AS (SELECT id, CAST((5 * (k - 1)) // n AS INTEGER) AS fold, delayed AS y, true AS known FROM r), x AS ({_LONG_VECTORS}),
    {GRID.format('')}, {grown('', 'rows', 'x', 'g')}, {searched('')}
    SELECT CAST(position AS INTEGER) AS position, criterion, nullif(depth, -1) AS max_depth, leaf AS min_leaf, split AS min_split, accuracy_mean, accuracy_std, best FROM search""",
)
def _tree_grid_search(spark, sf):
    rows, features = _columns(spark, sf)
    folded = sampling.stratified_kfold(rows, "delayed", ["id"])
    return trees.tree_grid_search(trees.assemble(folded, features, "delayed", ["fold"]))


# The five metrics of a table p(y, pred, score) with both classes and both predictions present.
METRICS_SQL = """c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = pred) AS ok, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
    count(*) FILTER (WHERE pred = 1) AS pp, count(*) FILTER (WHERE y = 1) AS ap, count(*) FILTER (WHERE y = 0) AS an FROM p),
    z AS (SELECT ok / n AS acc, tp / pp AS pr, tp / ap AS re, ap, an FROM c),
    h AS (SELECT score, count(*) FILTER (WHERE y = 1) AS a, count(*) FILTER (WHERE y = 0) AS b FROM p GROUP BY score),
    j AS (SELECT *, sum(a) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) - a AS above FROM h),
    u AS (SELECT sum(b * (above + a / 2)) AS wins FROM j)
    SELECT round(acc, 12) AS accuracy, round(pr, 12) AS "precision", round(re, 12) AS recall, round(2 * pr * re / (pr + re), 12) AS f1,
    round(CAST(wins AS DOUBLE) / CAST(ap * an AS DOUBLE), 9) AS auc_roc FROM z, u"""


@query(
    "train_knn",
    _SPLIT
    + f""", tr AS (SELECT id, v, s.delayed AS delayed, (5 * (s.k - CAST(quota AS BIGINT) - 1)) // (n - CAST(quota AS BIGINT)) AS fold FROM s JOIN q_t ON s.delayed = q_t.delayed WHERE NOT is_test),
    d AS (SELECT a.id AS id, a.fold AS fold, a.delayed AS y, b.id AS nid, b.delayed AS ny, {_DISTANCE.format("a.v", "b.v")} AS distance FROM tr a JOIN tr b ON a.fold <> b.fold),
    g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nid) AS rank FROM d),
    vt AS (SELECT *, sum(ny) OVER (PARTITION BY id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS votes FROM g WHERE rank <= 30),
    fa AS (SELECT rank, fold, avg(CASE WHEN CAST(votes * 2 > rank AS INTEGER) = y THEN 1.0 ELSE 0.0 END) AS acc FROM vt GROUP BY rank, fold),
    bk AS (SELECT rank AS k FROM fa GROUP BY rank ORDER BY round(avg(acc), 9) DESC, rank LIMIT 1),
    td AS (SELECT a.id AS id, a.delayed AS y, b.id AS nid, b.delayed AS ny, {_DISTANCE.format("a.v", "b.v")} AS distance FROM s a JOIN tr b ON a.is_test),
    tg AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nid) AS rank FROM td),
    p AS (SELECT id, y, CAST(sum(ny) * 2 > max(k) AS INTEGER) AS pred, sum(ny) / max(k) AS score FROM tg, bk WHERE rank <= k GROUP BY id, y), """
    + METRICS_SQL,
)
def _train_knn(spark, sf):
    rows, features = _columns(spark, sf)
    return flows.train_knn(rows, "id", features, "delayed").metrics


@query(
    "train_tree",
    f"""WITH RECURSIVE {_T}, {_RANKED}, m AS (SELECT min(n) AS q FROM r), s AS (SELECT id, delayed, k FROM r, m WHERE k <= q), {quota_sql("s")},
    w AS (SELECT id, s.delayed AS y, k, CAST(quota AS BIGINT) AS quota FROM s JOIN q_s ON s.delayed = q_s.delayed), x AS ({_LONG_VECTORS}),
    s_rows AS (SELECT id, CAST((5 * (k - quota - 1)) // (count(*) OVER (PARTITION BY y)) AS INTEGER) AS fold, y, true AS known FROM w WHERE k > quota),
    {GRID.format("s_")}, {grown("s_", "s_rows", "x", "s_g")}, {searched("s_")},
    f_rows AS (SELECT id, CAST(k <= quota AS INTEGER) AS fold, y, k > quota AS known FROM w), f_g AS (SELECT 0 AS tree, 1 AS held, criterion, leaf, depth, split FROM s_search WHERE best),
    {grown("f_", "f_rows", "x", "f_g")}, {predicted("f_", "f_rows")}, """
    + METRICS_SQL,
)
def _train_tree(spark, sf):
    rows, features = _columns(spark, sf)
    return flows.train_tree(rows, "id", features, "delayed", balance=True).metrics
