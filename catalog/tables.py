"""Sources and sinks: each query writes to the shared scratch folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.feature_building import BOOKING_COLUMNS, BOOKING_VIEW, _rounded, booking_spec
from catalog.models import _DISTANCE, _RANKED, _T, BOOKING_TREE, METRICS_SQL, _booking_rows, _columns, vectors
from catalog.registry import bookings, bookings_sql, query, table, trips, trips_sql
from catalog.sampling import quota_sql
from catalog.tree_sql import grown, predicted
from ratewise.operators import evaluate as ev
from ratewise.operators import neighbors, rates, sampling, trees
from ratewise.plans import flows
from ratewise.sources import models, tables
from ratewise.sources.scratch import new_path


@query("load_table", 'SELECT count(*) AS "rows", CAST(11 AS BIGINT) AS "columns" FROM lineitem')
def _load_table(spark, sf):
    return tables.table_shape(tables.load_table(spark, f"{sf}/lineitem.parquet"))


@query("load_table_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _load_table_csv(spark, sf):
    source, path = table(spark, sf, "customer"), new_path(spark, "csv")
    source.write.option("header", True).csv(path)
    return tables.load_table(spark, path, "csv", source.schema)


_VIEW = f"WITH r AS ({bookings_sql(*BOOKING_COLUMNS)}), t AS (SELECT DISTINCT price, balance, priority, segment, high_season, delayed FROM r WHERE price >= 5000), "


@query("write_view", _VIEW + BOOKING_VIEW.format(source="t", keep=""))
def _write_view(spark, sf):
    root = new_path(spark, "views")
    view_id, _ = flows.publish_view(bookings(spark, sf, *BOOKING_COLUMNS), booking_spec(), root)
    return _rounded(tables.load_view(spark, root, view_id))


@query(
    "view_registry",
    f"""WITH r AS ({bookings_sql(*BOOKING_COLUMNS)}), t AS (SELECT DISTINCT price, balance, priority, segment, high_season, delayed FROM r WHERE price >= 5000)
    SELECT '001' AS view_id, count(*) AS "rows", CAST(10 AS BIGINT) AS features FROM t UNION ALL
    SELECT '002', count(*), CAST(10 AS BIGINT) FROM r""",
)
def _view_registry(spark, sf):
    root, raw = new_path(spark, "views"), bookings(spark, sf, *BOOKING_COLUMNS)
    flows.publish_view(raw, booking_spec(), root)
    whole = booking_spec(deduplicate=False)
    whole.rules = ()
    flows.publish_view(raw, whole, root)
    return tables.view_registry(spark, root)


@query(
    "write_summary",
    f"WITH t AS ({trips_sql('weather', 'delayed')}) SELECT weather, count(*) AS total, round(avg(delayed) * 100, 2) AS rate_pct FROM t WHERE weather IS NOT NULL GROUP BY weather",
)
def _write_summary(spark, sf):
    summary = rates.rate_by_category(trips(spark, sf, "weather", "delayed"), "weather", "delayed")
    path = tables.write_summary(summary, new_path(spark, "summary"))
    return tables.load_table(spark, path, "csv", summary.schema)


@query(
    "score_saved_model",
    f"WITH RECURSIVE {BOOKING_TREE}, g AS (SELECT 0 AS tree, 1 AS held, 'entropy' AS criterion, 5 AS leaf, 5 AS depth, 20 AS split), {grown('', 'rows', 'x', 'g')}, {predicted('', 'rows')}, " + METRICS_SQL,
)
def _score_saved_model(spark, sf):
    root, (rows, features) = new_path(spark, "models"), _booking_rows(spark, sf)
    train = sampling.stratified_split(rows, "delayed", ["id"]).filter("NOT is_test")
    params = trees.TreeParams("entropy", 5, 5, 20)
    model = models.TreeModel(trees.tree_fit(trees.assemble(train, features, "delayed"), params), params)
    models.save_tree(model, spark, root, "001")
    return flows.evaluate_saved_model(models.load_tree(spark, root, "001"), rows, "id", features, "delayed")


@query(
    "score_saved_knn",
    f"""WITH {_T}, {_RANKED}, m AS (SELECT min(n) AS q FROM r), s AS (SELECT id, v, delayed, k FROM r, m WHERE k <= q), {quota_sql("s")},
    w AS (SELECT s.*, k <= quota AS is_test FROM s JOIN q_s ON s.delayed = q_s.delayed),
    a AS (SELECT id, v, delayed FROM w WHERE is_test UNION ALL SELECT id, v, delayed FROM r, m WHERE k > q),
    d AS (SELECT a.id AS id, a.delayed AS y, b.id AS nid, b.delayed AS ny, {_DISTANCE.format("a.v", "b.v")} AS distance FROM a JOIN w b ON NOT b.is_test),
    g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nid) AS rank FROM d),
    p AS (SELECT id, y, CAST(sum(ny) * 2 > 9 AS INTEGER) AS pred, sum(ny) / 9 AS score FROM g WHERE rank <= 9 GROUP BY id, y), """
    + METRICS_SQL,
)
def _score_saved_knn(spark, sf):
    root, (rows, features) = new_path(spark, "models"), _columns(spark, sf)
    marked = sampling.undersample_majority(rows, "delayed", ["id"])
    train = sampling.stratified_split(marked, "delayed", ["id"]).filter("NOT is_test")
    points = neighbors.points(train, "id", neighbors.vector_of(features), "delayed")
    models.save_knn(models.KnnModel(points, 9), root, "001")
    loaded = models.load_knn(spark, root, "001")
    return flows.evaluate_saved_model(loaded, rows, "id", features, "delayed", balance=True)


def _stored(spark, sf, root):
    """Metrics of the sign of one vector component as a predictor, stored as model 'sign' 001."""
    p = vectors(spark, sf).select(F.col("delayed").alias("y"), (F.col("v")[0] > 0).cast("int").alias("pred"), F.col("v")[0].alias("score"))
    rows = ev.metric_rows(ev.binary_metrics(p, "y", "pred"), "sign", "001", "001")
    models.save_metrics(rows, root)
    return models.load_metrics(spark, root)


_SIGN = """WITH p AS (SELECT CAST(label < 5 AS INTEGER) AS y, CAST(embedding[1] > 0 AS INTEGER) AS pred FROM embeddings),
    m AS (SELECT count(*) FILTER (WHERE y = pred) / count(*) AS acc, count(*) FILTER (WHERE y = 1 AND pred = 1) / count(*) FILTER (WHERE pred = 1) AS pr,
    count(*) FILTER (WHERE y = 1 AND pred = 1) / count(*) FILTER (WHERE y = 1) AS re FROM p),
    k AS (SELECT 'accuracy' AS metric, round(acc, 12) AS value FROM m UNION ALL SELECT 'precision', round(pr, 12) FROM m UNION ALL
    SELECT 'recall', round(re, 12) FROM m UNION ALL SELECT 'f1', round(2 * pr * re / (pr + re), 12) FROM m) """


@query("save_metrics", _SIGN + "SELECT 'sign' AS model, '001' AS model_id, '001' AS view_id, metric, value FROM k")
def _save_metrics(spark, sf):
    return _stored(spark, sf, new_path(spark, "metrics"))


@query(
    "model_card",
    _SIGN
    + """SELECT 'view' AS item, 'view_id' AS name, '001' AS "text" UNION ALL SELECT 'parameter', 'component', '0' UNION ALL
    SELECT 'metric', metric, format('{:.4f}', value) FROM k""",
)
def _model_card(spark, sf):
    params = spark.createDataFrame([("component", "0")], models.PARAM_SCHEMA)
    return models.model_card(_stored(spark, sf, new_path(spark, "metrics")), params, "sign", "001")
