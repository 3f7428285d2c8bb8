"""Evaluation of predictions. Scores come from the order lines: the discount (few distinct scores, many
ties) and the order total (almost every score distinct)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query, trips, trips_sql
from ratewise.operators import evaluate as ev
from ratewise.sources import models

_P = f"""t AS ({trips_sql("load", "visibility", "minutes", "status", "delayed")}),
    p AS (SELECT delayed AS y, load * 10 AS score, visibility / 500000 AS fine, status, CAST(load > 0.05 AS INTEGER) AS pred,
    CAST(minutes > 25 AS INTEGER) AS pred_b FROM t)"""
_CELLS = """c AS (SELECT count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) AS n FROM p)"""


def predictions(spark, sf) -> DataFrame:
    return trips(spark, sf, "load", "visibility", "minutes", "status", "delayed").select(
        F.col("delayed").alias("y"),
        (F.col("load") * 10).alias("score"),
        (F.col("visibility") / 500000).alias("fine"),
        "status",
        (F.col("load") > 0.05).cast("int").alias("pred"),
        (F.col("minutes") > 25).cast("int").alias("pred_b"),
    )


@query(
    "confusion_matrix",
    f"""WITH {_P}, {_CELLS} SELECT 0 AS actual, 0 AS predicted, tn AS "rows", round(tn * CAST(100 AS DOUBLE) / n, 4) AS pct FROM c
    UNION ALL SELECT 0, 1, fp, round(fp * CAST(100 AS DOUBLE) / n, 4) FROM c UNION ALL SELECT 1, 0, fn, round(fn * CAST(100 AS DOUBLE) / n, 4) FROM c
    UNION ALL SELECT 1, 1, tp, round(tp * CAST(100 AS DOUBLE) / n, 4) FROM c""",
)
def _confusion_matrix(spark, sf):
    return ev.confusion_matrix(predictions(spark, sf), "y", "pred")


_METRICS = "m AS (SELECT (tp + tn) / n AS accuracy, tp / (tp + fp) AS pr, tp / (tp + fn) AS re FROM c)"


@query(
    "binary_metrics",
    f"""WITH {_P}, {_CELLS}, {_METRICS} SELECT round(accuracy, 12) AS accuracy, round(pr, 12) AS "precision", round(re, 12) AS recall,
    round(2 * pr * re / (pr + re), 12) AS f1 FROM m""",
)
def _binary_metrics(spark, sf):
    return ev.binary_metrics(predictions(spark, sf), "y", "pred")


def _scores(column: str) -> str:
    return f"""s AS (SELECT {column} AS score, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM p GROUP BY 1),
    a AS (SELECT sum(p) AS tp, sum(n) AS tn FROM s),
    o AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM s WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _roc_sql(column: str) -> str:
    return f"""WITH {_P}, {_scores(column)} SELECT score AS threshold, round(CAST(cn / tn AS DOUBLE), 9) AS fpr, round(CAST(cp / tp AS DOUBLE), 9) AS tpr FROM o, a
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0"""


def _auc_sql(column: str) -> str:
    return f"""WITH {_P}, {_scores(column)} SELECT round(CAST(sum(n * ((cp - p) + p / 2)) AS DOUBLE) / CAST(max(tp) * max(tn) AS DOUBLE), 9) AS auc_roc FROM o, a"""


@query("roc_curve", _roc_sql("score"))
def _roc_curve(spark, sf):
    return ev.roc_curve(predictions(spark, sf), "y", "score")


@query("roc_curve_fine", _roc_sql("fine"))
def _roc_curve_fine(spark, sf):
    return ev.roc_curve(predictions(spark, sf), "y", "fine")


@query("auc_roc", _auc_sql("score"))
def _auc_roc(spark, sf):
    return ev.auc_roc(predictions(spark, sf), "y", "score")


@query("auc_roc_fine", _auc_sql("fine"))
def _auc_roc_fine(spark, sf):
    return ev.auc_roc(predictions(spark, sf), "y", "fine")


@query(
    "classification_report",
    f"""WITH {_P}, {_CELLS}, v AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn + fp AS n0, tp + fn AS n1 FROM c),
    f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1, (tn + tp) / n AS acc FROM v)
    SELECT 'class_0' AS line, round(p0, 12) AS "precision", round(r0, 12) AS recall, round(f0, 12) AS f1, n0 AS support FROM f
    UNION ALL SELECT 'class_1', round(p1, 12), round(r1, 12), round(f1, 12), n1 FROM f
    UNION ALL SELECT 'accuracy', round(acc, 12), round(acc, 12), round(acc, 12), n FROM f
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 12), round((r0 + r1) / 2, 12), round((f0 + f1) / 2, 12), n FROM f
    UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / n, 12), round((r0 * n0 + r1 * n1) / n, 12), round((f0 * n0 + f1 * n1) / n, 12), n FROM f""",
)
def _classification_report(spark, sf):
    return ev.classification_report(predictions(spark, sf), "y", "pred")


_EVALUATE = f"""WITH {_P}, {_CELLS}, {_METRICS}, {_scores("score")}, u AS (SELECT round(CAST(sum(n * ((cp - p) + p / 2)) AS DOUBLE) / CAST(max(tp) * max(tn) AS DOUBLE), 9) AS auc FROM o, a),
    e AS (SELECT round(accuracy, 12) AS accuracy, round(pr, 12) AS pr, round(re, 12) AS recall, round(2 * pr * re / (pr + re), 12) AS f1, auc FROM m, u) """


@query("evaluate", _EVALUATE + 'SELECT accuracy, pr AS "precision", recall, f1, auc AS auc_roc FROM e')
def _evaluate(spark, sf):
    return ev.evaluate(predictions(spark, sf), "y", "pred", "score")


@query(
    "model_conclusions",
    _EVALUATE
    + """SELECT 'accuracy' AS "rule", accuracy AS value, CASE WHEN accuracy >= 0.85 THEN 'good' WHEN accuracy >= 0.70 THEN 'acceptable' ELSE 'low' END AS level FROM e
    UNION ALL SELECT 'recall', recall, CASE WHEN recall >= 0.70 THEN 'good' WHEN recall >= 0.50 THEN 'acceptable' ELSE 'low' END FROM e
    UNION ALL SELECT 'precision', pr, CASE WHEN pr >= 0.70 THEN 'good' WHEN pr >= 0.50 THEN 'acceptable' ELSE 'low' END FROM e
    UNION ALL SELECT 'precision_recall_gap', round(pr - recall, 12), CASE WHEN pr - recall > 0.15 THEN 'conservative' WHEN pr - recall < -0.15 THEN 'aggressive' ELSE 'balanced' END FROM e
    UNION ALL SELECT 'auc_roc', auc, CASE WHEN auc >= 0.80 THEN 'good' WHEN auc >= 0.65 THEN 'acceptable' ELSE 'low' END FROM e
    UNION ALL SELECT 'advice_balance_classes', recall, CASE WHEN recall < 0.60 THEN 'yes' ELSE 'no' END FROM e
    UNION ALL SELECT 'advice_other_algorithms', accuracy, CASE WHEN accuracy < 0.75 THEN 'yes' ELSE 'no' END FROM e
    UNION ALL SELECT 'advice_fewer_features', 23, 'no' UNION ALL SELECT 'advice_validate_on_new_data', NULL, 'yes'""",
)
def _model_conclusions(spark, sf):
    return ev.model_conclusions(ev.evaluate(predictions(spark, sf), "y", "pred", "score"), n_features=23)


def _rule_metrics(spark, sf) -> DataFrame:
    """Metrics of two prediction rules on the two line states, as stored metric rows."""
    p = predictions(spark, sf)
    parts = []
    for model, pred in (("discount", "pred"), ("quantity", "pred_b")):
        for view in ("F", "O"):
            parts.append(ev.metric_rows(ev.binary_metrics(p.filter(F.col("status") == view), "y", pred), model, "001", view))
    return reduce(DataFrame.unionByName, parts)


def _rule_cells(model: str, pred: str) -> str:
    return f"""SELECT '{model}' AS model, '001' AS model_id, status AS view_id, count(*) FILTER (WHERE y = {pred}) / count(*) AS acc,
    count(*) FILTER (WHERE y = 1 AND {pred} = 1) / count(*) FILTER (WHERE {pred} = 1) AS pr,
    count(*) FILTER (WHERE y = 1 AND {pred} = 1) / count(*) FILTER (WHERE y = 1) AS re FROM p GROUP BY status"""


_RULES = f"WITH {_P}, k AS ({_rule_cells('discount', 'pred')} UNION ALL {_rule_cells('quantity', 'pred_b')}) "


@query(
    "compare_models",
    _RULES
    + """SELECT model, model_id, view_id, round(acc, 12) AS accuracy, round(pr, 12) AS "precision", round(re, 12) AS recall,
    round(2 * pr * re / (pr + re), 12) AS f1, CAST(NULL AS DOUBLE) AS auc_roc FROM k""",
)
def _compare_models(spark, sf):
    return ev.compare_models(_rule_metrics(spark, sf))


@query(
    "metric_rows",
    _RULES
    + """SELECT model, model_id, view_id, 'accuracy' AS metric, round(acc, 12) AS value FROM k UNION ALL
    SELECT model, model_id, view_id, 'precision', round(pr, 12) FROM k UNION ALL SELECT model, model_id, view_id, 'recall', round(re, 12) FROM k UNION ALL
    SELECT model, model_id, view_id, 'f1', round(2 * pr * re / (pr + re), 12) FROM k""",
)
def _metric_rows(spark, sf):
    return _rule_metrics(spark, sf)


_REPORT_LINES = [
    ("class_0", "p0", "r0", "f0", "n0"),
    ("class_1", "p1", "r1", "f1", "n1"),
    ("accuracy", "acc", "acc", "acc", "n"),
    ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
    ("weighted avg", "(p0 * n0 + p1 * n1) / n", "(r0 * n0 + r1 * n1) / n", "(f0 * n0 + f1 * n1) / n", "n"),
]


@query(
    "result_rows",
    _EVALUATE
    + """, v AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn + fp AS n0, tp + fn AS n1 FROM c),
    f AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1, (tn + tp) / n AS acc FROM v), z AS ("""
    + " UNION ALL ".join(
        [f"SELECT '{n}' AS metric, CAST({c} AS DOUBLE) AS value FROM e" for n, c in (("accuracy", "accuracy"), ("precision", "pr"), ("recall", "recall"), ("f1", "f1"), ("auc_roc", "auc"))]
        + [f"SELECT '{c}', CAST({c} AS DOUBLE) FROM c" for c in ("tn", "fp", "fn", "tp")]
        + [
            f"SELECT '{line}.{name}', round(CAST({x} AS DOUBLE), 12) FROM f"
            for line, p, r, f1, n in _REPORT_LINES
            for name, x in (("precision", p), ("recall", r), ("f1", f1), ("support", n))
        ]
    )
    + ") SELECT 'discount' AS model, '001' AS model_id, '001' AS view_id, metric, value FROM z",
)
def _result_rows(spark, sf):
    return ev.result_rows(predictions(spark, sf), "y", "pred", "score", "discount", "001", "001")


@query(
    "metrics_json",
    _RULES
    + """SELECT model, model_id, view_id, round(acc, 9) AS accuracy, round(re, 9) AS recall, true AS valid FROM k""",
)
def _metrics_json(spark, sf):
    """The JSON texts, read back."""
    texts = models.metrics_json(_rule_metrics(spark, sf))
    parsed = texts.select("model", "model_id", "view_id", F.from_json("json", "model string, metrics map<string,double>").alias("j"))
    return parsed.select(
        "model",
        "model_id",
        "view_id",
        F.round(F.col("j.metrics")["accuracy"], 9).alias("accuracy"),
        F.round(F.col("j.metrics")["recall"], 9).alias("recall"),
        (F.col("j.model") == F.col("model")).alias("valid"),
    )
