"""Evaluation of predictions: tables with an outcome ``y``, a prediction ``pred`` and a score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.quantiles import cumulative_counts
from ratewise.operators.reshape import rows_of
from ratewise.sources.scratch import stage


def _cells(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    a, p = F.col(y), F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if((a == 0) & (p == 0)).alias("tn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """All four cells, absent ones as 0, with their share of the total."""
    whole = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cell = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    return _cells(df, y, pred, by).select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"),
                        F.lit(p).alias("predicted"),
                        F.col(c).alias("rows"),
                        F.round(F.try_divide(F.col(c) * 100.0, whole), 4).alias("pct"),
                    )
                    for c, a, p in cell
                ]
            )
        ),
    )


def _share(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _f1(p, r):
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def metrics_from_cells(cells: DataFrame, by: Sequence[str] = (), digits: int = 12) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    return cells.select(
        *by,
        F.round(_share(tp + tn, tn + fp + fn + tp), digits).alias("accuracy"),
        F.round(precision, digits).alias("precision"),
        F.round(recall, digits).alias("recall"),
        F.round(_f1(precision, recall), digits).alias("f1"),
    )


def binary_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = (), digits: int = 12) -> DataFrame:
    """accuracy, precision, recall, F1 of class 1; a zero denominator gives 0."""
    return metrics_from_cells(_cells(df, y, pred, by), by, digits)


def score_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: ties, however many rows share one, become one row."""
    return (
        df.filter(F.col(y).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )


def _scored(df: DataFrame, y: str, score: str) -> DataFrame:
    table = stage(score_table(df, y, score), "scores")
    ranked = cumulative_counts(table.withColumn("down", -F.col("score")), "down", ["pos", "neg"])
    totals = table.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")).first()
    return ranked.withColumns({"all_pos": F.lit(totals["all_pos"]), "all_neg": F.lit(totals["all_neg"])})


def roc_curve(df: DataFrame, y: str, score: str, digits: int = 9) -> DataFrame:
    """One point per distinct score used as threshold, plus the origin (threshold infinity)."""
    s = _scored(df, y, score)
    points = s.select(
        F.col("score").alias("threshold"),
        F.round(F.try_divide((F.col("before_neg") + F.col("neg")).cast("double"), F.col("all_neg")), digits).alias("fpr"),
        F.round(F.try_divide((F.col("before_pos") + F.col("pos")).cast("double"), F.col("all_pos")), digits).alias("tpr"),
    )
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(origin)


def auc_roc(df: DataFrame, y: str, score: str, digits: int = 9) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half."""
    s = _scored(df, y, score)
    wins = F.sum(F.col("neg").cast("double") * (F.col("before_pos") + F.col("pos") / 2.0))
    return s.agg(
        F.round(F.try_divide(wins, F.max("all_pos").cast("double") * F.max("all_neg")), digits).alias("auc_roc")
    )


def classification_report(df: DataFrame, y: str, pred: str, digits: int = 12) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    return report_from_cells(_cells(df, y, pred), digits)


def report_from_cells(cells: DataFrame, digits: int = 12) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p0, r0, p1, r1 = _share(tn, tn + fn), _share(tn, tn + fp), _share(tp, tp + fp), _share(tp, tp + fn)
    f0, f1 = _f1(p0, r0), _f1(p1, r1)
    n0, n1 = (tn + fp).cast("double"), (tp + fn).cast("double")
    total = n0 + n1
    accuracy = _share(tn + tp, tn + fp + fn + tp)

    def weighted(a, b):
        return _share(a * n0 + b * n1, total)

    lines = [
        ("class_0", p0, r0, f0, n0),
        ("class_1", p1, r1, f1, n1),
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        ("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    ]
    return rows_of(
        cells,
        [
            F.struct(
                F.lit(name).alias("line"),
                F.round(p, digits).alias("precision"),
                F.round(r, digits).alias("recall"),
                F.round(f, digits).alias("f1"),
                n.cast("long").alias("support"),
            )
            for name, p, r, f, n in lines
        ],
    )


def evaluate(df: DataFrame, y: str, pred: str, score: str) -> DataFrame:
    """The five headline metrics in one row; both parts are one-row frames joined on a constant."""
    metrics = binary_metrics(df, y, pred).withColumn("_one", F.lit(1))
    auc = auc_roc(df, y, score).withColumn("_one", F.lit(1))
    return metrics.join(auc, "_one").drop("_one")


def metric_rows(metrics: DataFrame, model: str, model_id: str, view_id: str) -> DataFrame:
    """One row per metric, the form in which results are stored and compared."""
    names = metrics.columns
    return metrics.select(*[F.col(c).cast("double").alias(c) for c in names]).select(
        F.lit(model).alias("model"),
        F.lit(model_id).alias("model_id"),
        F.lit(view_id).alias("view_id"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])),
    )


def result_rows(
    df: DataFrame, y: str, pred: str, score: str, model: str, model_id: str, view_id: str
) -> DataFrame:
    """The full stored result of one evaluation as metric rows: headline metrics, the four cells of the
    confusion matrix, and every figure of the classification report as ``line.figure``."""
    cells = stage(_cells(df, y, pred), "cells")
    lines = report_from_cells(cells)
    figures = lines.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.concat_ws(".", "line", F.lit(c)).alias("metric"), F.col(c).cast("double").alias("value"))
                    for c in ("precision", "recall", "f1", "support")
                ]
            )
        )
    ).select(F.lit(model).alias("model"), F.lit(model_id).alias("model_id"), F.lit(view_id).alias("view_id"), "metric", "value")
    parts = [
        metric_rows(metrics_from_cells(cells), model, model_id, view_id),
        metric_rows(auc_roc(df, y, score), model, model_id, view_id),
        metric_rows(cells, model, model_id, view_id),
        figures,
    ]
    return reduce(DataFrame.unionByName, parts)


METRIC_ORDER = ("accuracy", "precision", "recall", "f1", "auc_roc")


def compare_models(metric_table: DataFrame, metrics: Sequence[str] = METRIC_ORDER) -> DataFrame:
    """Metrics side by side, one row per (model, model_id, view_id)."""
    return (
        metric_table.groupBy("model", "model_id", "view_id")
        .pivot("metric", list(metrics))
        .agg(F.first("value"))
        .orderBy("model", "model_id", "view_id")
    )


def model_conclusions(metrics: DataFrame, n_features: int, advice: bool = True) -> DataFrame:
    """Threshold rules over a one-row metrics frame: (rule, value, level), with or without advice rows."""
    acc, pre, rec, auc = (F.col(c) for c in ("accuracy", "precision", "recall", "auc_roc"))
    gap = pre - rec

    def graded(c, good, fair):
        return F.when(c >= good, "good").when(c >= fair, "acceptable").otherwise("low")

    hints = [
        ("advice_balance_classes", rec, rec < 0.60),
        ("advice_other_algorithms", acc, acc < 0.75),
        ("advice_fewer_features", F.lit(float(n_features)), F.lit(n_features > 30)),
        ("advice_validate_on_new_data", F.lit(None).cast("double"), F.lit(True)),
    ]
    rules = [
        ("accuracy", acc, graded(acc, 0.85, 0.70)),
        ("recall", rec, graded(rec, 0.70, 0.50)),
        ("precision", pre, graded(pre, 0.70, 0.50)),
        (
            "precision_recall_gap",
            F.round(gap, 12),
            F.when(gap > 0.15, "conservative").when(gap < -0.15, "aggressive").otherwise("balanced"),
        ),
        ("auc_roc", auc, graded(auc, 0.80, 0.65)),
    ]
    if advice:
        rules += [(name, value, F.when(on, "yes").otherwise("no")) for name, value, on in hints]
    return rows_of(
        metrics,
        [
            F.struct(F.lit(name).alias("rule"), value.cast("double").alias("value"), level.alias("level"))
            for name, value, level in rules
        ],
    )
