import json

import numpy as np
import pytest

from ratewise.operators import evaluate as ev
from ratewise.sources import models
from ratewise.sources.scratch import stage

CELLS = "tn long, fp long, fn long, tp long"

# Published matrices (tn, fp, fn, tp) with accuracy, precision, recall, F1.
PUBLISHED = [
    ((2981, 86, 1309, 124), (0.69, 0.5904761904761905, 0.08653175157013258, 0.1509433962264151)),
    ((4400, 2207, 651, 731), (0.6422581048942295, 0.24880871341048333, 0.5289435600578871, 0.3384259259259259)),
    ((792, 591, 471, 911), (0.6159132007233273, 0.6065246338215713, 0.6591895803183792, 0.6317614424410541)),
    ((4996, 1611, 707, 675), (0.7098510451871323, 0.2952755905511811, 0.48842257597684513, 0.3680479825517993)),
    ((2727, 223, 1077, 305), (0.6999076638965835, 0.5776515151515151, 0.22069464544138928, 0.3193717277486911)),
    ((2872, 78, 1297, 85), (0.6825946445060018, 0.5214723926380368, 0.06150506512301013, 0.11003236245954692)),
]


def from_cells(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "y int, pred int")


@pytest.mark.parametrize("cells,want", PUBLISHED)
def test_published_metrics(spark, cells, want):
    got = ev.metrics_from_cells(spark.createDataFrame([cells], CELLS), digits=16).first()
    assert tuple(got) == pytest.approx(want, abs=1e-12)
    rows = stage(from_cells(spark, *cells), "cells")
    assert tuple(ev.binary_metrics(rows, "y", "pred", digits=16).first()) == pytest.approx(want, abs=1e-12)
    matrix = {(r["actual"], r["predicted"]): r["rows"] for r in ev.confusion_matrix(rows, "y", "pred").collect()}
    assert matrix == {(0, 0): cells[0], (0, 1): cells[1], (1, 0): cells[2], (1, 1): cells[3]}


def test_published_report(spark):
    cells = spark.createDataFrame([PUBLISHED[0][0]], CELLS)
    report = {r["line"]: r for r in ev.report_from_cells(cells, digits=16).collect()}
    zero = report["class_0"]
    assert zero["precision"] == pytest.approx(0.6948717948717948) and zero["recall"] == pytest.approx(0.9719595696119987)
    assert zero["support"] == 3067
    assert report["macro avg"]["f1"] == pytest.approx(0.4806640319449324)
    assert report["weighted avg"]["f1"] == pytest.approx(0.6003892583369452)


def test_zero_division_gives_zero(spark):
    r = ev.binary_metrics(from_cells(spark, 5, 0, 3, 0), "y", "pred").first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    empty = ev.confusion_matrix(from_cells(spark, 5, 0, 0, 0), "y", "pred").collect()
    assert sorted(c["rows"] for c in empty) == [0, 0, 0, 5]


@pytest.mark.parametrize("ties", [True, False])
def test_auc_and_roc_equal_pair_counting(spark, ties):
    rng = np.random.default_rng(5)
    y = (rng.random(300) < 0.3).astype(int)
    s = rng.random(300) + 0.2 * y
    s = s.round(1) if ties else s
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double").repartition(4)
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert ev.auc_roc(df, "y", "score").first()[0] == pytest.approx(want, abs=1e-9)
    curve = ev.roc_curve(df, "y", "score").collect()
    for r in curve:
        assert r["tpr"] == pytest.approx(np.mean(pos >= r["threshold"]), abs=1e-9)
        assert r["fpr"] == pytest.approx(np.mean(neg >= r["threshold"]), abs=1e-9)
    assert len(curve) == len(np.unique(s)) + 1


@pytest.mark.parametrize(
    "metrics,features,levels",
    [
        ((0.9, 0.8, 0.75, 0.77, 0.85), 10, {"accuracy": "good", "recall": "good", "precision_recall_gap": "balanced", "auc_roc": "good", "advice_balance_classes": "no", "advice_fewer_features": "no"}),
        ((0.7, 0.6, 0.3, 0.4, 0.65), 31, {"accuracy": "acceptable", "recall": "low", "precision": "acceptable", "precision_recall_gap": "conservative", "auc_roc": "acceptable", "advice_fewer_features": "yes"}),
        ((0.6, 0.3, 0.6, 0.4, 0.5), 31, {"accuracy": "low", "precision": "low", "precision_recall_gap": "aggressive", "auc_roc": "low", "advice_other_algorithms": "yes"}),
    ],
)
def test_conclusions(spark, metrics, features, levels):
    row = spark.createDataFrame([metrics], "accuracy double, precision double, recall double, f1 double, auc_roc double")
    got = {r["rule"]: r["level"] for r in ev.model_conclusions(row, features).collect()}
    for rule, level in levels.items():
        assert got[rule] == level
    assert got["advice_validate_on_new_data"] == "yes"


def test_metric_store_and_cards(spark, tmp_path):
    root = str(tmp_path)
    row = spark.createDataFrame([(0.7, 0.5, 0.2, 0.3, 0.6)], "accuracy double, precision double, recall double, f1 double, auc_roc double")
    for kind, view in (("knn", "001"), ("tree", "001"), ("tree", "002")):
        models.save_metrics(ev.metric_rows(row, kind, "001", view), root)
    stored = models.load_metrics(spark, root)
    wide = ev.compare_models(stored).collect()
    assert [(r["model"], r["view_id"]) for r in wide] == [("knn", "001"), ("tree", "001"), ("tree", "002")]
    assert wide[0]["f1"] == 0.3
    text = models.metrics_json(stored).filter("model = 'knn'").first()["json"]
    assert json.loads(text)["metrics"]["accuracy"] == 0.7
    params = spark.createDataFrame([("k", "29")], models.PARAM_SCHEMA)
    card = {r["name"]: r["text"] for r in models.model_card(stored, params, "knn", "001").collect()}
    assert card["k"] == "29" and card["auc_roc"] == "0.6000" and card["view_id"] == "001"
