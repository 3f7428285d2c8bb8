import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.operators import neighbors, sampling, trees
from ratewise.plans import flows
from ratewise.sources import models


def cloud(spark, n, d, seed, first=0, copies=0, decimals=None):
    """n points in a few clumps; ``copies`` of them are one and the same vector."""
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 1, (n, d)) + 6 * rng.integers(0, 3, (n, 1))
    if decimals is not None:
        v = v.round(decimals)
    if copies:
        v[:copies] = v[0]
    y = (rng.random(n) < 0.4).astype(int)
    g = rng.integers(0, 4, n)
    rows = [(first + i, [float(x) for x in v[i]], int(y[i]), int(g[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, vec array<double>, y int, fold int").repartition(5), v, y, g


def brute(tv, ty, tid, qv, k, allowed=None):
    out = {}
    for i, q in enumerate(qv):
        d = np.sqrt(((tv - q) ** 2).sum(1))
        pool = [j for j in range(len(tv)) if allowed is None or allowed(i, j)]
        out[i] = [tid[j] for j in sorted(pool, key=lambda j: (d[j], tid[j]))[:k]]
    return out


@pytest.mark.parametrize("copies,decimals", [(0, None), (300, None), (0, 0)])
def test_neighbors_equal_brute_force(spark, copies, decimals):
    """Several cells, small blocks, a third of the train rows equal, and many tied distances."""
    train, tv, ty, _ = cloud(spark, 900, 3, 1, copies=copies, decimals=decimals)
    test, qv, _, _ = cloud(spark, 120, 3, 2, first=5000, decimals=decimals)
    found = neighbors.knn_neighbors(
        neighbors.points(train, "id", "vec", "y"),
        neighbors.points(test, "id", "vec", "y"),
        7,
        block_rows=64,
        cell_rows=50,
    )
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"] - 5000, []).append(r["neighbor"])
    assert got == brute(tv, ty, list(range(900)), qv, 7)


def test_k_search_equals_brute_force(spark):
    df, v, y, g = cloud(spark, 600, 2, 3)
    got = neighbors.knn_k_search(neighbors.points(df, "id", "vec", "y", "fold"), 9, block_rows=100, cell_rows=100).toPandas()
    near = brute(v, y, list(range(600)), v, 9, allowed=lambda i, j: g[i] != g[j])
    best = None
    for k in range(1, 10):
        pred = np.array([int(2 * sum(y[j] for j in near[i][:k]) > k) for i in range(600)])
        acc = [np.mean(pred[g == f] == y[g == f]) for f in range(4)]
        row = got[got.k == k].iloc[0]
        assert row.accuracy_mean == pytest.approx(np.mean(acc), abs=1e-8)
        assert row.accuracy_std == pytest.approx(np.std(acc), abs=1e-8)
        if best is None or round(np.mean(acc), 9) > best[1]:
            best = (k, round(np.mean(acc), 9))
    assert got[got.best].k.tolist() == [best[0]]


def test_k_beyond_the_reachable_rows_is_refused(spark):
    df, _, _, _ = cloud(spark, 10, 2, 4)
    with pytest.raises(ValueError, match="k_max"):
        neighbors.knn_k_search(neighbors.points(df, "id", "vec", "y", "fold"), 9)


def test_every_row_a_group_of_its_own(spark):
    df = spark.range(1500).selectExpr("id", "array(double(id)) AS v", "0 AS y")
    p = neighbors.points(df, "id", "v", "y", "id")
    got = neighbors.knn_neighbors(p, p, 2, cell_rows=40).orderBy("id", "rank").collect()
    near = lambda i: sorted((j for j in range(max(0, i - 3), min(1500, i + 4)) if j != i), key=lambda j: (abs(i - j), j))[:2]
    assert [r["neighbor"] for r in got] == [j for i in range(1500) for j in near(i)]


def test_text_ids(spark):
    train, tv, ty, _ = cloud(spark, 300, 3, 6, decimals=0)
    test, qv, _, _ = cloud(spark, 40, 3, 7, first=5000, decimals=0)
    named = train.withColumn("id", F.concat(F.lit("id-"), "id"))
    found = neighbors.knn_neighbors(neighbors.points(named, "id", "vec", "y"), neighbors.points(test, "id", "vec", "y"), 5, block_rows=50, cell_rows=30)
    names = [f"id-{i}" for i in range(300)]
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"] - 5000, []).append(r["neighbor"])
    assert got == brute(tv, ty, names, qv, 5)
    asked = neighbors.points(test.withColumn("id", F.concat(F.lit("q"), "id")), "id", "vec", "y")
    assert neighbors.knn_classify(neighbors.points(named, "id", "vec", "y"), asked, 3).filter("id like 'q50%'").count() == 40


def test_clumped_vectors_are_compared_with_few_others(spark, monkeypatch):
    """64 components, 40 clumps: under a fifth of the pairs are visited, and the result is that of all pairs."""
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 1, (40, 64))
    frame = lambda n, first: (lambda v: (v, spark.createDataFrame([(first + i, [float(x) for x in r], i % 2) for i, r in enumerate(v)], "id long, v array<double>, y int").repartition(3)))(centres[rng.integers(0, 40, n)] + rng.normal(0, 0.05, (n, 64)))
    (tv, train), (qv, test) = frame(2000, 0), frame(150, 9000)
    stored = {}
    keep = neighbors.stage
    monkeypatch.setattr(neighbors, "stage", lambda df, label: stored.setdefault(label, []).append(keep(df, label)) or stored[label][-1])
    found = neighbors.knn_neighbors(neighbors.points(train, "id", "v", "y"), neighbors.points(test, "id", "v", "y"), 5, cell_rows=40)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"] - 9000, []).append(r["neighbor"])
    assert got == brute(tv, None, list(range(2000)), qv, 5)
    sizes = {r["cell"]: r["count"] for r in stored["knn-train"][0].groupBy("cell").count().collect()}
    pairs = sum(sizes[r["cell"]] * r["count"] for visits in stored["knn-visits"] for r in visits.groupBy("cell").count().collect())
    assert pairs < 0.2 * 2000 * 150


def test_single_rows_are_ruled_out_by_their_leading_components():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(20, 30)), rng.normal(size=(400, 30))
    b[:40, :3] += 40
    axes = neighbors._principal(b)
    lead = lambda v: axes.lead(v)
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    assert (neighbors._distances(lead(a), lead(b)) <= d + 1e-9).all()
    kth = np.sort(d, axis=1)[:, 6]
    for bound in (np.full(20, np.inf), kth):
        rows, cols, dist = neighbors.closest_pairs(a, b, np.arange(400), None, bound, 7, lead(a), lead(b))
        assert cols.reshape(20, 7).tolist() == [sorted(range(400), key=lambda j: (d[i, j], j))[:7] for i in range(20)]


def test_neighbors_of_empty_tables(spark):
    some, _, _, _ = cloud(spark, 20, 2, 1)
    p = neighbors.points(some, "id", "vec", "y")
    assert neighbors.knn_neighbors(p.limit(0), p, 3).count() == 0 and neighbors.knn_neighbors(p, p.limit(0), 3).count() == 0


def test_vote_ties_are_class_zero(spark):
    train = spark.createDataFrame([(0, [0.0], 1), (1, [1.0], 0)], "id long, v array<double>, y int")
    test = spark.createDataFrame([(9, [0.5], 1)], "id long, v array<double>, y int")
    r = neighbors.knn_classify(neighbors.points(train, "id", "v", "y"), neighbors.points(test, "id", "v", "y"), 2).first()
    assert (r["pred"], r["score"]) == (0, 0.5)


def tree_rows(spark, n=800):
    df = spark.range(n).select(
        "id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.round(F.rand(3) * 4).alias("c")
    )
    noisy = (F.col("a") * 2 + F.col("b") + F.rand(4) * 0.8 > 1.9).cast("int").alias("y")
    return df.select("*", noisy)


def predictions(model, data, **options):
    return [(r["pred"], r["score"]) for r in trees.tree_predict(model, data, ["id"], **options).orderBy("id").collect()]


def brute_tree(x, y, criterion, leaf, split, depth):
    """Where each row ends, by trying every value of every feature in every node: (share of positives, predicted)."""
    out = {}

    def impurity(n, p):
        if criterion == "gini":
            return 1 - (p / n) ** 2 - (1 - p / n) ** 2
        return -sum(s * np.log2(s) for s in (p / n, 1 - p / n) if s > 0)

    def grow(rows, fit, level):
        n, p = len(fit), int(y[fit].sum())
        best = None
        if 0 < p < n and n >= split and (depth is None or level < depth):
            for f in range(x.shape[1]):
                for t in np.unique(x[fit, f])[:-1]:
                    left = fit[x[fit, f] <= t]
                    m, q = len(left), int(y[left].sum())
                    if m >= leaf and n - m >= leaf:
                        gain = round(impurity(n, p) - (m / n * impurity(m, q) + (n - m) / n * impurity(n - m, p - q)), 12)
                        if best is None or gain > best[0]:
                            best = (gain, f, t)
        if best is None:
            out.update({int(i): (int(p / n > 0.5), p / n) for i in rows})
            return
        goes = lambda r: x[r, best[1]] <= best[2]
        grow(rows[goes(rows)], fit[goes(fit)], level + 1)
        grow(rows[~goes(rows)], fit[~goes(fit)], level + 1)

    return grow, out


def test_trees_equal_brute_force_and_cut_trees_equal_direct_fits(spark, tmp_path):
    tree_rows(spark, 150).withColumn("a", F.round("a", 2)).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows").repartition(3)
    data = trees.assemble(rows, ["a", "b", "c"], "y", ["id"])
    table = np.array(rows.orderBy("id").select("a", "b", "c", "y").collect(), dtype=float)
    x, y, everyone = table[:, :3], table[:, 3].astype(int), np.arange(len(table))
    for criterion, leaf in (("gini", 1), ("entropy", 3)):
        whole = trees.tree_fit(data, trees.TreeParams(criterion, None, leaf))
        for depth, split in ((None, 2), (3, 2), (None, 40)):
            grow, want = brute_tree(x, y, criterion, leaf, split, depth)
            grow(everyone, everyone, 0)
            cut = trees.Tree(whole.levels if depth is None else whole.levels[: depth + 1])
            assert predictions(cut, data, min_split=split) == [want[i] for i in everyone]
    direct = trees.tree_fit(data, trees.TreeParams("entropy", 3, 3, 20))
    assert predictions(direct, data) == predictions(trees.Tree(whole.levels[:4]), data, min_split=20)


def test_grid_search_equals_brute_force(spark, tmp_path):
    sampling.stratified_kfold(tree_rows(spark, 120), "y", ["id"], folds=3).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    data = trees.assemble(rows, ["a", "b", "c"], "y", ["id", "fold"])
    grid = trees.tree_grid_search(data, depths=(2, None), leaf_minimums=(1, 5), split_minimums=(2, 40))
    got = grid.toPandas()
    table = np.array(rows.orderBy("id").select("a", "b", "c", "y", "fold").collect(), dtype=float)
    x, y, fold = table[:, :3], table[:, 3].astype(int), table[:, 4]
    assert len(got) == 16 and got["best"].sum() == 1
    for r in got.itertuples():
        accuracy = []
        for f in range(3):
            grow, want = brute_tree(x, y, r.criterion, r.min_leaf, r.min_split, None if np.isnan(r.max_depth) else r.max_depth)
            grow(np.flatnonzero(fold == f), np.flatnonzero(fold != f), 0)
            accuracy.append(np.mean([want[i][0] == y[i] for i in np.flatnonzero(fold == f)]))
        assert r.accuracy_mean == pytest.approx(np.mean(accuracy), abs=1e-8) and r.accuracy_std == pytest.approx(np.std(accuracy), abs=1e-8)
    top = got["accuracy_mean"].max()
    assert got[got["best"]].position.iloc[0] == got[got["accuracy_mean"] == top].position.min()
    assert trees.best_params(grid).criterion in trees.CRITERIA


def test_trees_are_not_limited_in_depth(spark):
    """Classes alternate along the only feature, so that each split parts one row from the rest."""
    rows = spark.range(33).selectExpr("id", "double(id) AS a", "int(id % 2) AS y")
    data = trees.assemble(rows, ["a"], "y", ["id"])
    model = trees.tree_fit(data, trees.TreeParams())
    assert len(model.levels) > 30
    assert [p for p, _ in predictions(model, data)] == [i % 2 for i in range(33)]


def test_thresholds_are_all_values_or_spaced_ranks(spark):
    rng = np.random.default_rng(0)
    x = np.stack([rng.normal(size=900), rng.integers(0, 5, 900).astype(float), np.full(900, 2.0)], axis=1)
    data = spark.createDataFrame([([float(v) for v in r],) for r in x], "features array<double>").repartition(4)
    a, b, c = trees.thresholds(data, 3, max_bins=16)
    assert a.tolist() == [np.sort(x[:, 0])[i * 899 // 16] for i in range(1, 16)]
    assert b.tolist() == [0.0, 1.0, 2.0, 3.0, 4.0] and c.tolist() == [2.0]


def test_trees_of_awkward_tables(spark):
    none = spark.createDataFrame([], "id long, a double, y int")
    with pytest.raises(ValueError, match="rows"):
        trees.tree_fit(trees.assemble(none, ["a"], "y"), trees.TreeParams())
    one = spark.createDataFrame([(i, 1.0, 1) for i in range(5)], "id long, a double, y int")
    data = trees.assemble(one, ["a"], "y", ["id"])
    assert predictions(trees.tree_fit(data, trees.TreeParams()), data) == [(1, 1.0)] * 5
    tied = spark.createDataFrame([(i, 1.0, i % 2) for i in range(4)], "id long, a double, y int")
    data = trees.assemble(tied, ["a"], "y", ["id"])
    model = trees.tree_fit(data, trees.TreeParams())
    assert predictions(model, data) == [(0, 0.5)] * 4
    assert trees.tree_predict(model, trees.assemble(none, ["a"], "y", ["id"]), ["id"]).count() == 0
    bad = spark.createDataFrame([(1, float("nan"), 1), (2, 1.0, 0)], "id long, a double, y int")
    with pytest.raises(Exception, match="missing values"):
        trees.tree_fit(trees.assemble(bad, ["a"], "y"), trees.TreeParams())


def test_saved_models_score_without_training(spark, tmp_path):
    root = str(tmp_path)
    tree_rows(spark, 400).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    features = ["a", "b", "c"]
    knn = flows.train_knn(rows, "id", features, "y", k_max=5)
    flows.publish_model(knn, spark, root, "001", "007")
    card = {r["name"]: r["text"] for r in flows.publish_model(knn, spark, root, "001", "007").collect()}
    assert card["view_id"] == "007" and card["k"] == str(knn.model.k)
    assert (card["view_rows"], card["used_rows"], card["features"]) == ("400.0000", "400.0000", "3.0000")
    loaded = models.load_knn(spark, root, "001")
    again = flows.evaluate_saved_model(loaded, rows, "id", features, "y")
    assert loaded.k == knn.model.k and again.exceptAll(knn.metrics).count() == 0
    small = {"depths": (2, 4), "leaf_minimums": (1,), "split_minimums": (2, 30)}
    tree = flows.train_tree(rows, "id", features, "y", balance=True, **small)
    models.save_tree(tree.model, spark, root, "001")
    kept = models.load_tree(spark, root, "001")
    assert kept.params == tree.model.params
    a = flows.score_saved_model(kept, rows, "id", features, "y")
    b = flows.score_saved_model(tree.model, rows, "id", features, "y")
    assert a.exceptAll(b).count() == 0
    unseen = flows.evaluate_saved_model(kept, rows, "id", features, "y", balance=True).first()
    assert 0.0 <= unseen["auc_roc"] <= 1.0


def test_small_regions_are_finished_without_a_round_of_jobs_per_level(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 300, (500, 3))
    rows = spark.createDataFrame([(i, *map(float, r), int(rng.random() < 0.5), i % 3) for i, r in enumerate(x)], "id int, a double, b double, c double, y int, fold int")
    data = trees.assemble(rows, ["a", "b", "c"], "y", ["fold"])
    growths = [trees.Growth(f, c, leaf) for f in range(-1, 3) for c in trees.CRITERIA for leaf in (1, 5)]
    stages, keep = [], trees.stage
    monkeypatch.setattr(trees, "stage", lambda df, label: stages.append(label) or keep(df, label))
    columns = ["tree", "level", "above", "rows", "positives", "held", "held_positives", "feature", "bin"]

    def nodes():
        found = trees.grow(data, growths, max_bins=64)[0].withColumn("leaf", F.col("left").isNull())
        return sorted((tuple(-1 if v is None else v for v in r) for r in found.select(*columns, "leaf").collect()))

    alone = nodes()
    assert max(r[1] for r in alone) > 8 and len(stages) < 12
    monkeypatch.setattr(trees, "LOCAL_ROWS", 60)
    assert nodes() == alone


def test_a_query_row_is_sent_to_few_slabs_whatever_the_number_of_cells(spark, monkeypatch):
    rng = np.random.default_rng(9)
    frame = lambda n, first: (lambda v: (v, spark.createDataFrame([(first + i, [float(x) for x in r], i % 2) for i, r in enumerate(v)], "id long, v array<double>, y int").repartition(3)))(rng.normal(0, 1, (n, 12)))
    (tv, train), (qv, test) = frame(2500, 0), frame(60, 9000)
    sent, keep = [], neighbors._route
    monkeypatch.setattr(neighbors, "_route", lambda *a, **b: sent.append(keep(*a, **b)) or sent[-1])
    found = neighbors.knn_neighbors(neighbors.points(train, "id", "v", "y"), neighbors.points(test, "id", "v", "y"), 5, cell_rows=50)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"] - 9000, []).append(r["neighbor"])
    assert got == brute(tv, None, list(range(2500)), qv, 5)
    assert sum(s.count() for s in sent) <= 3 * 60  # once a round, though there are 50 cells


def test_even_vectors_are_sent_twice_and_in_single_precision_where_that_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(10)
    v = rng.normal(0, 1, (2500, 12)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, [float(x) for x in r], i % 2, i % 40) for i, r in enumerate(v)], "id long, v array<double>, y int, f int").repartition(3)
    sent, keep = [], neighbors._route
    monkeypatch.setattr(neighbors, "_route", lambda *a, **b: sent.append(keep(*a, **b)) or sent[-1])
    asked = neighbors.points(df.filter("f = 0"), "id", "v", "y")
    assert neighbors.knn_neighbors(neighbors.points(df, "id", "v", "y"), asked, 5, cell_rows=50).count() == 5 * asked.count()
    rows = [r for s in sent for r in s.select("v").collect()]
    assert len(rows) <= 2 * asked.count()  # the nearest cell, then all others, though there are 50 cells
    assert {len(r["v"]) for r in rows} == {12 * 4}


def test_vectors_as_bytes_lose_nothing():
    v = np.array([[0.5, -0.0, 3.0], [0.1, 1e300, 2.0], [np.inf, 1e-320, np.nan]])
    packed = neighbors._to_bytes(v)
    assert [len(p) for p in packed] == [12, 24, 24]
    assert neighbors._from_bytes(pd.Series(packed), 3).tobytes() == v.tobytes()
