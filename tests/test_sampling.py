import pytest
from pyspark.sql import functions as F

from ratewise.operators import sampling


def labelled(spark, n, positives, partitions=4):
    return spark.range(n).select("id", (F.col("id") < positives).cast("int").alias("y")).repartition(partitions)


@pytest.mark.parametrize("n,positives,test", [(15000, 4778, 4500), (14438, 4607, 4332)])
def test_split_sizes(spark, n, positives, test):
    split = sampling.stratified_split(labelled(spark, n, positives), "y", ["id"])
    counts = {r["y"]: r["n"] for r in split.filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == test
    assert abs(counts[1] - 0.3 * positives) <= 1 and split.count() == n


def test_balanced_sizes(spark):
    rows = labelled(spark, 14438, 4607)
    marked = sampling.mark_undersample(rows, "y", ["id"])
    kept, left = marked.filter("selected"), marked.filter("NOT selected")
    assert kept.count() == 9214 and left.count() == 5224 and left.filter("y = 1").count() == 0
    assert sampling.stratified_split(kept, "y", ["id"]).filter("is_test").count() == 2765
    whole = sampling.full_evaluation_set(rows, "y", ["id"])
    assert whole.count() == 7989 and whole.select("id").distinct().count() == 7989
    assert sampling.set_difference(rows, kept, ["id"]).count() == 5224


def test_choice_does_not_depend_on_partitions(spark):
    a = sampling.stratified_split(labelled(spark, 3000, 900, 1), "y", ["id"])
    b = sampling.stratified_split(labelled(spark, 3000, 900, 7), "y", ["id"])
    assert a.exceptAll(b).count() == 0
    other = sampling.stratified_split(labelled(spark, 3000, 900), "y", ["id"], seed=1)
    assert a.filter("is_test").join(other.filter("is_test"), "id").count() < 500


def test_folds(spark):
    folded = sampling.stratified_kfold(labelled(spark, 1003, 317), "y", ["id"])
    sizes = {(r["y"], r["fold"]): r["n"] for r in folded.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
    assert len(sizes) == 10
    for y, n in ((0, 686), (1, 317)):
        per = [sizes[y, f] for f in range(5)]
        assert sum(per) == n and max(per) - min(per) <= 1


def test_tiny_classes(spark):
    folded = sampling.stratified_kfold(labelled(spark, 9, 2), "y", ["id"])
    assert folded.count() == 9 and folded.filter("fold BETWEEN 0 AND 4").count() == 9
    assert sampling.undersample_majority(labelled(spark, 9, 2), "y", ["id"]).count() == 4


def test_quota_rounding():
    assert sampling.split_quotas({0: 10222, 1: 4778}, 0.3) == {0: 3067, 1: 1433}
    assert sum(sampling.split_quotas({0: 5, 1: 5, 2: 5}, 0.3).values()) == 5


def test_null_class_is_refused(spark):
    rows = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "id long, y int")
    with pytest.raises(ValueError):
        sampling.stratified_split(rows, "y", ["id"])


def test_repeated_ids_at_a_cut_are_refused(spark):
    rows = spark.range(70).select(F.lit(1).alias("id"), (F.col("id") < 10).cast("int").alias("y"))
    with pytest.raises(ValueError, match="unique"):
        sampling.undersample_majority(rows, "y", ["id"])


def test_repeated_ids_away_from_the_cut_are_exact(spark):
    rows = labelled(spark, 60, 10).unionByName(labelled(spark, 60, 10).filter("y = 1"))
    kept = sampling.undersample_majority(rows, "y", ["id"])
    assert {r["y"]: r["count"] for r in kept.groupBy("y").count().collect()} == {0: 20, 1: 20}


def test_evaluation_set_is_the_test_part_of_the_balanced_rows_and_the_discarded(spark):
    rows = labelled(spark, 2000, 700)
    marked = sampling.mark_undersample(rows, "y", ["id"])
    test = sampling.stratified_split(marked.filter("selected"), "y", ["id"]).filter("is_test")
    want = {r["id"] for r in test.collect()} | {r["id"] for r in marked.filter("NOT selected").collect()}
    assert {r["id"] for r in sampling.full_evaluation_set(rows, "y", ["id"]).collect()} == want


def test_input_is_scanned_once_by_a_choice(spark):
    """The choice itself reads the input once; reading the result is the caller's second scan."""
    scans = spark.sparkContext.accumulator(0)

    def counting(batches):
        scans.add(1)
        yield from batches

    rows = labelled(spark, 900, 300, 1).coalesce(1)
    seen = rows.mapInPandas(counting, "id long, y int")
    for choose in (sampling.stratified_split, sampling.stratified_kfold, sampling.undersample_majority, sampling.undersample_discarded, sampling.full_evaluation_set):
        before = scans.value
        out = choose(seen, "y", ["id"])
        assert scans.value - before == 1, choose.__name__
        assert out.count() > 0
