"""The end-to-end flows, composed from operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.columns import extract_hour_of
from ratewise.operators import chartdata, neighbors, profile, rates, relations, sampling, trees
from ratewise.operators import evaluate as ev
from ratewise.operators.prepare import ViewParams, ViewSpec, build_view, view_metadata
from ratewise.operators.roles import classify_columns, column_pairs, has_columns
from ratewise.sources import models, tables
from ratewise.sources.scratch import stage


@dataclass
class EdaRoles:
    id: str
    target: str
    places: Sequence[str] = ()
    weather: str | None = None
    congestion: str | None = None
    hour: str | None = None
    load: str | None = None
    visibility: str | None = None
    distance: str | None = None
    minutes: str | None = None
    kind: str | None = None


def eda_report(df: DataFrame, roles: EdaRoles) -> dict[str, DataFrame]:
    """The ordered set of profiling and relation tables; parts whose columns are missing are left out. The rows are
    stored before the tables read them, so what they are made from is computed once."""
    df = stage(df, "eda-input")
    numeric, categorical, _ = classify_columns(df, [roles.id])
    features = [c for c in numeric if c != roles.target]
    y = roles.target
    out = {
        "describe_schema": profile.describe_schema(df),
        "numeric_summary": profile.numeric_summary(df, numeric),
        "null_report": profile.null_report(df),
        "duplicate_count": profile.duplicate_count(df),
        "iqr_outliers": profile.iqr_outliers(df, features),
        "zscore_outliers": profile.zscore_outliers(df, features),
        "category_proportions": profile.category_proportions(df, categorical),
    }
    if roles.visibility and has_columns(df, roles.visibility):
        out["rate_by_bin"] = rates.rate_by_bin(df, roles.visibility, y)
    for name, c in (("weather", roles.weather), ("congestion", roles.congestion)):
        if c and has_columns(df, c):
            out[f"rate_by_{name}"] = rates.rate_by_category(df, c, y)
    if roles.hour and has_columns(df, roles.hour):
        timed = df.withColumn("hour", extract_hour_of(df, roles.hour))
        out["rate_by_hour"] = rates.rate_by_hour(timed, "hour", y)
        if roles.load and has_columns(df, roles.load):
            out["hour_occupancy"] = rates.hour_occupancy_rate(timed, "hour", roles.load, y)
    if categorical:
        out["rate_by_category_all"] = rates.rate_by_category_all(df, categorical, y)
        out["bars"] = chartdata.bar_counts_pct(df, categorical)
    if roles.places and has_columns(df, *roles.places):
        out["entity_rate"] = rates.entity_rate(df, roles.places, y)
        out["busiest_places"] = rates.entity_volume_rate_topn(df, roles.places, y)
        if roles.load and has_columns(df, roles.load):
            out["mean_load_by_place"] = rates.entity_mean_topn(df, roles.places, roles.load)
        if roles.weather:
            out["rate_contribution"] = rates.rate_contribution(df, roles.places, roles.weather, y)
    if roles.distance and roles.minutes and has_columns(df, roles.distance, roles.minutes):
        out["distance_time"] = relations.row_correlation(df, roles.distance, roles.minutes)
        if roles.kind:
            out["rate_by_type"] = rates.rate_summary_by_type(df, roles.kind, roles.distance, roles.minutes)
    bins = chartdata.auto_bins_of(df, features)
    for c in features:
        out[f"histogram_{c}"] = chartdata.histogram_bins(df, c, bins[c])
    out["box_stats"] = chartdata.box_stats(df, features)
    for x, z in column_pairs(features):
        out[f"scatter_{x}_{z}"] = chartdata.scatter_grid(df, x, z)
    out["class_balance"] = rates.class_balance(df, y)
    out["correlation_matrix"] = relations.correlation_matrix(df, numeric)
    out["target_correlation"] = relations.target_correlation_ranking(df, features, y)
    return out


def eda_table(report: dict[str, DataFrame]) -> DataFrame:
    """All tables of a report as one: the part, and its rows as JSON objects of their columns."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return reduce(DataFrame.unionByName, [t.select(F.lit(name).alias("part"), row.alias("row")) for name, t in report.items()])


def publish_view(
    df: DataFrame, spec: ViewSpec, root: str, row_id: str | None = None
) -> tuple[str, ViewParams]:
    """Build, number, write and describe a view."""
    spark = df.sparkSession
    view, params = build_view(df, spec)
    view_id = tables.claim_view_id(spark, root)
    tables.write_view(view, root, view_id, spec.target, row_id=row_id)
    written = tables.load_view(spark, root, view_id)
    tables.append_metadata(view_metadata(df, written, spec, params, view_id), root)
    return view_id, params


def balanced(df: DataFrame, y: str, ids: Sequence[str], balance: bool, seed: int) -> DataFrame:
    return sampling.undersample_majority(df, y, ids, seed) if balance else df


@dataclass
class Trained:
    model: models.KnnModel | models.TreeModel
    predictions: DataFrame
    metrics: DataFrame
    search: DataFrame
    counts: dict[str, int]  # rows of the view, rows after balancing, features


def train_knn(
    view: DataFrame,
    id_column: str,
    features: Sequence[str],
    y: str,
    k_max: int = 30,
    balance: bool = False,
    seed: int = sampling.SEED,
) -> Trained:
    """Balance (optional), split, search K by cross-validation, predict the test part."""
    rows = stage(balanced(view, y, [id_column], balance, seed), "knn-rows")
    counts = {"view_rows": view.count(), "used_rows": rows.count(), "features": len(features)}
    split = sampling.stratified_split(rows, y, [id_column], seed=seed)
    train = split.filter("NOT is_test")
    folded = sampling.stratified_kfold(train, y, [id_column], seed=seed)
    vector = neighbors.vector_of(features)
    search = neighbors.knn_k_search(neighbors.points(folded, id_column, vector, y, "fold"), k_max)
    k = search.filter("best").first()["k"]
    train_points = neighbors.points(train, id_column, vector, y)
    test_points = neighbors.points(split.filter("is_test"), id_column, vector, y)
    predictions = stage(neighbors.knn_classify(train_points, test_points, k), "knn-predictions")
    metrics = ev.evaluate(predictions, "y", "pred", "score")
    return Trained(models.KnnModel(train_points, k), predictions, metrics, search, counts)


def train_tree(
    view: DataFrame,
    id_column: str,
    features: Sequence[str],
    y: str,
    balance: bool = False,
    seed: int = sampling.SEED,
    **grid_options,
) -> Trained:
    """Balance (optional), split, search the grid by cross-validation, refit the best, predict."""
    rows = stage(balanced(view, y, [id_column], balance, seed), "tree-rows")
    counts = {"view_rows": view.count(), "used_rows": rows.count(), "features": len(features)}
    split = sampling.stratified_split(rows, y, [id_column], seed=seed)
    train = split.filter("NOT is_test")
    folded = sampling.stratified_kfold(train, y, [id_column], seed=seed)
    search = trees.tree_grid_search(trees.assemble(folded, features, y, ["fold"]), **grid_options)
    params = trees.best_params(search)
    model = trees.tree_fit(trees.assemble(train, features, y), params)
    test = trees.assemble(split.filter("is_test"), features, y, [id_column])
    predictions = stage(trees.tree_predict(model, test, [id_column], params.min_split), "tree-predictions")
    metrics = ev.evaluate(predictions, "y", "pred", "score")
    return Trained(models.TreeModel(model, params), predictions, metrics, search, counts)


def publish_model(trained: Trained, spark: SparkSession, root: str, model_id: str, view_id: str) -> DataFrame:
    """Save the model, its full evaluation with the row and feature counts, and return its card. A second run
    under the same ids replaces the first."""
    if isinstance(trained.model, models.KnnModel):
        kind = "knn"
        models.save_knn(trained.model, root, model_id)
    else:
        kind = "tree"
        models.save_tree(trained.model, spark, root, model_id)
    results = ev.result_rows(trained.predictions, "y", "pred", "score", kind, model_id, view_id)
    counts = [(kind, model_id, view_id, name, float(n)) for name, n in trained.counts.items()]
    models.save_metrics(results.unionByName(spark.createDataFrame(counts, models.METRIC_SCHEMA)), root)
    stored = models.load_metrics(spark, root)
    return models.model_card(stored, models.load_params(spark, root, kind, model_id), kind, model_id)


def score_saved_model(
    model: models.KnnModel | models.TreeModel, view: DataFrame, id_column: str, features: Sequence[str], y: str
) -> DataFrame:
    """Predictions of a saved model on a view, without any training."""
    if isinstance(model, models.KnnModel):
        test = neighbors.points(view, id_column, neighbors.vector_of(features), y)
        return neighbors.knn_classify(model.train, test, model.k)
    data = trees.assemble(view, features, y, [id_column])
    return trees.tree_predict(model.model, data, [id_column], model.params.min_split)


def evaluate_saved_model(
    model: models.KnnModel | models.TreeModel,
    view: DataFrame,
    id_column: str,
    features: Sequence[str],
    y: str,
    balance: bool = False,
    seed: int = sampling.SEED,
) -> DataFrame:
    """Metrics on the rows the model has not seen: the test part and, for balanced training, all rows the
    balancing discarded."""
    if balance:
        unseen = sampling.full_evaluation_set(view, y, [id_column], seed=seed)
    else:
        unseen = sampling.stratified_split(view, y, [id_column], seed=seed).filter("is_test").drop("is_test")
    predictions = stage(score_saved_model(model, unseen, id_column, features, y), "scored")
    return ev.evaluate(predictions, "y", "pred", "score")
