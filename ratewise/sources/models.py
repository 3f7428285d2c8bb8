"""Saved models, stored metrics and model cards."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.trees import Tree, TreeParams, read_tree, write_tree

METRIC_SCHEMA = "model string, model_id string, view_id string, metric string, value double"
PARAM_SCHEMA = "name string, value string"


def model_dir(root: str, kind: str, model_id: str) -> str:
    return f"{root.rstrip('/')}/models/{kind}/{model_id}"


def _write_params(spark: SparkSession, path: str, params: dict) -> None:
    rows = [(k, None if v is None else str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, PARAM_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, root: str, kind: str, model_id: str) -> DataFrame:
    return spark.read.schema(PARAM_SCHEMA).parquet(f"{model_dir(root, kind, model_id)}/params")


def _params(spark: SparkSession, root: str, kind: str, model_id: str) -> dict[str, str | None]:
    return {r["name"]: r["value"] for r in load_params(spark, root, kind, model_id).collect()}


@dataclass
class KnnModel:
    """A nearest-neighbour model is its training points and K."""

    train: DataFrame
    k: int


@dataclass
class TreeModel:
    model: Tree
    params: TreeParams


def save_knn(m: KnnModel, root: str, model_id: str) -> str:
    path = model_dir(root, "knn", model_id)
    m.train.write.mode("overwrite").parquet(f"{path}/train")
    _write_params(m.train.sparkSession, f"{path}/params", {"k": m.k})
    return path


def load_knn(spark: SparkSession, root: str, model_id: str) -> KnnModel:
    train = spark.read.parquet(f"{model_dir(root, 'knn', model_id)}/train")
    return KnnModel(train, int(_params(spark, root, "knn", model_id)["k"]))


def save_tree(m: TreeModel, spark: SparkSession, root: str, model_id: str) -> str:
    path = model_dir(root, "tree", model_id)
    write_tree(m.model, f"{path}/tree")
    _write_params(spark, f"{path}/params", asdict(m.params))
    return path


def load_tree(spark: SparkSession, root: str, model_id: str) -> TreeModel:
    p = _params(spark, root, "tree", model_id)
    params = TreeParams(
        p["criterion"], None if p["max_depth"] is None else int(p["max_depth"]), int(p["min_leaf"]), int(p["min_split"])
    )
    return TreeModel(read_tree(spark, f"{model_dir(root, 'tree', model_id)}/tree"), params)


def save_metrics(rows: DataFrame, root: str) -> None:
    """Store metric rows (see ``metric_rows``) under their model and view; a second evaluation of the same
    model on the same view replaces the first. A handful of rows each, so one file."""
    kept = rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    kept.partitionBy("model", "model_id", "view_id").parquet(f"{root.rstrip('/')}/metrics")


def load_metrics(spark: SparkSession, root: str) -> DataFrame:
    stored = spark.read.schema(METRIC_SCHEMA).parquet(f"{root.rstrip('/')}/metrics")
    return stored.select("model", "model_id", "view_id", "metric", "value")


def metrics_json(metric_table: DataFrame) -> DataFrame:
    """One JSON text per (model, model_id, view_id)."""
    entry = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))  # one evaluation
    return metric_table.groupBy("model", "model_id", "view_id").agg(entry.alias("metrics")).select(
        "model", "model_id", "view_id", F.to_json(F.struct("model", "model_id", "view_id", "metrics")).alias("json")
    )


def model_card(metric_table: DataFrame, params: DataFrame, kind: str, model_id: str) -> DataFrame:
    """View, hyper-parameters and the five metrics of one model as (item, name, text)."""
    own = metric_table.filter((F.col("model") == kind) & (F.col("model_id") == model_id))
    view = own.select(F.lit("view").alias("item"), F.lit("view_id").alias("name"), F.col("view_id").alias("text")).distinct()
    setting = params.select(F.lit("parameter").alias("item"), "name", F.coalesce("value", F.lit("none")).alias("text"))
    metric = own.select(
        F.lit("metric").alias("item"), F.col("metric").alias("name"), F.format_string("%.4f", "value").alias("text")
    )
    return view.unionByName(setting).unionByName(metric)
