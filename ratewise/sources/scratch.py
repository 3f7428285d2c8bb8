"""Intermediate results that several later jobs read.

They are written as parquet to the shared folder the cluster names in ``spark.checkpoint.dir``, which
cuts lineage and survives lost executors, and stays columnar so that each later pass reads only its
columns. Only a local master may fall back to a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_ROOTS[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, return a frame that reads the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
