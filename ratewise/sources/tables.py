"""Base tables, numbered views with their metadata, and small result tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.operators.roles import target_last

# The 15 columns of the flight table.
FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("id_vuelo", T.LongType()),
        T.StructField("aeropuerto_origen", T.StringType()),
        T.StructField("aeropuerto_destino", T.StringType()),
        T.StructField("hora_salida_programada", T.StringType()),
        T.StructField("dia_semana", T.StringType()),
        T.StructField("distancia_vuelo", T.DoubleType()),
        T.StructField("ocupacion_vuelo", T.DoubleType()),
        T.StructField("puerta_embarque", T.IntegerType()),
        T.StructField("visibilidad", T.DoubleType()),
        T.StructField("tiempo_estimado_vuelo", T.DoubleType()),
        T.StructField("condiciones_climaticas", T.StringType()),
        T.StructField("congestion_aerea", T.StringType()),
        T.StructField("tipo_avion", T.StringType()),
        T.StructField("temporada_alta", T.BooleanType()),
        T.StructField("demora", T.IntegerType()),
    ]
)

METADATA_SCHEMA = "view_id string, item string, name string, position int, text string, number double"


def load_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Parquet (default) or csv with header. CSV needs a schema: inferring one would scan the data twice."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("csv needs an explicit schema")
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).select("rows", F.lit(len(df.columns)).cast("long").alias("columns"))


def view_path(root: str, view_id: str) -> str:
    return f"{root.rstrip('/')}/views/view_id={view_id}"


def metadata_path(root: str) -> str:
    return f"{root.rstrip('/')}/metadata"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def view_registry(spark: SparkSession, root: str) -> DataFrame:
    """view_id, rows, features of every written view, in order."""
    if not _exists(spark, metadata_path(root)):
        return spark.createDataFrame([], "view_id string, rows long, features long")
    meta = spark.read.schema(METADATA_SCHEMA).parquet(metadata_path(root))
    return (
        meta.filter(F.col("item") == "size")
        .groupBy("view_id")
        .agg(
            F.max(F.when(F.col("name") == "rows", F.col("number"))).cast("long").alias("rows"),
            F.max(F.when(F.col("name") == "features", F.col("number"))).cast("long").alias("features"),
        )
        .orderBy("view_id")
    )


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers_in(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    fs, p = _file_system(spark, folder)
    names = [str(f.getPath().getName()) for f in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit()]


def next_view_id(spark: SparkSession, root: str) -> str:
    """Last number + 1, at least three digits; '001' for the first view. Described views, folders a run left
    behind and claimed numbers all count."""
    described = view_registry(spark, root).agg(F.max(F.col("view_id").cast("int"))).first()[0] or 0
    base = root.rstrip("/")
    taken = [described, *_numbers_in(spark, f"{base}/views", "view_id="), *_numbers_in(spark, f"{base}/claims")]
    return f"{max(taken) + 1:03d}"


def claim_view_id(spark: SparkSession, root: str, attempts: int = 100) -> str:
    """The next number, claimed by creating an empty file that may not exist yet: two runs never share one."""
    for _ in range(attempts):
        view_id = next_view_id(spark, root)
        fs, p = _file_system(spark, f"{root.rstrip('/')}/claims/{view_id}")
        try:
            fs.create(p, False).close()
            return view_id
        except Py4JJavaError:
            if not fs.exists(p):  # not a race for the number
                raise
    raise RuntimeError(f"no view number could be claimed in {attempts} attempts")


def write_view(
    view: DataFrame, root: str, view_id: str, target: str, fmt: str = "parquet", row_id: str | None = None
) -> str:
    """Write a view with the target as its last column. Views carry no id; ``row_id`` adds a unique number
    that is fixed by being written, so later splits of the stored view are reproducible."""
    path = view_path(root, view_id)
    if row_id:
        view = view.select(F.monotonically_increasing_id().alias(row_id), "*")
    out = target_last(view, target).write
    (out.option("header", True).csv(path) if fmt == "csv" else out.parquet(path))
    return path


def load_view(
    spark: SparkSession, root: str, view_id: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    return load_table(spark, view_path(root, view_id), fmt, schema)


def append_metadata(metadata: DataFrame, root: str) -> None:
    metadata.coalesce(1).write.mode("append").parquet(metadata_path(root))


def load_metadata(spark: SparkSession, root: str, view_id: str) -> DataFrame:
    return (
        spark.read.schema(METADATA_SCHEMA)
        .parquet(metadata_path(root))
        .filter(F.col("view_id") == view_id)
        .orderBy("item", "position", "name")
    )


def write_summary(small: DataFrame, path: str) -> str:
    """One csv file with header. For aggregated tables only: it goes through a single task."""
    small.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
