"""Table sources: Parquet folders, JSON configuration, optional tables and the columns that are read of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` of a data folder, with the given columns only."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def artifact(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An intermediate table of an earlier step; a missing one is an error that names it."""
    path = f"{folder}/{name}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        raise FileNotFoundError(f"{name} is missing in {folder}: run the step that makes it first")
    return spark.read.json(path) if name.endswith(".json") else spark.read.parquet(path)


def config(spark: SparkSession, path: str, defaults: dict[str, int]) -> DataFrame:
    """One row of settings from a JSON object, each default filled in where the file has no integer."""
    read = spark.read.option("multiLine", True).json(path)
    return with_defaults(read, defaults)


def with_defaults(df: DataFrame, defaults: dict[str, int]) -> DataFrame:
    for name, value in defaults.items():
        own = F.col(name).cast("int") if name in df.columns else F.lit(None).cast("int")
        df = df.withColumn(name, F.coalesce(own, F.lit(value)))
    return df


def optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table, or an empty one of the schema where the path has none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
