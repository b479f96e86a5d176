"""Sinks: JSON, text and Markdown files, replaced folders, bundles, published folders with a manifest, run summaries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """A table as JSON lines with nulls kept, replacing the folder."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, path: str, column: str, by: list[str] | None = None) -> None:
    """One text per row with trailing space cut, in folders by the given columns."""
    out = df.select(*(by or []), F.regexp_replace(column, r"\s+$", "").alias("value"))
    (out.write.partitionBy(*by) if by else out.write).mode("overwrite").text(path)


def write_bundle(folder: str, artifacts: dict[str, DataFrame]) -> list[str]:
    """Each artifact in a folder of its own: ``.json`` names as JSON, others as text of their first column."""
    for name, df in artifacts.items():
        (write_json(df, f"{folder}/{name}") if name.endswith(".json") else write_text(df, f"{folder}/{name}", df.columns[0]))
    return [f"{folder}/{name}" for name in artifacts]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, relative path, bytes, modified) of the files under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("name"), F.substring_index("path", path.rstrip("/") + "/", -1).alias("relative_path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))


def _paths(spark: SparkSession):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, conf, lambda p: jvm.org.apache.hadoop.fs.Path(p)


def publish(spark: SparkSession, source: str, target: str, names: list[str], folders: tuple[str, ...] = ()) -> DataFrame:
    """Copies the named files or folders byte by byte and returns the target's manifest; fails listing all that are missing.

    ``folders``, such as images, replace those of the target: files that are no longer in the source go. A folder that
    the source does not have is left out.
    """
    jvm, conf, path = _paths(spark)
    fs = lambda p: path(p).getFileSystem(conf)
    missing = [n for n in names if not fs(f"{source}/{n}").exists(path(f"{source}/{n}"))]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    fs(target).mkdirs(path(target))
    for n in [*names, *(f for f in folders if fs(f"{source}/{f}").exists(path(f"{source}/{f}")))]:
        a, b = f"{source}/{n}", f"{target}/{n}"
        fs(b).delete(path(b), True)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs(a), path(a), fs(b), path(b), False, True, conf)
    return manifest(spark, target)


def write_files(df: DataFrame, folder: str, path: str = "path", content: str = "content") -> int:
    """Each row's text or bytes as a file of its own under a folder that all tasks reach; the number of files.

    Texts end with one line break. Names are relative; of rows with one name the last written stays. Null contents are empty.
    """

    def run(frames):
        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for f in frames:
            for name, data in zip(f["path"], f["content"], strict=True):
                to = f"{root}/{name}"
                store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(to) as out:
                    out.write(data if isinstance(data, bytes) else ((data or "").rstrip() + "\n").encode())
            yield pd.DataFrame({"n": [len(f)]})

    written = df.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "n long")
    return written.agg(F.sum("n")).first()[0] or 0


def replaced(spark: SparkSession, folder: str) -> str:
    """An empty folder in place of whatever was there."""
    _, conf, path = _paths(spark)
    fs = path(folder).getFileSystem(conf)
    fs.delete(path(folder), True)
    fs.mkdirs(path(folder))
    return folder


def summary(label: str, **counts) -> str:
    """A run's summary as one JSON line."""
    return json.dumps({"run": label} | counts, ensure_ascii=False)


def observed(df: DataFrame, label: str, **measures) -> tuple[DataFrame, Observation]:
    """``df`` with measures that are taken while it is written, such as a count, and where they are found afterwards."""
    seen = Observation(label)
    return df.observe(seen, *(m.alias(k) for k, m in measures.items())), seen


def required(df: DataFrame, test: Column, message: str) -> DataFrame:
    """``df``, of which every row must meet a test: the job fails with the message at one that does not, or is null."""
    return df.where(F.when(F.coalesce(test, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
