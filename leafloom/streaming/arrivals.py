"""Pages that arrive as a stream: the inventory row by row, and running counts by kind with late pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafloom.functions import text


def arriving(spark: SparkSession, path: str, schema: StructType | str, files_at_once: int = 100) -> DataFrame:
    """A stream of Parquet files of pages as they land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def inventory(pages: DataFrame, content: str = "text") -> DataFrame:
    """Label, kind, size and first lines of each page; the same expressions for streams and tables."""
    top = text.first_lines(F.col(content))
    label = text.first_label(top)
    kind = F.when(label.isNull(), "unlabeled").when(label.rlike(r"^\d+$"), "body").otherwise("frontmatter")
    return pages.withColumns({"page_label": label, "page_kind": kind, "char_count": F.length(content).cast("long"), "top_lines": top})


def counts(pages: DataFrame, at: str, late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Pages per kind and time window; pages later than ``late`` are not waited for."""
    return inventory(pages).withWatermark(at, late).groupBy(F.window(at, window).alias("window"), "page_kind").agg(F.count("*").alias("pages"))
