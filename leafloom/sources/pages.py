"""A page source: paged files, in any store that Spark reads, become one row per page.

What turns a file into pages is a plug-in: the default splits text at form feeds; a PDF extractor that yields the text
of each page takes its place where one is installed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Extractor = Callable[[bytes], Iterator[str]]


def form_feeds(data: bytes) -> Iterator[str]:
    """Pages of plain text."""
    yield from data.decode("utf-8", "replace").replace("\0", " ").split("\f")


def paged(spark: SparkSession, path: str, files: str = "*.txt", extract: Extractor = form_feeds) -> DataFrame:
    """(doc_id, page_number, text) of the files under ``path`` that match a pattern; a task has whole files.

    A missing path fails when the source is opened. Pages are numbered from 1; their text is trimmed.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).option("recursiveFileLookup", "true").load(path)
    named = found.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "content")

    def run(frames):
        for f in frames:
            rows = [(d, n, t.strip()) for d, c in zip(f["doc_id"], f["content"], strict=True) for n, t in enumerate(extract(bytes(c)), 1)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_number", "text"]).astype({"page_number": "int32"})

    return named.mapInPandas(run, "doc_id string, page_number int, text string")
