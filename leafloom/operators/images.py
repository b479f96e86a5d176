"""Page images: which pages and pictures count, and the interface of what decodes and draws them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a decoder yields of a file: (page, number, width, height, box, encoding, bytes).
Picture = tuple[int, int, int, int, list[float], str, bytes]
Decoder = Callable[[bytes], Iterator[Picture]]
#: What a drawer makes of a file, a page from 1 and a target width: the page as a picture.
Drawer = Callable[[bytes, int, int], bytes]


def decorative(chars: Column, images: Column, most_chars: int = 40, least_images: int = 2) -> Column:
    """Whether a page is decoration: little text and several images. Nulls count as none."""
    return (F.coalesce(chars, F.lit(0)) <= most_chars) & (F.coalesce(images, F.lit(0)) >= least_images)


def skipped(pages: DataFrame, key: str, contents: DataFrame, covers: tuple[int, ...], decoration: Column) -> DataFrame:
    """``pages`` with ``decorative`` and ``skipped``: contents pages, covers and decoration are passed over."""
    marked = contents.select(key).distinct().withColumn("_contents", F.lit(True))
    out = pages.withColumn("decorative", decoration).join(marked, key, "left")
    return out.withColumn("skipped", F.col("decorative") | F.col(key).isin(*covers) | F.coalesce("_contents", F.lit(False))).drop("_contents")


def too_small(width: Column, height: Column, least: int = 20) -> Column:
    """Whether a picture is too small in either dimension."""
    return (width < least) | (height < least)


def decoded(spark: SparkSession, path: str, decode: Decoder, files: str = "*.pdf") -> DataFrame:
    """(doc_id, page, number, width, height, box, encoding, content) of the pictures in files; a task has whole files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).option("recursiveFileLookup", "true").load(path)
    named = found.select(F.element_at(F.split("path", "/"), -1).alias("doc_id"), "content")
    columns = ["doc_id", "page", "number", "width", "height", "box", "encoding", "content"]

    def run(frames):
        for f in frames:
            for doc, content in zip(f["doc_id"], f["content"], strict=True):
                yield pd.DataFrame([(doc, *p) for p in decode(bytes(content))], columns=columns)

    return named.mapInPandas(run, "doc_id string, page int, number int, width int, height int, box array<double>, encoding string, content binary")


def drawn(files: DataFrame, pages: DataFrame, draw: Drawer, width: int = 900) -> DataFrame:
    """(doc_id, path, content): a picture of each page of ``pages`` (doc_id, page), from files (doc_id, content)."""

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "path": [f"{p:04d}.jpg" for p in f["page"]], "content": [draw(bytes(c), int(p), width) for c, p in zip(f["content"], f["page"], strict=True)]})

    return files.select("doc_id", "content").join(pages.select("doc_id", "page"), "doc_id").mapInPandas(run, "doc_id string, path string, content binary")
