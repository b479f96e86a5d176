"""The corpus pipeline: language, quality, near duplicates, mixing and encoding, each stage on all that the last kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafloom.llm import common, jaccard, langid, mix, pieces, quality

#: A document stays if this share of its words, at least, is expected to be in its main language.
LANGUAGE_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and a main language; ``lang`` becomes the predicted one.

    Rows with a null or letter-free text go. The model learns from the rows with a lang; without any, no language is
    known and all rows go. Repeated rows stay repeated; an empty table stays empty.
    """
    found = langid.identify(docs, docs).where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SHARE))
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier than not to be good and clean by a model of ``labels``.

    Without labels all documents stay. Repeated rows stay repeated; an empty table stays empty.
    """
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    return quality.grade(docs, model).where(F.col("p_clean") >= quality.SELECT_AT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, a similarity of 0.8 or more.

    Texts without words link with nothing and stay; rows with a null doc_id stay; an empty table stays empty.
    """
    return jaccard.keep_one(docs, n=5, num=4, den=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix of the sources: a row for each document and pass, with the words that the pass takes.

    Texts without words are never taken and go; a null source is one of its own; an empty table stays empty.
    """
    return mix.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens under merge-dropout. A null text has null tokens; an empty table stays empty."""
    return pieces.encoded(docs).select("doc_id", "lang", "source", "n_tokens", "tokens", "round_trip")


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("mix", mixed), ("pieces", encoded)]

#: No SQL: the stages hold trained models and hashed draws. They are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again by the next.

    A stage's folder goes when the next stage's is written; that of the last but one stays for the result's readers.
    """
    folder = f"{common.shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            common.remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
