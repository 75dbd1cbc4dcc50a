"""A corpus pipeline over the table of documents; each stage is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from barweave.llm.common import fresh, stay, table
from barweave.storage import hand_over


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, lets through."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit(docs, labels)
    score = fresh(docs, "_score")
    scored = docs.withColumn(score, toxicity.score_column(docs, model))
    return scored.where(F.col(score) < toxicity.LEVEL).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    groups = exact_dedup.exact_groups(docs)
    kept = groups.where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")
    )
    return stay(docs, kept, "doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the least id."""
    groups = near_dedup.near_groups(docs)
    kept = groups.where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")
    )
    return stay(docs, kept, "doc_id", "text")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = fresh(docs, "_found")
    leaks = decontaminate.matches_column(docs, table(spark, sf_dir, "benchmark"))
    return docs.withColumn(found, leaks).where(F.size(found) == 0).drop(found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 2048 tokens."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("toxicity", keep_civil),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("pack", pack),
]

#: SQL cannot express the model of the first stage; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = hand_over(stage(spark, docs, sf_dir), name)
    return docs
