"""The document pipeline: each stage applies one operator to what its predecessor kept.

Stages take ``(spark, docs, sf_dir)`` and give a DataFrame; ``run`` writes each stage's rows as Parquet
in the shared folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import toxicity as tox
from storelens.llm.decontam import decontaminate
from storelens.llm.near_dup import one_of_each
from storelens.llm.packing import pack
from storelens.llm.pii import pseudonymise
from storelens.llm.shared import apart, column, secret_of, table, tokenizer_path, write_once


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, does not call toxic."""
    lexicon = tox.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(tox.score_column(lexicon, column("text")) < 0.5)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a share of benchmark passages that counts as contamination."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data under pseudonyms; ``n_chars`` follows the text where that changed."""
    found = apart(docs, "__found")
    made = pseudonymise(docs, secret_of(spark), found_column=found)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col(found) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return made.drop(found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [("toxicity", civil), ("near_dup", distinct), ("decontam", unseen), ("pii", private), ("packing", packed)]

# SQL can't express the trained and iterative stages; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage packs out of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
