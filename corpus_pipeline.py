"""A pipeline over a table of documents: language, exact copies, near copies, secrets, packing.

Each stage takes all rows that the one before has kept, as a table read again. All but the last return the columns of
documents; the last returns the pieces of the packed documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silofeed.llm import exact_dedup, language_id, packing, secret_scan, simhash
from silofeed.llm.tables import passing, scratch, stored
from silofeed.workspace import remove_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; those without letters, or in no language of the labels, go."""
    model = language_id.fit(docs)
    return language_id.drop_unknown(docs, model, declared=F.col("lang"), host=F.col("source"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id.

    Near copies share at least 0.8 of their five-word shingles, or have fingerprints within three bits.
    """
    return simhash.drop_near_duplicates(docs, similarity=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to the names of their kinds; ``n_chars`` follows the text."""
    return secret_scan.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
    ("secret_scan", secrets), ("packing", packed),
]

#: Fitted models, fingerprints and vocabularies are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with scratch():
            if before:  # goes, with the stage's own tables, once the next one is there
                passing(spark, before)
            docs, before = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    try:
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:  # by now the texts are tables of ids
        remove_folder(spark, before)
