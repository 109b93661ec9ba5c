"""A training corpus from ``documents``: language ID, exact dedup, near
duplicates, source mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it back as the next
stage's docs.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece, tables

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter, or long and like no language, go."""
    tables.ready(spark)
    return language_id.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    tables.ready(spark)
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the smallest id stays."""
    tables.ready(spark)
    return jaccard_join.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document taken n times stands n times."""
    tables.ready(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, piece ids, their number, and whether they decode to the text."""
    tables.ready(spark)
    v = sentencepiece.Vocabulary.load(PIECE_MODEL)
    rows = docs.select("doc_id", "source", F.col("text").alias("_tm_text"))
    rows = rows.withColumn("ids", sentencepiece.encoder(docs, v)(F.col("_tm_text")))
    rows = rows.withColumn("_tm_back", sentencepiece.decoder(docs, v)("ids"))
    return rows.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_ids"),
                       F.col("_tm_back").eqNullSafe(F.col("_tm_text")).alias("exact"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("mixing", source_mix),
    ("sentencepiece", tokens),
]

#: The language and token stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.store(stage(spark, docs, sf_dir), name)
    return docs
