"""From documents to token ids: quality, near duplicates, repeated passages, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm import chunks, decontam, nbest, resample, simhash
from weatherloom.llm.common import written

SHINGLE_WORDS = 4
MAX_BITS = 4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the resampling towards labelled good text keeps.

    Null, empty and blank texts go; repeated rows stay or go together; no rows give no rows.
    """
    return resample.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Texts without words are copies of each other; of repeated rows one stays; no rows give no rows.
    """
    return simhash.first_of_each_group(docs, radius=MAX_BITS, words_per_shingle=SHINGLE_WORDS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the passages that stand in an earlier one; n_chars follows the text.

    Null and empty texts stay as they are; rows repeated with id and text keep the same text; no rows give no rows.
    """
    left = chunks.deduplicated(docs)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return left.select(*(n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay, as do all rows repeated; without items all stay.
    """
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its best segmentations.

    A null text is encoded as an empty one; repeated rows are encoded each; no rows give no rows.
    """
    return nbest.encoded(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece encoding", tokens),
]

#: SQL has no trained classifier; tests hold the operators of the first four stages against brute force or SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes its rows to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
