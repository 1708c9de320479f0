"""The corpus pipeline: stages that each work on all documents that the one before has kept.

Every stage takes (spark, docs, sf_dir) with the columns of ``documents`` and returns them, but for the last, which returns the
packed pieces. ``run`` writes each stage's result to the shared scratch folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestar.llm import decontaminate, near_dedup, packing, pii, toxicity
from lakestar.llm.common import held_out, staged
from lakestar.llm.queries import TOKENIZER, table

# Documents at or above this score are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; learned from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1)).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.keep_below(docs, labels, TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    redacted = pii.redact_documents(docs)
    return redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# The stages learn, decode and search; SQL has no words for that. tests/llm/test_operators.py tests them and the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
