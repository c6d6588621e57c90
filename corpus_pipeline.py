"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; its
result is written as Parquet in the shared folder and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passages.llm.common import small, store
from passages.llm.decontaminate import SHIPPED_ROWS, drop_contaminated
from passages.llm.jaccard import similar_sets
from passages.llm.packing import pack_documents
from passages.llm.quality import keep_good, train_quality
from passages.llm.queries import table, tokenizer_path
from passages.llm.secrets import redact_secrets


# Words that a packing worker remembers: its memory still holds what other stages used.
PACKING_WORDS = 400_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """One of the rows that repeat an id with the same text, the first by its other columns.

    Only ids are counted for all rows; texts are moved only where an id is repeated, and
    the table is then stored, so that its rows keep their order for the next steps.
    """
    counts = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count()
    repeated = small(
        store(counts.where("count > 1").select("doc_id"), "repeated-ids"), SHIPPED_ROWS
    )
    if repeated.isEmpty():
        return docs
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = (
        docs.join(repeated, "doc_id", "left_semi")
        .groupBy("doc_id", "text")
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select("doc_id", "text", "_row.*")
    )
    kept = docs.join(repeated, "doc_id", "left_anti").unionByName(one).select(docs.columns)
    return store(kept, "without-repeats")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id stays.

    Documents without words, or without an id, are in no group. Of rows that repeat an id
    with the same text one stays.
    """
    docs = without_repeats(docs)
    groups = similar_sets(docs)
    gone = store(groups.where("component_id < doc_id").select("doc_id"), "near-duplicates")
    return docs.join(small(gone, SHIPPED_ROWS), "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of up to 4096 tokens."""
    return pack_documents(docs, tokenizer_path(), remembered=PACKING_WORDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Fitted tables and token ids are beyond SQL; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
