"""Documents: whole text files, or a table that already holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passages.functions.text import drop_empty_lines, source_name
from passages.session import spread


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text, source)``: one row per file, empty lines removed.

    The id is a hash of the file's path, so it stays the same on every read. Spark
    passes over files of zero bytes.
    """
    files = spark.read.text(path, wholetext=True)
    location = F.col("_metadata.file_path")
    return files.select(
        F.shiftrightunsigned(F.xxhash64(location), 21).alias("doc_id"),
        drop_empty_lines("value").alias("text"),
        source_name(F.col("_metadata.file_name")).alias("source"),
    )


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """A Parquet table of texts, spread over the cores if it comes in few splits."""
    return spread(spark.read.parquet(path), key)
