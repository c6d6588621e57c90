"""JSON-lines exchange with a chat service, and the history of both directions.

The call itself belongs to the service's client: requests are a sink, responses a
source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_requests(df: DataFrame, path: str, body: str = "body") -> None:
    """One request body per line."""
    df.select(F.col(body).alias("value")).write.mode("overwrite").text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """``(body)``: one response per line, parsed later by ``chat_response``."""
    return spark.read.text(path).select(F.col("value").alias("body"))


def append_history(df: DataFrame, path: str) -> None:
    """Append rows of request and response to the history folder."""
    df.write.mode("append").json(path)


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
