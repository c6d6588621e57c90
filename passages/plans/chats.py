"""Conversations to the token ids a model would be given at each turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.functions.text import fit_context
from passages.operators.chat import chat_history, format_chat_turn
from passages.operators.points import point_chunk, point_doc, point_id
from passages.operators.tokens import encode_corpus


def chat_context(
    turns: DataFrame,
    vocab: DataFrame,
    max_length: int,
    sample_length: int,
    mode: str = "chat",
) -> DataFrame:
    """``(conv_id, turn, ids)`` of the user turns of ``(conv_id, turn, role, text, model)``.

    A user turn is formatted for its model and encoded; in ``chat`` mode it follows all
    earlier prompts and answers of its conversation. The tail that leaves room for
    ``sample_length`` new tokens is kept. Turns of other roles than user and assistant
    take no part.
    """
    users = format_chat_turn(turns.where(F.col("role") == "user"), mode)
    said = users.select("conv_id", "turn", "role", F.col("prompt").alias("text"))
    if mode == "chat":
        answers = turns.where(F.col("role") == "assistant")
        said = said.unionByName(answers.select("conv_id", "turn", "role", "text"))
    keyed = said.select(
        F.struct(point_id("conv_id", "turn").alias("at"), "role").alias("key"), "text"
    )
    coded = encode_corpus(keyed, vocab, key="key").select(
        point_doc("key.at").alias("conv_id"), point_chunk("key.at").alias("turn"),
        F.col("key.role").alias("role"), "ids",
    )
    if mode == "chat":
        budget = max_length - 10 - max(sample_length - 1, 0)
        coded = chat_history(coded, budget).withColumn("ids", F.col("history"))
    ids = fit_context("ids", max_length, sample_length).alias("ids")
    return coded.where(F.col("role") == "user").select("conv_id", "turn", ids)
