"""Chat turns: prompt formats per model, whole prompts, and cut histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passages.functions.text import strip_line_end, whole_div
from passages.operators.ordered import concat_ordered, running_total

# The model names of each prompt family; all other names are plain.
OPEN_CHAT_MODELS = ("7b-open-chat-3.5", "7b-starling-a")
ZEPHYR_MODELS = ("7b-zephyr-a", "7b-zephyr-b")
MISTRAL_MODELS = (
    "7b-mistral", "7b-mistral-instruct", "7b-mistral-instruct-v0.2", "mixtral", "mixtral-instruct",
)
PLAIN_MODELS = (
    "7b", "13b", "70b", "7b-chat", "13b-chat", "70b-chat", "7b-code", "13b-code", "32b-code",
    "7b-leo", "13b-leo",
)
GEMMA_MODELS = (
    "2b", "7b", "2b-it", "7b-it", "1.1-2b-it", "1.1-7b-it", "code-2b", "code-7b", "code-2b-it",
    "code-7b-it",
)


def prompt_family(model: Column | str) -> Column:
    """Family of a model name. ``7b`` is plain, unless it is written ``gemma-7b``."""
    model = F.col(model) if isinstance(model, str) else model
    gemma = [name for name in GEMMA_MODELS if name not in PLAIN_MODELS]
    return (
        F.when(model.isin(*OPEN_CHAT_MODELS), "open-chat")
        .when(model.isin(*ZEPHYR_MODELS), "zephyr")
        .when(model.isin(*MISTRAL_MODELS), "mistral")
        .when(model.isin(*gemma, *[f"gemma-{name}" for name in GEMMA_MODELS]), "gemma")
        .otherwise("plain")
    )


def eos_token(family: Column | str) -> Column:
    """End token of a family: ``gemma`` and ``open-chat`` have their own."""
    family = F.col(family) if isinstance(family, str) else family
    return (
        F.when(family == "open-chat", "<|end_of_turn|>")
        .when(family == "gemma", "<eos>")
        .otherwise("</s>")
    )


def chat_turn(prompt: Column | str, family: Column | str, is_first: Column) -> Column:
    """Prompt text of one turn; ``is_first`` adds the system part of zephyr models."""
    text = strip_line_end(prompt)
    family = F.col(family) if isinstance(family, str) else family
    zephyr = F.concat(F.lit("<|user|>\n"), text, F.lit("</s>\n<|assistant|>"))
    return (
        F.when(
            family == "open-chat",
            F.concat(
                F.lit("GPT4 Correct User: "), text,
                F.lit("<|end_of_turn|>GPT4 Correct Assistant:"),
            ),
        )
        .when(
            family == "zephyr",
            F.when(is_first, F.concat(F.lit("<|system|>\n</s>\n"), zephyr)).otherwise(zephyr),
        )
        .when(family == "mistral", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .otherwise(text)
    )


def format_chat_turn(
    df: DataFrame,
    mode: str = "chat",
    conv: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    model: str = "model",
) -> DataFrame:
    """Add ``prompt`` to user turns, formatted for the family of ``model``.

    ``mode`` is ``chat`` (the first turn of a conversation differs), ``interactive``
    (every turn counts as first) or ``one`` (prompts are passed as they are). The
    first turn is found by a minimum and joined on ``(conv, turn)``, which no single
    conversation can skew.
    """
    if mode == "one":
        return df.withColumn("prompt", F.col(text))
    family = prompt_family(model)
    if mode == "interactive":
        return df.withColumn("prompt", chat_turn(text, family, F.lit(True)))
    if mode != "chat":
        raise ValueError("mode must be chat, interactive or one")
    first = df.groupBy(conv).agg(F.min(turn).alias(turn)).withColumn("_first", F.lit(True))
    is_first = F.coalesce("_first", F.lit(False))
    return (
        df.join(first, [conv, turn], "left")
        .withColumn("prompt", chat_turn(text, family, is_first))
        .drop("_first")
    )


def chat_messages(
    df: DataFrame,
    pattern: str,
    generation_marker: str = "",
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv, prompt)``: all turns of a conversation as one prompt.

    ``pattern`` gives one turn with ``{role}`` and ``{content}``; ``generation_marker``
    ends the prompt.
    """
    head, found, tail = pattern.partition("{content}")
    if not found:
        raise ValueError("the pattern needs {content}")
    shaped = F.concat(
        F.replace(F.lit(head), F.lit("{role}"), F.col(role)),
        F.col(text),
        F.replace(F.lit(tail), F.lit("{role}"), F.col(role)),
    )
    turns = df.select(conv, turn, shaped.alias("_turn"))
    return concat_ordered(turns, conv, turn, "_turn", "prompt").withColumn(
        "prompt", F.concat("prompt", F.lit(generation_marker))
    )


def chat_history(
    df: DataFrame,
    budget: int,
    conv: str = "conv_id",
    turn: str = "turn",
    ids: str = "ids",
    segment_tokens: int = 65_536,
) -> DataFrame:
    """Add ``history``: the last ``budget`` token ids of the turns up to each turn.

    Keeping the last ids after every turn is the same as keeping them once from the
    whole past, so no turn waits for the one before. A turn reaches back ``budget``
    tokens: token offsets cut a conversation into segments, the end of a segment is
    copied into the next one, and a range window runs inside each.
    """
    if budget < 1:
        raise ValueError("the budget must be positive")
    segment = max(segment_tokens, budget)
    size = F.coalesce(F.size(ids), F.lit(0))
    # A turn is used for its last tokens only, so it carries no more than those.
    tail = F.slice(
        ids, size - F.least(size, F.lit(budget)) + 1, F.least(size, F.lit(budget))
    )
    turns = running_total(df, conv, turn, size.cast("long"), "_end").withColumn("_tail", tail)
    home = whole_div(F.col("_end"), segment)
    copied = whole_div(F.col("_end") + (budget - 1), segment)
    placed = turns.withColumn("_home", home).withColumn(
        "_seg", F.explode(F.sequence(home, copied))
    )
    reach = (
        Window.partitionBy(conv, "_seg").orderBy("_end").rangeBetween(1 - budget, Window.currentRow)
    )
    joined = F.flatten(F.collect_list("_tail").over(reach))
    count = F.least(F.size("_joined"), F.lit(budget))
    return (
        placed.withColumn("_joined", joined)
        .where(F.col("_seg") == F.col("_home"))
        .withColumn("history", F.slice("_joined", F.size("_joined") - count + 1, count))
        .drop("_end", "_tail", "_home", "_seg", "_joined")
    )
