"""Retrieved text to chat request, and chat response to answer text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the request: prompt texts, model and sampling settings.
SYSTEM_TEXT = (
    "You are a highly advanced assistant. You receive a prompt from a user and relevant "
    "excerpts extracted from a text document. You then answer truthfully to the best of "
    "your ability. If you do not know the answer, your response is I don't know."
)
CONTEXT_TEXT = (
    "Based on the retrieved information from the document, here are the relevant "
    "excerpts:{{payload}}Please provide a comprehensive answer to the user's question, "
    "integrating insights from these excerpts and your general knowledge."
)
PLACEHOLDER = "{{payload}}"
CHAT_MODEL = "mixtral-8x7b-32768"
TEMPERATURE = 0.8
MAX_TOKENS = 4000
TOP_P = 1
# What a server sends after the last chunk of a streamed answer.
END_MARK = "[DONE]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def context_text(
    queries: DataFrame,
    hits: DataFrame,
    query_id: str = "query_id",
    text: str = "text",
    rank: str = "rank",
) -> DataFrame:
    """``queries`` with ``context``: texts of the hits in rank order, joined by newlines.

    A group holds the ``k`` hits of one query; a hit without text is left out. A query
    without hits gets ``''``.
    """
    ordered = F.sort_array(F.collect_list(F.struct(rank, text)))
    joined = hits.groupBy(query_id).agg(
        F.array_join(F.transform(ordered, lambda r: r[text]), "\n").alias("context")
    )
    return queries.join(joined, query_id, "left").withColumn(
        "context", F.coalesce("context", F.lit(""))
    )


def fill_template(
    template: Column | str, context: Column | str, placeholder: str = PLACEHOLDER,
    legacy: bool = False,
) -> Column:
    """Put ``context`` in place of the placeholder; NULL when there is none.

    ``legacy`` cuts twelve characters from the first ``{{p`` on, whatever the length
    of the placeholder.
    """
    template, context = _col(template), _col(context)
    if not legacy:
        at = F.instr(template, F.lit(placeholder))
        width = len(placeholder)
    else:
        at = F.instr(template, F.lit("{{p"))
        width = 12
    rest = F.substring(template, at + width, F.char_length(template))
    return F.when(at > 0, F.concat(F.substring(template, F.lit(1), at - 1), context, rest))


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), _col(content).alias("content"))


def rag_messages(question: Column | str, context: Column | str, legacy: bool = False) -> Column:
    """System text, the user's question, and the context text with its excerpts."""
    filled = fill_template(F.lit(CONTEXT_TEXT), context, legacy=legacy)
    return F.array(
        message("system", F.lit(SYSTEM_TEXT)),
        message("user", question),
        message("system", filled),
    )


def set_user_message(messages: Column | str, content: Column | str) -> Column:
    """Overwrite the content of the second message."""
    content = _col(content)
    return F.transform(
        messages,
        lambda m, i: F.struct(
            m["role"].alias("role"),
            F.when(i == 1, content).otherwise(m["content"]).alias("content"),
        ),
    )


def fill_context_message(messages: Column | str, context: Column | str, **options) -> Column:
    """Fill the placeholder of the third message."""
    return F.transform(
        messages,
        lambda m, i: F.struct(
            m["role"].alias("role"),
            F.when(i == 2, fill_template(m["content"], context, **options))
            .otherwise(m["content"])
            .alias("content"),
        ),
    )


def chat_request(messages: Column | str, model: str = CHAT_MODEL, minimal: bool = False) -> Column:
    """Body of a chat request as JSON text, nulls written out; ``minimal`` has no settings."""
    asked = [_col(messages).alias("messages"), F.lit(model).alias("model")]
    body = F.struct(*asked) if minimal else F.struct(
        *asked,
        F.lit(TEMPERATURE).alias("temperature"),
        F.lit(MAX_TOKENS).alias("max_tokens"),
        F.lit(TOP_P).alias("top_p"),
        F.lit(None).cast("string").alias("stop"),
        F.lit(False).alias("stream"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def _string_at(value: Column, path: str) -> Column:
    """The JSON string at ``path``; NULL for a missing value or one of another type."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(
        F.schema_of_variant(found) == "STRING", F.try_variant_get(value, path, "string")
    )


def chat_response(
    df: DataFrame, body: str = "body", keep: tuple[str, ...] = (), fail_on_bad: bool = False
) -> DataFrame:
    """``(keep, choice, content, bad_json)``: one row per choice with a string answer.

    Anything missing on the way is skipped. A body that is no JSON gives one row with
    the body in ``bad_json``, or ends the job with ``fail_on_bad``.
    """
    parse = F.parse_json if fail_on_bad else F.try_parse_json
    parsed = df.select(*keep, F.col(body).alias("_body"), parse(body).alias("_json"))
    choices = F.try_variant_get("_json", "$.choices", "array<variant>")
    rows = parsed.select(
        *keep,
        F.when(F.col("_json").isNull(), F.col("_body")).alias("bad_json"),
        F.posexplode_outer(choices).alias("choice", "_choice"),
    )
    return rows.select(
        *keep, "choice", _string_at(F.col("_choice"), "$.message.content").alias("content"),
        "bad_json",
    ).where(F.col("content").isNotNull() | F.col("bad_json").isNotNull())


def delta_text(body: Column | str) -> Column:
    """Text of the first choice's delta in one chunk of a streamed answer, or NULL."""
    return _string_at(F.try_parse_json(body), "$.choices[0].delta.content")


def answer_ends(body: Column | str) -> Column:
    """Whether a chunk is the last of a streamed answer: a reason to finish, or the end mark."""
    reason = _string_at(F.try_parse_json(body), "$.choices[0].finish_reason")
    return F.coalesce(reason.isNotNull() | (F.trim(body) == END_MARK), F.lit(False))


def stream_deltas(
    df: DataFrame, key: str, position: str, body: str = "body"
) -> DataFrame:
    """``(key, text)``: the chunks of each streamed answer put together in order."""
    from passages.operators.ordered import concat_ordered

    parts = df.select(key, position, delta_text(body).alias("_delta"))
    return concat_ordered(parts, key, position, "_delta", "text")


def is_valid_answer(answer: Column | str) -> Column:
    """Whether the answer is a JSON object with a string field ``content``."""
    return F.coalesce(
        _string_at(F.try_parse_json(answer), "$.content").isNotNull(), F.lit(False)
    )


def json_map_values(df: DataFrame, body: str = "body", field: str = "weight_map") -> DataFrame:
    """``(value)``: the distinct strings among the values of a JSON map field.

    A body without the field, or whose field is no map, fails; values of other types
    are skipped.
    """
    found = F.try_variant_get(F.parse_json(body), f"$.{field}", "variant")
    kind = F.schema_of_variant(found)
    checked = (
        F.when(found.isNull(), F.raise_error(F.lit(f"no {field} in the body")).cast("variant"))
        .when(
            ~kind.startswith("OBJECT"),
            F.raise_error(F.lit(f"{field} is not a map")).cast("variant"),
        )
        .otherwise(found)
    )
    values = F.map_values(F.try_variant_get(checked, "$", "map<string,variant>"))
    return (
        df.select(F.explode(values).alias("_value"))
        .select(_string_at(F.col("_value"), "$").alias("value"))
        .where(F.col("value").isNotNull())
        .distinct()
    )
