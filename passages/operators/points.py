"""Points: id, vector and payload rows, and the search hits made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Low bits of a point id hold the chunk number, high bits the document id.
CHUNK_BITS = 20


def point_id(doc_id: Column | str = "doc_id", chunk_no: Column | str = "chunk_no") -> Column:
    """Id of a chunk's point: unique over documents, the same on every run."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    chunk_no = F.col(chunk_no) if isinstance(chunk_no, str) else chunk_no
    fits = (
        chunk_no.between(0, (1 << CHUNK_BITS) - 1)
        & doc_id.between(0, (1 << (63 - CHUNK_BITS)) - 1)
    )
    joined = F.shiftleft(doc_id.cast("long"), CHUNK_BITS) + chunk_no
    return F.when(fits, joined).otherwise(
        F.raise_error(F.lit("doc_id or chunk_no out of range for a point id")).cast("long")
    )


def point_doc(id: Column | str) -> Column:
    return F.shiftright(id, CHUNK_BITS)


def point_chunk(id: Column | str) -> Column:
    id = F.col(id) if isinstance(id, str) else id
    return (id % (1 << CHUNK_BITS)).cast("int")


def wrap_payload(value: Column | str, source: Column | str, parse_json: bool = False) -> Column:
    """Payload map ``{txt_chunk: value, source: source}``.

    With ``parse_json`` the text of a JSON object becomes its own keys, without the
    source; text that is no object, or malformed, is wrapped as usual.
    """
    value = F.col(value) if isinstance(value, str) else value
    source = F.col(source) if isinstance(source, str) else source
    wrapped = F.create_map(F.lit("txt_chunk"), value, F.lit("source"), source)
    if not parse_json:
        return wrapped
    is_object = F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT")
    own = F.from_json(value, "map<string,string>")
    return F.when(is_object, F.coalesce(own, wrapped)).otherwise(wrapped)


def payload_text(payload: Column | str) -> Column:
    """The chunk text of a payload, NULL when it has none."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.try_element_at(payload, F.lit("txt_chunk"))


def project_hits(df: DataFrame, id: str = "raw_id") -> DataFrame:
    """``(id, score, payload)`` of the hits whose id is a number; others are skipped."""
    return df.select(
        F.col(id).cast("string").try_cast("long").alias("id"), "score", "payload"
    ).where(F.col("id").isNotNull())


def make_points(
    chunks: DataFrame,
    vectors: DataFrame | None = None,
    source: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """``(id, embedding, payload)`` of chunk rows and their vectors.

    Vectors held in another table are paired by ``(key, chunk_no)``; a chunk without
    vector or a vector without chunk gives no point.
    """
    if vectors is not None:
        chunks = chunks.join(vectors.select(key, "chunk_no", "embedding"), [key, "chunk_no"])
    return chunks.select(
        point_id(key, "chunk_no").alias("id"),
        "embedding",
        wrap_payload("text", source).alias("payload"),
    )


def upsert_points(old: DataFrame, new: DataFrame, order: Column | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` inserted or, where the id exists, replaced.

    Of rows of ``new`` that repeat an id the one with the largest ``order`` stays, or
    without an order the one whose JSON form is largest.
    """
    row = F.struct(*[F.col(c) for c in new.columns])
    latest = new.groupBy("id").agg(
        F.max_by(row, F.to_json(row) if order is None else order).alias("_row")
    ).select("_row.*")
    return old.join(latest.select("id"), "id", "left_anti").unionByName(latest)
