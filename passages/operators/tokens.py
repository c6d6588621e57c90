"""Vocabularies, and token ids of a corpus through them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passages.functions.text import display_token, words
from passages.operators.chunking import CLS_ID, PAD_ID, SEP_ID, UNK_ID
from passages.operators.joins import join_lookup
from passages.session import scratch_path

# Reserved rows of every vocabulary.
SPECIAL_TOKENS = {"[PAD]": PAD_ID, "[UNK]": UNK_ID, "[CLS]": CLS_ID, "[SEP]": SEP_ID}
FIRST_WORD_ID = 1000
# A vocabulary up to this many rows and bytes is shipped to the tasks.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20
# Elements of the rows that share one dictionary, and rows of one batch of them: a worker
# holds a group, and a core may have a worker for each of several steps.
GROUP_VALUES, OUT_ROWS = 1 << 19, 2_000


def build_vocab(df: DataFrame, text: str = "text", size: int | None = None) -> DataFrame:
    """``(token, id)``: reserved tokens and all words, or the ``size`` most frequent.

    Equal counts rank by word. Counting combines before the shuffle, so a frequent
    word ships one row per task. Words are sorted by ranges and stored with their place
    in the range; only the length of each range is combined, so no task numbers them all.
    """
    spark = df.sparkSession
    counts = df.select(F.explode(words(text)).alias("token")).groupBy("token").count()
    order = [F.desc("count"), F.col("token")]
    # The high bits of this id are the task, the low 33 the row in it.
    place = F.monotonically_increasing_id()
    path = scratch_path(spark, "words")
    counts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "token", F.shiftright(place, 33).alias("_range"), place.alias("_place")
    ).write.parquet(path)
    ranked = spark.read.schema("token string, _range long, _place long").parquet(path)
    lengths = ranked.groupBy("_range").count().orderBy("_range").collect()
    before = [0, *accumulate(r["count"] for r in lengths)]
    starts = spark.createDataFrame(
        [(r["_range"], start) for r, start in zip(lengths, before)], "_range long, _start long"
    )
    rank = F.col("_start") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    ranked = ranked.join(F.broadcast(starts), "_range").select("token", rank.alias("_rank"))
    if size is not None:
        ranked = ranked.where(F.col("_rank") <= size)
    specials = spark.createDataFrame(list(SPECIAL_TOKENS.items()), "token string, id int")
    return specials.unionByName(
        ranked.where(~F.col("token").isin(*SPECIAL_TOKENS)).select(
            "token", (F.col("_rank") + (FIRST_WORD_ID - 1)).cast("int").alias("id")
        )
    )


def translate(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    source: str,
    target: str,
    broadcast_rows: int = BROADCAST_ROWS,
    group_values: int = GROUP_VALUES,
) -> DataFrame:
    """Replace each element of an array column through ``lookup``; unknown gives NULL.

    A lookup of at most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` is shipped to the
    tasks and rows stay in place. For a larger one see ``translate_by_dictionary``.
    """
    lookup = lookup.select(source, target)
    size = lookup.select(
        (F.octet_length(F.col(source).cast("string")) + F.octet_length(F.col(target).cast("string")))
        .alias("size")
    ).limit(broadcast_rows + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    ).first()
    if size["rows"] > broadcast_rows or size["bytes"] > BROADCAST_BYTES:
        return translate_by_dictionary(df, column, lookup, source, target, group_values)
    shared = df.sparkSession.sparkContext.broadcast(lookup.toArrow().combine_chunks())

    @F.arrow_udf(T.ArrayType(lookup.schema[target].dataType))
    def mapped(arrays: pa.Array) -> pa.Array:
        table = shared.value
        keys, values = table.column(0).combine_chunks(), table.column(1).combine_chunks()
        found = values.take(pc.index_in(arrays.flatten().cast(keys.type), value_set=keys))
        return _lists(found, arrays)

    return df.withColumn(column, mapped(column))


def _lists(values: pa.Array, like: pa.Array) -> pa.Array:
    """Lists of the lengths of ``like`` over flat ``values``; a NULL list stays NULL."""
    lengths = pc.fill_null(pc.list_value_length(like), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null())


def translate_by_dictionary(
    df: DataFrame, column: str, lookup: DataFrame, source: str, target: str,
    group_values: int = GROUP_VALUES,
) -> DataFrame:
    """``translate`` through a lookup of any size.

    A task puts its rows together in groups of about ``group_values`` elements, replaces
    the elements by places in the group's own dictionary and stores both. Only the
    dictionaries are shuffled and joined, so a word costs a row for each group that has it,
    however often it occurs. The rows are stored in buckets of their groups and stay there:
    what the join found comes to them, group by group.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c != column]
    rows = df.select(*others, column)
    nullable = [T.StructField(c, df.schema[c].dataType) for c in others]
    stored_schema = T.StructType([
        T.StructField("_part", T.LongType()), *nullable,
        T.StructField("_codes", T.ArrayType(T.IntegerType())),
        T.StructField("_own", T.ArrayType(lookup.schema[source].dataType)),
    ])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(stored_schema)
        first = TaskContext.get().partitionId() << 32
        for number, table in enumerate(_groups(batches, len(others), group_values)):
            lists = table.column(len(others)).combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            coded = lists.flatten().cast(schema.field("_own").type.value_type).dictionary_encode()
            part = pa.array([first + number], pa.int64())
            yield from pa.Table.from_arrays(
                [part.take(pa.array(np.zeros(len(lists), np.int64))), *table.columns[:-1],
                 _lists(coded.indices, lists), pa.nulls(len(lists), schema.field("_own").type)],
                schema=schema,
            ).to_batches(max_chunksize=OUT_ROWS)
            own = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
            yield pa.RecordBatch.from_arrays(
                [part, *[pa.nulls(1, f.type) for f in schema][1:-1], own], schema=schema)
            # Before the next group is put together this one is let go.
            del table, lists, coded, own
            pa.default_memory_pool().release_unused()

    stored = in_buckets(rows.mapInArrow(code, stored_schema), "_part")
    own = stored.where("_own IS NOT NULL").select(
        F.col("_part").alias("_group"), F.posexplode("_own").alias("_place", source))
    found = own.join(lookup, source).select("_group", "_place", F.col(target).alias("_new"))
    coded = stored.where("_own IS NULL").select("_part", *others, "_codes")
    result = T.StructType([
        *[stored.schema[c] for c in others], T.StructField(column, T.ArrayType(lookup.schema[target].dataType))])

    def decode(left: pa.Table, right: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        lists = left["_codes"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        codes = lists.flatten()
        places = right["_place"].to_numpy()
        most = max(pc.max(codes).as_py() or 0, int(places.max()) if len(places) else 0)
        row_of = np.full(most + 1, -1, np.int64)
        row_of[places] = np.arange(len(places))
        at = row_of[pc.fill_null(codes, 0).to_numpy()]
        unknown = (at < 0) | codes.is_null().to_numpy(zero_copy_only=False)
        values = right["_new"].combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        new = values.take(pa.array(at, mask=unknown))
        return pa.table([*left.columns[1:-1], _lists(new, lists)], names=result.names)

    answered = coded.groupBy("_part").cogroup(found.groupBy("_group")).applyInArrow(decode, result)
    return answered.select(*df.columns)


def _groups(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[pa.Table]:
    """Rows put together until the lists of column ``at`` have ``most`` elements, or one row."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column(at)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = done = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, done + most - held, side="right"))
            if end == begin and waiting:
                yield pa.Table.from_batches(waiting)
                waiting, held = [], 0
                continue
            end = max(end, begin + 1)
            waiting.append(batch.slice(begin, end - begin))
            held += int(ends[end - 1]) - done
            begin, done = end, int(ends[end - 1])
            if held >= most:
                yield pa.Table.from_batches(waiting)
                waiting, held = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def in_buckets(df: DataFrame, key: str) -> DataFrame:
    """Store ``df`` in buckets of ``key``, so that grouping by it moves no row.

    Rows of one key must lie in one task, or its bucket has several files. The table has a
    name only while it is written and opened.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, key).saveAsTable(name))
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def encode_corpus(
    df: DataFrame,
    vocab: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    special: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, ids)``: word ids of each text, between ``[CLS]`` and ``[SEP]``.

    A word outside the vocabulary becomes ``[UNK]``; a text without words keeps its row.
    """
    split = df.select(key, words(text).alias("ids"))
    coded = translate(split, "ids", vocab, "token", "id", broadcast_rows)
    ids = F.transform("ids", lambda x: F.coalesce(x, F.lit(UNK_ID)))
    if special:
        ids = F.concat(F.array(F.lit(CLS_ID)), ids, F.array(F.lit(SEP_ID)))
    return coded.select(key, ids.alias("ids"))


def without_specials(ids: Column | str) -> Column:
    return F.filter(ids, lambda x: ~x.isin(*SPECIAL_TOKENS.values()))


def decode_corpus(
    df: DataFrame,
    vocab: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    skip_special: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, *keep, text)``: the tokens of an id list joined by a space."""
    kept = df.select(key, *keep, (without_specials(ids) if skip_special else F.col(ids)).alias("_ids"))
    tokens = translate(kept, "_ids", vocab, "id", "token", broadcast_rows)
    return tokens.select(key, *keep, F.array_join("_ids", " ").alias("text"))


def token_listing(
    df: DataFrame,
    vocab: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, pos, id, token)``: one row per token, in printable form."""
    both = df.select(key, F.col(ids).alias("ids"), F.col(ids).alias("_tokens"))
    named = translate(both, "_tokens", vocab, "id", "token", broadcast_rows)
    pairs = named.select(key, F.posexplode(F.arrays_zip("ids", "_tokens")).alias("pos", "_pair"))
    return pairs.select(
        key, "pos", F.col("_pair.ids").alias("id"),
        display_token(F.col("_pair._tokens")).alias("token"),
    )


def pad_batch(df: DataFrame, batch: str, key: str, ids: str = "ids") -> DataFrame:
    """Pad every id list to the longest of its batch.

    The longest length is combined before the shuffle and joined back with the rows of
    a hot batch spread over tasks.
    """
    longest = df.groupBy(batch).agg(F.max(F.size(ids)).alias("_longest"))
    padded = F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.col("_longest") - F.size(ids)))
    return (
        join_lookup(df, longest, batch, spread_by=[key], how="inner")
        .withColumn(ids, padded)
        .drop("_longest")
    )
