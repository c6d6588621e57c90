"""Benchmark decontamination: short test items found inside documents of any length.

A document contains an item if it has at least 75 % of the item's distinct five-word
shingles. Items are partitioned by their number of shingles. In a partition every item is
sketched by its smallest shingle hashes (a bottom-k MinHash), and ``k`` follows from the
partition: with ``q`` shingles a document that contains the item lacks ``q - need`` at
most, so the ``q - need + 1`` smallest cannot all be missing. A document's own size does not
matter, as its shingles are probed against the sketches and not sketched themselves: that
would lose a short item in a long document. Candidates are then verified on the shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passages.llm.common import small, store

SHINGLE_WORDS = 5
PERCENT = 75
# Tables of at most so many rows are shipped; beyond, joins are shuffled.
SHIPPED_ROWS = 250_000
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words between ASCII white space, A-Z lower-cased; none for NULL."""
    lowered = F.translate(F.coalesce(text, F.lit("")), A_TO_Z, A_TO_Z.lower())
    return F.filter(F.split(lowered, "[ \\t-\\r]+"), lambda w: w != "")


def shingles_of(words: Column, length: int = SHINGLE_WORDS, as_hash: bool = True) -> Column:
    """Every run of ``length`` words, in order and with repeats, as a hash or as text.

    ``words`` is bound once, so that it is not worked out again for each run.
    """

    def run(words: Column) -> Column:
        def at(start: Column) -> Column:
            parts = [F.get(words, start + i) for i in range(length)]
            return F.xxhash64(*parts) if as_hash else F.concat_ws(" ", *parts)

        last = F.size(words) - length
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at)).otherwise(
            F.array().cast("array<bigint>" if as_hash else "array<string>")
        )

    return F.flatten(F.transform(F.array(words), run))


def item_shingles(benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(item_id, width, shingle, hash, size, need, sketched)`` of all items.

    ``width`` is 5, or the number of words of a shorter item, whose only shingle is the
    whole of it. Items without words have none and are found nowhere.
    """
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 0).withColumn(
        "width", F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    )
    runs = F.when(F.size("words") < SHINGLE_WORDS, F.array(F.concat_ws(" ", "words"))).otherwise(
        shingles_of(F.col("words"), as_hash=False)
    )
    rows = words.select("item_id", "width", F.explode(F.array_distinct(runs)).alias("shingle"))
    rows = rows.distinct()  # an item that is listed twice
    sizes = rows.groupBy("item_id").agg(
        F.count("*").alias("size"),
        F.array_sort(F.collect_list(F.struct(F.xxhash64("shingle").alias("h"), "shingle", "width")))
        .alias("ordered"),
    )
    need = F.ceil(F.col("size") * percent / 100).cast("int")
    partition = sizes.withColumn("need", need).withColumn(
        "sketch", F.col("size") - F.col("need") + 1
    )
    return partition.select(
        "item_id", "size", "need", "sketch", F.posexplode("ordered").alias("place", "s")
    ).select(
        "item_id", "s.width", "s.shingle", "size", "need",
        (F.col("place") < F.col("sketch")).alias("sketched"),
        hash_of_text(F.col("s.shingle"), F.col("s.width")).alias("hash"),
    )


def hash_of_text(shingle: Column, width: Column) -> Column:
    """The hash that ``shingles_of`` gives for the words of ``shingle``."""
    parts = F.split(shingle, " ")
    by_width = [
        F.when(width == w, F.xxhash64(*[F.get(parts, F.lit(i)) for i in range(w)]))
        for w in range(1, SHINGLE_WORDS + 1)
    ]
    return F.coalesce(*by_width)


def contained_items(
    documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT,
    shipped_rows: int = SHIPPED_ROWS,
) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_shingles, containment)``: items found in documents.

    Documents ``(doc_id, text)``, items ``(item_id, text)``. The probe ships the sketches
    if they are at most ``shipped_rows``, as it does candidates for the verification, and
    else shuffles by hash. NULL and empty texts contain nothing; rows without doc_id or
    item_id are left out; rows that repeat a doc_id count as one document with the
    shingles of all; an item listed twice under one id counts once.
    """
    documents = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    items = store(
        item_shingles(benchmark.where(F.col("item_id").isNotNull()), percent), "item-shingles"
    )
    widths = [row.width for row in items.select("width").distinct().orderBy("width").collect()]
    if not widths:
        widths = [SHINGLE_WORDS]
    words = documents.select("doc_id", words_of(F.col("text")).alias("words"))

    def probed(rows: DataFrame, **kind) -> DataFrame:
        every = F.array(*[
            F.struct(F.lit(w).alias("width"), shingles_of(F.col("words"), w, **kind).alias("s"))
            for w in widths
        ])
        by_width = rows.select("doc_id", F.explode(every).alias("w"))
        return by_width.select("doc_id", "w.width", F.explode("w.s").alias("found"))

    sketches = items.where("sketched").select("item_id", F.col("hash").alias("found"), "width")
    candidates = store(
        probed(words).join(small(sketches, shipped_rows), ["found", "width"])
        .select("doc_id", "item_id").distinct(),
        "candidates",
    )
    suspects = small(candidates.select("doc_id").distinct(), shipped_rows)
    whole = small(
        items.select("item_id", "width", F.col("shingle").alias("found"), "size", "need"),
        shipped_rows,
    )
    shared = (
        probed(words.join(suspects, "doc_id", "left_semi"), as_hash=False)
        .join(whole, ["found", "width"])
        .groupBy("doc_id", "item_id", "size", "need", "found").agg(F.lit(1).alias("one"))
        .groupBy("doc_id", "item_id", "size", "need").agg(F.count("*").alias("n_shared"))
    )
    return (
        shared.join(candidates, ["doc_id", "item_id"], "left_semi")
        .where(F.col("n_shared") >= F.col("need"))
        .select("doc_id", "item_id", "n_shared", F.col("size").alias("n_shingles"),
                (F.col("n_shared") / F.col("size")).alias("containment"))
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` without those that contain an item; rows without doc_id stay."""
    found = store(contained_items(documents, benchmark, **options), "contained")
    hit = small(found.select("doc_id").distinct(), SHIPPED_ROWS)
    return documents.join(hit, "doc_id", "left_anti").select(documents.columns)
