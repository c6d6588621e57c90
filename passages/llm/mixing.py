"""Mixing sources to target weights: whole copies of documents by pivotal dependent rounding.

Each source's target over its size is the number of copies each of its documents should
have on average; the fraction of it has to be rounded. Two fractions meet, and words move
from one document to the other, by chance in the direction that keeps both averages, until
one of the two is a whole number; the other goes on. So the words of a source stay what they
were, but for the last fraction.

Fractions meet in groups of bounded size, dealt by a hash of the id; what a group leaves
over meets in groups of groups, and so on up a tree to one per source. Outcomes go back
down the same tree. A source of any size is thus spread over all tasks, and each level has
a few hundredths of the rows of the one below. All draws are hashes of ids and seeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passages.llm.common import ranked, small, store

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Fractions that meet in one group.
GROUP = 256
SHIPPED_ROWS = 250_000
# Equal rows written by one task at most.
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
PAIR = "struct<o:bigint,key:{key},s:double,p:double,u:double>"


def document_sizes(documents: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words of each text, none for NULL."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return documents.select("doc_id", "source", size.alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, place, source_size, documents, target)`` of each source.

    Sources by code point, NULL last, take ``weights`` in turn and share all words by them;
    a source that would get more than ``MOST_COPIES`` times its size gets that much, and the
    rest share what is left, until none is above.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("bigint")).alias("documents")
    )
    place = F.col("place")
    of_place = F.array(*map(F.lit, weights))
    sources = store(
        ranked(totals, F.asc_nulls_last("source")).withColumn(
            "weight", F.element_at(of_place, (place % len(weights)).cast("int") + 1)),
        "sources",
    )
    most = (F.col("source_size") * MOST_COPIES).cast("decimal(38,0)")
    first = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words = left = int(first.words or 0)
    share, at_most = int(first.weight or 1), -1
    while True:
        # Whole numbers, so no source is misjudged at its bound.
        full = most * F.lit(share).cast("decimal(38,0)") <= F.col("weight") * F.lit(left).cast("decimal(38,0)")
        state = sources.agg(
            F.count(F.when(full, 1)).alias("full"), F.sum(F.when(full, most)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if state.full == at_most or not state.weight:
            break
        at_most, left, share = state.full, words - int(state.taken or 0), int(state.weight)
    # As 64-bit numbers: five times the words of a few GB are beyond 32 bits.
    shared = (F.col("weight").cast("bigint") * F.lit(left)).cast("double") / F.lit(float(share))
    return sources.select(
        "source", "place", "source_size", "documents",
        F.when(full, most.cast("double")).otherwise(shared).alias("target"),
    )


def chance(*of: Column) -> Column:
    """A number in [0, 1) that depends on ``of`` only."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 52)) / F.lit(float(1 << 52))


def settle(items: Column, key: str) -> Column:
    """Let the fractions ``p`` of ``items`` (see ``PAIR``) meet one after the other.

    Gives ``held``, the item whose fraction is left over, and ``done`` with the ``key`` of
    all others and whether each was rounded ``up``. ``s`` are sizes, ``u`` the draws.
    """
    start = F.struct(
        F.lit(None).cast(PAIR.format(key=key)).alias("held"),
        F.array().cast(f"array<struct<key:{key},up:boolean>>").alias("done"),
    )

    def meet(state: Column, x: Column) -> Column:
        h = state["held"]
        h_room, h_used = (1 - h["p"]) * h["s"], h["p"] * h["s"]
        x_room, x_used = (1 - x["p"]) * x["s"], x["p"] * x["s"]
        gain, loss = F.least(h_room, x_used), F.least(h_used, x_room)
        rises = x["u"] * (gain + loss) < loss
        h_done = F.when(rises, h_room <= x_used).otherwise(h_used <= x_room)
        moved = F.when(rises, gain).otherwise(-loss)

        def going_on(item: Column, words: Column) -> Column:
            p = F.greatest(F.least(item["p"] + words / item["s"], F.lit(1.0)), F.lit(0.0))
            return F.struct(
                item["o"].alias("o"), item["key"].alias("key"), item["s"].alias("s"),
                p.alias("p"), item["u"].alias("u"),
            )

        # It ends at one if words came to the held one and fill it, or left the other's side.
        settled = F.struct(
            F.when(h_done, h["key"]).otherwise(x["key"]).alias("key"), (rises == h_done).alias("up")
        )
        later = F.struct(
            F.when(h_done, going_on(x, -moved)).otherwise(going_on(h, moved)).alias("held"),
            F.concat(state["done"], F.array(settled)).alias("done"),
        )
        return F.when(h.isNull(), F.struct(x.alias("held"), state["done"].alias("done"))).otherwise(later)

    return F.aggregate(items, start, meet)


def in_groups(items: DataFrame, key: str, name: str) -> DataFrame:
    """``(place, bin, held, done)``: the items of each bin of a source, settled and stored."""
    listed = items.groupBy("place", "bin").agg(
        F.sort_array(F.collect_list(F.struct("o", "key", "s", "p", "u"))).alias("items")
    )
    return store(
        listed.select("place", "bin", settle(F.col("items"), key).alias("r")).select("place", "bin", "r.*"),
        name,
    )


def round_items(items: DataFrame, key: str, bins: int, seed: int, group: int = GROUP) -> DataFrame:
    """``(place, key, up)``: the outcome of every item, through the tree of groups.

    ``items`` is ``(place, bin, o, key, s, p, u)``; no place has more than ``bins`` bins.
    """
    levels = [in_groups(items, key, "groups-0")]
    bin_key = "struct<bin:bigint>"
    while bins > 1:
        below = levels[-1]
        level = F.lit(len(levels))
        levels.append(in_groups(
            below.select(
                "place", F.floor(F.col("bin") / group).cast("bigint").alias("bin"),
                F.col("bin").alias("o"), F.struct("bin").alias("key"), "held.s", "held.p",
                chance(F.lit(seed), level, "place", "bin").alias("u"),
            ), bin_key, f"groups-{len(levels)}",
        ))
        bins = -(-bins // group)
    last = levels[-1]
    outcome = last.select(
        "place", "bin", (chance(F.lit(seed), F.lit(-1), "place") < F.col("held.p")).alias("up")
    )
    for level in reversed(levels):
        known = store(outcome, "outcomes")
        everyone = F.concat("done", F.array(F.struct(F.col("held.key").alias("key"), F.col("up"))))
        found = level.join(small(known, SHIPPED_ROWS), ["place", "bin"]).select(
            "place", F.explode(everyone).alias("x")
        )
        outcome = found.select("place", "x.key.bin", "x.up") if level is not levels[0] else found.select(
            "place", "x.key", "x.up")
    return outcome


def each_row(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every one of the ``c`` equal rows that a row stands for, numbered ``i`` from 1.

    More than ``chunk`` of them are written by several tasks.
    """
    few = rows.where(F.col("c") <= chunk).withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), "c")))
    first = F.col("part") * chunk + 1
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c") - 1) / chunk).cast("bigint"))
    many = (
        rows.where(F.col("c") > chunk).withColumn("part", F.explode(parts))
        .repartition("doc_id", "size", "part")
        .withColumn("i", F.explode(F.sequence(first, F.least("c", first + (chunk - 1))))).drop("part")
    )
    return few.unionByName(many)


def mix_sources(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 1, group: int = GROUP
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, source, copies)`` of every document.

    ``documents`` is ``(doc_id, text, source)``; other columns are ignored. ``copies`` is the
    share ``target / source_size``, rounded down or up; ``taken`` is so many times the size.
    The words taken of a source differ from its target by less than its longest document.
    NULL texts are empty; NULL is a source like any other, and so is the empty name; empty
    texts and sources without words have no copies to round. Rows that repeat an id, NULL
    ids among them, each get their own copies. The same rows give the same answer, however
    they are dealt out; ``seed`` gives another. An empty table gives no row.
    """
    sizes = store(document_sizes(documents), "sizes")
    sources = store(
        source_targets(sizes, weights)
        .withColumn("share", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
        .withColumn("bins", F.ceil(F.col("documents") / group).cast("bigint")),
        "targets",
    )
    shipped = small(sources, SHIPPED_ROWS)
    most_bins = sources.agg(F.max("bins")).first()[0] or 0
    whole = F.floor("share").cast("bigint")
    placed = F.col("source").eqNullSafe(F.col("_source"))
    of_source = shipped.withColumnRenamed("source", "_source")
    to_round = (F.col("size") > 0) & (F.col("share") > whole)

    plain = sizes.join(of_source, placed).where(~to_round).select(
        "doc_id", "size", "source_size", "target", "source", whole.alias("copies"))

    # Equal rows are one item: of c with fraction p, floor(c * p) go up and one has the rest.
    equal = sizes.where("size > 0").groupBy("source", "doc_id", "size").agg(F.count("*").alias("c"))
    up = F.col("c") * (F.col("share") - whole)
    own = [F.lit(seed), F.col("place"), F.coalesce("doc_id", F.lit(0).cast("bigint")), F.col("size")]
    items = equal.join(of_source, placed).where(to_round).select(
        "place", F.pmod(F.xxhash64(F.lit("bin"), *own), F.col("bins")).alias("bin"),
        F.xxhash64(F.lit("order"), *own).alias("o"),
        F.struct("doc_id", "size", "c", F.floor(up).cast("bigint").alias("ups")).alias("key"),
        F.col("size").cast("double").alias("s"), (up - F.floor(up)).alias("p"),
        chance(F.lit("draw"), *own).alias("u"),
    )
    key = "struct<doc_id:bigint,size:bigint,c:bigint,ups:bigint>"
    outcome = round_items(items, key, most_bins, seed, group).select("place", "key.*", "up")
    rounded = (
        each_row(outcome).join(shipped, "place")
        .withColumn("copies", whole + (F.col("i") <= F.col("ups") + F.col("up").cast("bigint")).cast("bigint"))
    )
    return plain.unionByName(rounded.select(plain.columns)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies",
    )
