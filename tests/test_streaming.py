import random

import pytest
from pyspark.sql import functions as F

from passages.operators.assembly import assemble_text
from passages.operators.ordered import concat_ordered, running_total
from passages.session import scratch_path
from passages.streaming.assemble import assemble_text_stream
from passages.streaming.ingest import document_points, ingest_stream, latest_points

ALPHABET = ["a", " b", ",", ".", "é", "9", "中", "!", " ", "", "̀", "½"]


def _sequences(seed, count=12, longest=60):
    rng = random.Random(seed)
    return {s: [rng.choice(ALPHABET) for _ in range(rng.randint(1, longest))] for s in range(count)}


def _released(pieces):
    """Texts in the order of release: up to each piece that ends in a letter or number."""
    out, start = [], 0
    for end, piece in enumerate(pieces, 1):
        text = "".join(pieces[start:end])
        if piece and (piece[-1].isalnum()):
            out.append(text)
            start = end
    rest = "".join(pieces[start:])
    return out + ([rest] if rest else [])


def _expected(sequences):
    return sorted((s, n, t) for s, p in sequences.items() for n, t in enumerate(_released(p)))


@pytest.mark.parametrize("segment", [1, 7, 16_384])
def test_assemble_text(spark, segment):
    sequences = _sequences(1)
    rows = [(s, n, p) for s, pieces in sequences.items() for n, p in enumerate(pieces)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "seq_id long, pos long, piece string")
    found = assemble_text(df, segment=segment).collect()
    assert sorted(map(tuple, found)) == _expected(sequences)


@pytest.mark.parametrize("segment", [1, 10, 1000])
def test_running_total_and_concat(spark, segment):
    rng = random.Random(segment)
    rows = [(k, p, rng.randint(-5, 9)) for k in range(3) for p in rng.sample(range(500), 150)]
    df = spark.createDataFrame(rows, "k long, pos long, v long").repartition(3)
    for inclusive in (True, False):
        found = running_total(df, "k", "pos", F.col("v"), "t", inclusive, segment).collect()
        assert len(found) == len(rows)
        for r in found:
            total = sum(v for k, p, v in rows if k == r.k and (p < r.pos or inclusive and p == r.pos))
            assert r.t == total
    joined = concat_ordered(df.withColumn("s", F.col("v").cast("string")), "k", "pos", "s", "out",
                            ",", segment).collect()
    for r in joined:
        assert r.out == ",".join(str(v) for _, v in sorted((p, v) for k, p, v in rows if k == r.k))


@pytest.mark.parametrize("seed", [3, 4])
def test_stream_equals_batch_for_any_split(spark, seed):
    sequences = _sequences(seed, count=8)
    rows = [(s, n, p, n == len(pieces) - 1)
            for s, pieces in sequences.items() for n, p in enumerate(pieces)]
    rng = random.Random(seed)
    rng.shuffle(rows)
    source, target = scratch_path(spark, "pieces"), scratch_path(spark, "out")
    schema = "seq_id long, pos long, piece string, is_last boolean"
    while rows:
        part, rows = rows[:70], rows[70:]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        assemble_text_stream(stream).writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == _expected(sequences)


def test_stream_drops_repeats_and_holds_an_open_sequence(spark):
    source, target = scratch_path(spark, "pieces"), scratch_path(spark, "out")
    schema = "seq_id long, pos long, piece string, is_last boolean"
    for part in ([(1, 0, "a", False), (1, 1, ",", False)], [(1, 0, "a", False), (1, 3, "z", False)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    assemble_text_stream(stream).writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "progress")
    ).trigger(availableNow=True).start(target).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, 0, "a")]


def test_ingest_restart_and_update(spark):
    source, target = scratch_path(spark, "docs"), scratch_path(spark, "points")
    progress = scratch_path(spark, "progress")
    schema = "doc_id long, text string, source string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest_stream(stream, target, progress).awaitTermination()

    def texts():
        return sorted((r.id, r.payload["txt_chunk"]) for r in latest_points(spark, target).collect())

    arrive((1, "one  two", "s"))
    arrive((2, " ", "s"), (3, "three", "t"))
    run()
    assert texts() == [(1 << 20, "one two"), (3 << 20, "three")]
    run()
    arrive((3, "changed", "t"))
    run()
    assert texts() == [(1 << 20, "one two"), (3 << 20, "changed")]
    batch = document_points(spark.createDataFrame([(3, "changed", "t")], schema)).first()
    stored = [r for r in latest_points(spark, target).collect() if r.id == batch.id][0]
    assert stored.embedding == batch.embedding and stored.payload == batch.payload


def _run(spark, parts, schema, make):
    source, target = scratch_path(spark, "pieces"), scratch_path(spark, "out")
    progress = scratch_path(spark, "progress")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    make(stream).writeStream.format("parquet").option("checkpointLocation", progress).trigger(
        availableNow=True).start(target).awaitTermination()
    return sorted(map(tuple, spark.read.parquet(target).collect()))


def test_an_ended_sequence_does_not_start_again(spark):
    parts = [[(1, 0, "a", False), (1, 1, " b", True), (2, 1, "y", True)], [(1, 0, "a", False)],
             [(1, 1, " b", True), (1, 2, "c", False), (2, 0, "x", False), (2, 1, "z", True)]]
    found = _run(spark, parts, "seq_id long, pos long, piece string, is_last boolean", assemble_text_stream)
    assert found == [(1, 0, "a"), (1, 1, " b"), (2, 0, "x"), (2, 1, "y")]


class _Cell:
    def __init__(self):
        self.value, self.calls = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Map(dict):
    calls = 0

    def containsKey(self, key):
        self.calls += 1
        return key in self

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]

    def iterator(self):
        return iter(self.items())


class _Handle:
    def __init__(self):
        self.map, self.timers = _Map(), []

    def registerTimer(self, at):
        self.timers.append(at)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getValueState(self, *_):
        return _Cell()

    def getMapState(self, *_):
        return self.map


class _Clock:
    def getCurrentProcessingTimeInMs(self):
        return 5


@pytest.mark.parametrize("pieces", [100, 400])
def test_a_gap_costs_a_few_state_calls_a_piece(pieces):
    """Piece 0 comes last, one piece a batch: no batch reads what waits."""
    import pandas as pd

    from passages.streaming.assemble import Assembler

    handle, found = _Handle(), []
    work = Assembler(False, None, 1000)
    work.init(handle)
    for pos in [*range(1, pieces), 0]:
        frame = pd.DataFrame([(pos, f"w{pos} ", True, pos == pieces - 1)],
                             columns=["pos", "piece", "ends", "is_last"])
        for out in work.handleInputRows((7,), iter([frame]), _Clock()):
            found += out["text"].tolist()
    assert found == [f"w{i} " for i in range(pieces)] and not handle.map
    assert handle.map.calls <= 6 * pieces


def _feed(work, rows):
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["pos", "piece", "ends", "is_last"])
    return [t for out in work.handleInputRows((7,), iter([frame]), _Clock()) for t in out["text"]]


def test_pieces_of_a_batch_share_state_calls():
    """2,000 pieces come before the first: entries of the state are blocks, not pieces."""
    from passages.streaming.assemble import Assembler

    handle = _Handle()
    work = Assembler(True, None, None)
    work.init(handle)
    rows = [(pos, f"w{pos} ", False, pos == 2000) for pos in range(2001)]
    assert _feed(work, rows[1:]) == []
    assert _feed(work, rows[:1]) == ["".join(r[1] for r in rows)] and not handle.map
    assert handle.map.calls <= 60


@pytest.mark.parametrize("seed", range(6))
def test_blocks_of_any_batches_give_the_sequence(monkeypatch, seed):
    """Repeats with another text come later and do not count, also where blocks are cut."""
    from passages.streaming import assemble

    monkeypatch.setattr(assemble, "BLOCK", 4)
    rng = random.Random(seed)
    handle = _Handle()
    work = assemble.Assembler(False, None, None)
    work.init(handle)
    pieces = [rng.choice(["a", " b", ",", ""]) for _ in range(50)]
    rows = [(n, p, p.strip() > ",", n == 49) for n, p in enumerate(pieces)]
    rng.shuffle(rows)
    found, fed = [], []
    while rows:
        size = rng.randint(1, 9)
        part, rows = rows[:size], rows[size:]
        again = [(n, "late", True, False) for n, *_ in rng.sample(fed, min(len(fed), 3))]
        found += _feed(work, part + again)
        fed += part
    texts, held = [], ""
    for n, p in enumerate(pieces):
        held += p
        if held and (p.strip() > "," or n == 49):
            texts.append(held)
            held = ""
    assert found == texts and not handle.map


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_the_batch_for_any_split(spark, seed):
    import json

    from passages.operators.prompts import stream_deltas
    from passages.streaming.assemble import stream_deltas_stream

    rng, rows = random.Random(seed), []
    for s, pieces in _sequences(seed, count=9, longest=20).items():
        bodies = [json.dumps({"choices": [{"delta": {"content": p}}, {"delta": {"content": "other"}}]})
                  for p in pieces]
        bodies[0:0] = ['{"choices":[{"delta":{"role":"assistant"}}]}']
        bodies.append("[DONE]" if s % 2 else '{"choices":[{"delta":{"content":"!"},"finish_reason":"stop"}]}')
        rows += [(s, n, b) for n, b in enumerate(bodies)]
    rows += [(99, 0, "no json"), (99, 1, None), (99, 2, "[DONE]")]
    schema = "seq_id long, pos long, body string"
    batch = stream_deltas(spark.createDataFrame(rows, schema), "seq_id", "pos")
    rng.shuffle(rows)
    parts = [rows[i:i + 40] for i in range(0, len(rows), 40)]
    found = _run(spark, parts + [rows[:10]], schema, stream_deltas_stream)
    assert found == sorted((r.seq_id, r.text or "") for r in batch.collect())


def test_shrunk_documents_lose_their_old_chunks(spark):
    from passages.streaming.ingest import compact_points

    source, target = scratch_path(spark, "docs"), scratch_path(spark, "points")
    progress = scratch_path(spark, "progress")
    schema = "doc_id long, text string, source string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest_stream(stream, target, progress).awaitTermination()

    def ids(points=None):
        rows = (points or latest_points(spark, target)).select("id").collect()
        return sorted((r.id >> 20, r.id & ((1 << 20) - 1)) for r in rows)

    long = " ".join(f"w{i}" for i in range(700))
    arrive((1, long, "s"), (2, long, "s"), (None, long, "s"))
    assert ids() == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
    arrive((1, "short", "s"), (1, "a", "s"))
    assert ids() == [(1, 0), (2, 0), (2, 1), (2, 2)]
    compacted = compact_points(spark, target)
    files = {r[0] for r in compacted.select(F.input_file_name()).distinct().collect()}
    assert ids(compacted) == [(1, 0), (2, 0), (2, 1), (2, 2)] and all("/compacted/" in f for f in files)
    arrive((2, None, "s"), (3, "new", "s"))
    assert ids() == ids(compact_points(spark, target)) == [(1, 0), (3, 0)]


def test_a_timer_releases_what_waits_and_ends_the_sequence():
    import pandas as pd

    from passages.streaming.assemble import Assembler

    handle = _Handle()
    work = Assembler(False, 100, None)
    work.init(handle)

    def arrive(*rows):
        frame = pd.DataFrame(rows, columns=["pos", "piece", "ends", "is_last"])
        return [t for out in work.handleInputRows((7,), iter([frame]), _Clock()) for t in out["text"]]

    assert arrive((0, "a", True, False), (1, ",", False, False), (12, " z", True, False)) == ["a"]
    assert arrive((5, " b", True, False), (6, "!", False, False)) == [] and handle.timers == [105]
    released = [t for out in work.handleExpiredTimer((7,), _Clock(), None) for t in out["text"]]
    assert released == [", b", "! z"] and handle.timers == []
    assert arrive((2, "late", True, True)) == []
