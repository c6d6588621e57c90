"""Ordered text from an unbounded stream of pieces: token pieces, and chunks of answers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from passages.functions.text import ALPHANUMERIC_END
from passages.operators.prompts import answer_ends, delta_text

OUTPUT = "seq_id bigint, emit_no bigint, text string"
STATE = "held string, due bigint, emit_no bigint, waiting bigint"
# Pieces that wait, by position; a block of positions is one entry of the state.
BLOCK = 256
PIECES = "pos array<bigint>, piece array<string>, ends array<boolean>, is_last array<boolean>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Map states and timers need this store; queries already running keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Assembler(StatefulProcessor):
    """Puts the pieces of each sequence in order and releases text, see below.

    One value holds the text not yet released and the next position; pieces that came early
    wait in a map, all of a block of positions in one entry, so a batch costs a few calls of
    the state for each block that it brings or releases, however much waits behind a gap.
    """

    def __init__(self, whole: bool, timeout_ms: int | None, remembered_ms: int | None):
        self.whole, self.timeout_ms, self.remembered_ms = whole, timeout_ms, remembered_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)
        self.early = handle.getMapState("early", "block bigint", PIECES)
        lifetime = () if self.remembered_ms is None else (self.remembered_ms,)
        self.ended = handle.getValueState("ended", "ended boolean", *lifetime)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.open.get()
        if state is None and self.ended.exists():
            return
        held, due, emit_no, waiting = state or ("", 0, 0, 0)
        arrived: dict[int, dict[int, tuple]] = {}
        for frame in rows:
            for pos, *piece in zip(frame["pos"], frame["piece"], frame["ends"], frame["is_last"]):
                if pos >= due:
                    block = arrived.setdefault(int(pos) // BLOCK, {})
                    block.setdefault(int(pos), (piece[0], bool(piece[1]), bool(piece[2])))
        out: list[str] = []
        parts = [held] * bool(held)
        finished, taken = False, set()
        # What waits lies behind the piece that is due, so only that one lets it move.
        moves = due in arrived.get(due // BLOCK, ())
        while moves:
            number = due // BLOCK
            block = self._with_waiting(number, arrived.pop(number, {}), waiting)
            taken.add(number)
            while due in block and not finished:
                piece, ends, finished = block.pop(due)
                due += 1
                parts += [piece] * bool(piece)
                if (parts or self.whole) and (finished or ends and not self.whole):
                    out.append("".join(parts))
                    parts = []
            moves = not finished and due // BLOCK > number
            arrived[number] = block
        if finished:
            yield from self._end(key, emit_no, out)
            return
        waiting = self._wait(arrived, taken, waiting)
        self.open.update(("".join(parts), due, emit_no + len(out), waiting))
        if self.timeout_ms is not None:
            self._drop_timers()
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
        yield from self._rows(key, emit_no, out)

    def _with_waiting(self, number: int, block: dict[int, tuple], waiting: int) -> dict[int, tuple]:
        """Pieces of a block with those that wait; the first of equal positions counts."""
        if not waiting or not self.early.containsKey((number,)):
            return block
        pos, *pieces = self.early.getValue((number,))
        return block | dict(zip(pos, zip(*pieces)))

    def _wait(self, arrived: dict[int, dict[int, tuple]], taken: set[int], waiting: int) -> int:
        """Store the blocks, of which the taken ones are whole; the number of blocks that wait."""
        stored = waiting
        for number, block in arrived.items():
            known = bool(stored) and self.early.containsKey((number,))
            if block:
                if known and number not in taken:
                    block = self._with_waiting(number, block, stored)
                pos = sorted(block)
                self.early.updateValue(
                    (number,), (pos, *map(list, zip(*(block[p] for p in pos)))))
            elif known:
                self.early.removeKey((number,))
            waiting += bool(block) - known
        return waiting

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """What waits behind a gap is released in order, as if the gap were empty."""
        if not self.open.exists():
            return
        held, _, emit_no, _ = self.open.get()
        out = []
        blocks = [zip(*pieces) for _, pieces in self.early.iterator()]
        for _, piece, ends, _ in sorted(row for block in blocks for row in block):
            held += piece
            if held and ends and not self.whole:
                out.append(held)
                held = ""
        yield from self._end(key, emit_no, out + [held] * bool(held))

    def _end(self, key, emit_no: int, out: list[str]) -> Iterator[pd.DataFrame]:
        self.open.clear()
        self.early.clear()
        self._drop_timers()
        self.ended.update((True,))
        yield from self._rows(key, emit_no, out)

    def _drop_timers(self) -> None:
        if self.timeout_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)

    def _rows(self, key, emit_no: int, out: list[str]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(
                {"seq_id": key[0], "emit_no": range(emit_no, emit_no + len(out)), "text": out})


def _assembled(
    flagged: DataFrame, whole: bool, timeout_ms: int | None, remembered_ms: int | None
) -> DataFrame:
    keep_state_in_rocksdb(flagged.sparkSession)
    # With a clock Spark runs batches without data for ever, also where the input ends.
    clock = timeout_ms is not None or remembered_ms is not None
    return flagged.groupBy("seq_id").transformWithStateInPandas(
        statefulProcessor=Assembler(whole, timeout_ms, remembered_ms), outputStructType=OUTPUT,
        outputMode="Append", timeMode="ProcessingTime" if clock else "None",
    )


def assemble_text_stream(
    pieces: DataFrame, timeout_ms: int | None = None, remembered_ms: int | None = None
) -> DataFrame:
    """``(seq_id, emit_no, text)`` from a stream ``(seq_id, pos, piece, is_last)``.

    Equals ``assemble_text`` of the same pieces whatever the micro-batches are.
    Positions count from 0; a piece that arrives early waits in the state, one that
    was seen before is dropped. The row with ``is_last`` releases the rest and ends
    the sequence; with ``timeout_ms`` so does that time without input, pieces that wait
    included. Pieces of a sequence that come again after its end give nothing; with
    ``remembered_ms`` its end is forgotten after that time, and nothing of it is left. The
    two times are for streams that run on: with ``availableNow`` such a query does not end.
    State is kept in RocksDB.
    """
    flagged = pieces.select(
        "seq_id", "pos", F.coalesce("piece", F.lit("")).alias("piece"),
        F.coalesce(F.col("piece").rlike(ALPHANUMERIC_END), F.lit(False)).alias("ends"),
        F.coalesce("is_last", F.lit(False)).alias("is_last"),
    )
    return _assembled(flagged, False, timeout_ms, remembered_ms)


def stream_deltas_stream(
    chunks: DataFrame, timeout_ms: int | None = None, remembered_ms: int | None = None
) -> DataFrame:
    """``(seq_id, text)`` from a stream ``(seq_id, pos, body)``: each answer when it is whole.

    Equals ``stream_deltas`` of the same chunks whatever the micro-batches are: the text of
    the first choice, in the order of positions from 0. The chunk that names a reason to
    finish, or the end mark of the protocol, ends an answer; with ``timeout_ms`` so does
    that time without input.
    """
    flagged = chunks.select(
        "seq_id", "pos", F.coalesce(delta_text("body"), F.lit("")).alias("piece"),
        F.lit(False).alias("ends"), answer_ends("body").alias("is_last"),
    )
    return _assembled(flagged, True, timeout_ms, remembered_ms).select("seq_id", "text")
