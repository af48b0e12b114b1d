"""Best-fit packing planned on the histogram of lengths.

Every text becomes ids plus one closing id; only texts longer than a sequence are cut, into full sequences with the
remainder first.  Best-fit decreasing then runs over *counts by length* (at most ``capacity`` numbers, so the plan is
bounded by the capacity, not by the data): equal bins are kept as one run of sequence numbers.  The plan says which
ranks within a length go to which sequences at which offset, and every piece takes its slot by an equi-join on length
and its rank among the pieces of that length.  Ranks are counted in two steps (slots of at most a bounded number of
rows, then the totals of the slots before), so a length that holds a third of all pieces is not ranked in one task.

Null text counts as empty: one piece that holds the closing id alone.  Repeated rows are packed once each.  A null key
is kept as null.  An empty table gives no rows.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.bpe import encoder, texts_of
from quartermaster.llm.common import cut, map_batches, schema_of

#: Rows that one window task ranks, on average.
RANK_ROWS = 50_000
PIECES = schema_of(("doc_id", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()),
                   ("length", T.LongType()), ("ids_crc32", T.LongType()))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a text's pieces: the remainder first, then full sequences."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(df: DataFrame, path: str, capacity: int, closing_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of each text, with the crc32 of its ids as little-endian unsigned 32-bit integers."""
    end = struct.pack("<I", closing_id)

    def run(batch: pa.RecordBatch) -> dict:
        rows = []
        for doc, raw in zip(batch.column(key).to_pylist(), encoder(path, True).ids(texts_of(batch, text))):
            raw += end
            rows += [(doc, k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(cuts(len(raw) // 4, capacity))]
        return dict(zip(PIECES.names, zip(*rows))) if rows else {n: [] for n in PIECES.names}

    return map_batches(df.select(F.col(key).cast("long").alias(key), text), run, PIECES)


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, pieces, first sequence, pieces in a sequence, offset).

    Rank r of a row goes to sequence ``first sequence + (r - first rank) // q`` at ``offset + ((r - first rank) % q) *
    length``.  Sequences with the same free room are runs (first, number); the fullest that still has room is taken.
    """
    room: dict[int, deque] = {}  # free room -> runs of equal sequences
    rooms: list[int] = []        # those with a run, ascending
    plan, used = [], 0

    def put(free: int, first: int, n: int) -> None:
        if n and free:
            if not room.get(free):
                bisect.insort(rooms, free)
                room[free] = deque()
            room[free].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                free = rooms[i]
                first, n = room[free].popleft()
                if not room[free]:
                    rooms.pop(i)
            else:
                free, first = capacity, used
                n = -(-left // (capacity // length))
                used += n
            q = free // length  # a sequence that took one piece is the fullest with room for the next
            full = min(n, left // q)
            if full:
                plan.append((length, rank, full * q, first, q, capacity - free))
                put(free - q * length, first, full)
                left, rank = left - full * q, rank + full * q
            if left and full < n:
                plan.append((length, rank, left, first + full, left, capacity - free))
                put(free - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(free, first + full, n - full)
    return plan


PLAN = schema_of(*((n, T.LongType()) for n in ("length", "first_rank", "n", "first_sequence", "q", "base")))


def assign(pieces_df: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...); the frame is read several times, so it should
    be cut (checkpointed) by the caller."""
    spark: SparkSession = pieces_df.sparkSession
    rows = pieces_df.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in rows}
    plan = best_fit_plan(counts, capacity)
    slots = max(1, -(-sum(counts.values()) // RANK_ROWS))
    slotted = pieces_df.withColumn("_slot", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slots)))
    by_slot = slotted.groupBy("length", "_slot").agg(F.count("*").alias("_n"))
    before = by_slot.select("length", "_slot", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_slot")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_slot").orderBy("doc_id", "piece")) - 1
    ranked = slotted.withColumn("_within", within).join(before, ["length", "_slot"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_within"))
    plan_df = F.broadcast(spark.createDataFrame(plan, PLAN))  # bounded by the capacity
    rank, step = F.col("_rank"), F.col("_rank") - F.col("first_rank")
    slot_join = ranked.alias("r").join(
        plan_df.alias("p"), (F.col("r.length") == F.col("p.length")) & (rank >= F.col("first_rank"))
        & (rank < F.col("first_rank") + F.col("n")))
    return slot_join.select("r.*", (F.col("first_sequence") + F.floor(step / F.col("q"))).cast("long").alias("sequence_id"),
                            (F.col("base") + step % F.col("q") * F.col("r.length")).alias("offset")
                            ).drop("_slot", "_within", "_before", "_rank")


def pack(df: DataFrame, path: str, capacity: int = 1024, closing_id: int = 2, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every text."""
    done = cut(pieces(df, path, capacity, closing_id, key, text))
    return assign(done, capacity).select(*PIECES.names, "sequence_id", "offset")


def sequences_needed(counts: dict[int, int], capacity: int) -> int:
    """Sequences the plan opens."""
    rows = best_fit_plan(counts, capacity)
    return max((f + -(-n // q) for _, _, n, f, q, _ in rows), default=0)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences than the tokens fill."""
    return -(-int(np.sum([n * c for n, c in counts.items()])) // capacity) if counts else 0
