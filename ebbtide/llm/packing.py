"""Best-fit decreasing packing of token pieces into sequences of bounded length.

Best fit looks at lengths alone, and there are at most ``capacity`` different ones. So
the corpus is reduced to a histogram of piece lengths (one row per length), the packing is
computed on that histogram for all pieces of a length at once, and each piece then finds
its place by its number among the pieces of its length. The plan is the same as that of
placing the pieces one by one; its size depends on ``capacity`` and not on the corpus.

Results: null text counts as empty (only the end id); a document of just the end id is one
piece of length 1; rows that repeat a doc_id are packed as separate documents; columns
other than the key and the text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import encoder, read_text, stored

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"
#: Largest plan that is sent to every executor as a broadcast; a larger one is joined by shuffle.
BROADCAST_PLACES = 100_000


class FirstAtLeast:
    """Segment tree over the capacities 0..size: the smallest marked one that is large enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.marked = [False] * (2 * self.leaves)

    def mark(self, at: int, value: bool) -> None:
        at += self.leaves
        self.marked[at] = value
        while at > 1:
            at >>= 1
            self.marked[at] = self.marked[2 * at] or self.marked[2 * at + 1]

    def find(self, least: int) -> int | None:
        """The smallest marked capacity of ``least`` or more, in logarithmic time."""
        at = least + self.leaves
        if self.marked[at]:
            return least
        while at > 1:  # climb until a subtree to the right has a mark
            if at % 2 == 0 and self.marked[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.marked[2 * at] else 2 * at + 1
        return at - self.leaves


class Place(NamedTuple):
    """Pieces ``low <= number < high`` of a length: ``each`` of them per sequence, from ``offset``."""

    length: int
    low: int
    high: int
    each: int
    sequence: int
    offset: int


class _Bins(NamedTuple):
    """Sequences ``first .. first + count - 1``, all with the same room left."""

    first: int
    count: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[Place], int]:
    """Places for ``counts[length]`` pieces of each length, and the number of sequences.

    Longest first; every piece goes to the open sequence with the least room that still
    holds it, else to a new one. A sequence that has just taken a piece has less room than
    any other that fits, so it goes on taking pieces of that length until it is too full:
    whole runs of sequences with equal room are filled in one step.
    """
    room: dict[int, deque[_Bins]] = {}
    tree = FirstAtLeast(capacity)
    places: list[Place] = []
    sequences = 0

    def put(left: int, bins: _Bins) -> None:
        if bins.count and left:
            if not room.get(left):
                room[left] = deque()
                tree.mark(left, True)
            room[left].append(bins)

    def take(left: int, most: int) -> _Bins:
        first, count = room[left].popleft()
        if count > most:
            room[left].appendleft(_Bins(first + most, count - most))
        elif not room[left]:
            tree.mark(left, False)
        return _Bins(first, min(count, most))

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            left = tree.find(length)
            each = (capacity if left is None else left) // length
            wanted = -(-(total - done) // each)
            if left is None:
                left, bins = capacity, _Bins(sequences, wanted)
                sequences += wanted
            else:
                bins = take(left, wanted)
            n = min(total - done, bins.count * each)
            places.append(Place(length, done, done + n, each, bins.first, capacity - left))
            full, rest = divmod(n, each)
            put(left - each * length, _Bins(bins.first, full))
            if rest:
                put(left - rest * length, _Bins(bins.first + full, 1))
            done += n
    return places, sequences


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones, the first possibly shorter."""
    full, first = divmod(n, capacity)
    return [first] * bool(first) + [capacity] * full


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, chunks: str = "spaced",
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Token pieces of every document, with their number among their task's pieces of that length."""
    spec = read_text(tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec, chunks)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: dict[str, list] = {k.split()[0]: [] for k in PIECES.split(", ")}
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, raw in zip(keys, own.encode([x or "" for x in texts]), strict=True):
                ids = np.append(np.frombuffer(raw, own.dtype).astype("<u4"), np.uint32(end_id))
                start = 0
                for i, n in enumerate(cut_lengths(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + n].astype("<u4").tobytes())
                    for k, v in zip(rows, (doc, i, start, n, crc, part, int(seen[n])), strict=True):
                        rows[k].append(v)
                    seen[n] += 1
                    start += n
            yield pa.RecordBatch.from_pydict(rows, schema=PIECE_SCHEMA)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, PIECES)


PIECE_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()),
])


def pack(found: DataFrame, capacity: int) -> DataFrame:
    """``sequence_id`` and ``offset`` for rows that have ``length``, ``part`` and ``nth``.

    ``found`` is read twice and must give the same rows each time (see ``stored``). Numbers
    are global per length: a task's count plus those of the tasks before it, so no length,
    however common, is numbered in one task. At most ``capacity`` rows reach the driver.
    """
    spark = found.sparkSession
    per_task = found.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select(
        "length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    per_task = stored(per_task, "lengths")
    counts = {
        r["length"]: r["n"]
        for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # <= capacity rows
    }
    places, _ = best_fit_decreasing(counts, capacity)
    schema = pa.schema([(k, pa.int32() if k == "length" else pa.int64()) for k in Place._fields])
    plan = spark.createDataFrame(
        pa.Table.from_pylist([p._asdict() for p in places], schema=schema).rename_columns(
            ["length", "low", "high", "each", "first_sequence", "first_offset"])
    )
    if len(places) <= BROADCAST_PLACES:
        plan = F.broadcast(plan)
    number = F.col("earlier") + F.col("nth")
    numbered = found.join(per_task.drop("n"), ["length", "part"]).withColumn("number", number)
    step = F.col("number") - F.col("low")
    return (
        numbered.join(plan, ["length"])
        .where((F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")))
        .withColumn("sequence_id", F.col("first_sequence") + F.expr("(number - low) div each"))
        .withColumn("offset", F.col("first_offset") + step % F.col("each") * F.col("length"))
    )


def packed_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, chunks: str = "spaced",
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    found = stored(pieces(docs, tokenizer_path, end_id, capacity, chunks, text, key), "pieces")
    return pack(found, capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "sequence_id", "offset",
    )
