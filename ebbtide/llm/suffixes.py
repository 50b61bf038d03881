"""Exact removal of repeated byte strings by distributed suffix sorting.

A byte goes if a string of ``width`` bytes covers it that also starts earlier: in a document
with a smaller key, or earlier in the same one. Strings are judged on the input.

1. Windows of ``width`` bytes are dealt out by their anchor (see ``anchors``), as runs of
   windows with the same anchor: equal windows meet, and nothing else needs to. Of equal runs
   all but the earliest are repeats; a task drops its own repeats before the shuffle, so
   however often a passage occurs, a task sends it once.
2. Different runs with the same anchor string may still share windows. Their bytes are
   fetched and dealt to shards of about ``SHARD_BYTES``. In a shard, runs are left out that no
   other run can share a window with (windows of neighbouring offsets have 83 bytes in
   common); the suffixes of the rest are sorted by external induced sorting (``induced``),
   and neighbours with a common prefix of ``width`` bytes are equal windows: all but the
   earliest repeat.
3. Anchor strings with more than ``CROWD`` different runs would make a shard too large. Their
   windows are compared one by one through their hashes, spread evenly.
4. Repeats return to their documents.

Results: null text is empty; null keys come before all others; rows that repeat a key and a
text are one document and get the same result; rows of one key with different texts are
different documents, in the order of a hash of the text; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import anchors
from ebbtide.llm.common import stored
from ebbtide.llm.induced import shared_prefix_at_least, suffix_order

#: Bytes of text whose windows are looked at together.
SLICE = 1 << 20
#: Runs of a task that are compared before they are sent.
LOCAL_RUNS = 1 << 20
SHARD_BYTES = 1 << 20
#: Most different runs of one anchor string in a shard.
CROWD = 4096
#: Offsets of the anchor that are looked at together when runs are left out.
STEP = 17
NO_KEY = -(2**63)

REPEAT, RUN = 1, 2
ROWS = "kind int, h long, c long, doc long, p long"
FLAGGED = "doc long, p long"
#: A place is a text hash of 25 bits, the first byte (31 bits) and the number of windows (7 bits).
_START_BITS, _COUNT_BITS = 31, 7


def _pack(version: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (version << (_START_BITS + _COUNT_BITS)) | (start << _COUNT_BITS) | count


def _unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Version, first byte, number of windows."""
    return p >> (_START_BITS + _COUNT_BITS), p >> _COUNT_BITS & ((1 << _START_BITS) - 1), p & ((1 << _COUNT_BITS) - 1)


def _version(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << 25)).cast("long")


def _documents(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``doc``, ``version`` and ``raw`` bytes of every row."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), _version(value).alias("version"),
        F.encode(value, "UTF-8").alias("raw"),
    )


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _joined(doc: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flagged runs, those that follow each other in a document made one (of up to 127 windows)."""
    order = np.lexsort((p, doc))
    doc, p = doc[order], p[order]
    version, start, count = _unpack(p)
    if not len(p):
        return doc, p
    follows = np.zeros(len(p), bool)
    follows[1:] = (doc[1:] == doc[:-1]) & (version[1:] == version[:-1]) & (start[1:] == start[:-1] + count[:-1])
    group = np.cumsum(~follows)
    before = np.cumsum(count) - count
    part = (before - before[np.flatnonzero(~follows)][group - 1]) >> (_COUNT_BITS - 2)  # 31 windows and one run more at most
    new = ~follows
    new[1:] |= part[1:] != part[:-1]
    first = np.flatnonzero(new)
    return doc[first], _pack(version[first], start[first], np.add.reduceat(count, first))


def _window_runs(documents: DataFrame, width: int) -> DataFrame:
    """Runs to compare (``RUN``) and repeats seen within a task (``REPEAT``)."""

    def local(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, p, h, c = (np.concatenate([x[i] for x in parts]) for i in range(4))
        order = np.lexsort((p, doc, c, h))
        doc, p, h, c = doc[order], p[order], h[order], c[order]
        same = np.zeros(len(doc), bool)
        same[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
        again = same.copy()  # the same row twice, not a repeat
        again[1:] &= (doc[1:] == doc[:-1]) & (p[1:] == p[:-1])
        repeat_doc, repeat_p = _joined(doc[same & ~again], p[same & ~again])
        n = len(repeat_doc)
        spread = (repeat_doc * np.int64(0x1E3779B97F4A7C15)) ^ repeat_p
        doc, p, h, c = doc[~same], p[~same], h[~same].view(np.int64), c[~same].view(np.int64)
        kinds = np.concatenate([np.full(n, REPEAT, np.int32), np.full(len(doc), RUN, np.int32)])
        columns = {
            "kind": kinds, "h": np.concatenate([spread, h]), "c": np.concatenate([np.zeros(n, np.int64), c]),
            "doc": np.concatenate([repeat_doc, doc]), "p": np.concatenate([repeat_p, p]),
        }
        for i in range(0, len(kinds), 1 << 16):
            yield _batch(**{k: v[i:i + (1 << 16)] for k, v in columns.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        n = 0
        for batch in batches:
            keys, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raws = [x.as_py() for x in batch.column(2)]
            at = 0
            while at < len(raws):
                end, size = at, 0
                while end < len(raws) and (end == at or size + len(raws[end]) <= SLICE):
                    size += len(raws[end])
                    end += 1
                ends = np.cumsum([len(x) for x in raws[at:end]])
                text = np.frombuffer(b"".join(raws[at:end]), np.uint8)
                which, first, count, h, c = anchors.runs(text, ends, width)
                start = first - np.concatenate([[0], ends])[which]
                found.append((keys[at:end][which], _pack(versions[at:end][which], start, count), h, c))
                n += len(which)
                at = end
                if n > LOCAL_RUNS:
                    yield from local(found)
                    found, n = [], 0
        if n:
            yield from local(found)

    return documents.mapInArrow(run, ROWS)


def _compared(runs: DataFrame) -> DataFrame:
    """Repeats, and the earliest of each different run whose anchor string has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row seen, and whether the run before it had its anchor string
        kept: list[np.ndarray] | None = None
        beside = False
        for batch in batches:
            kind, h, c, doc, p = (batch.column(i).to_numpy() for i in range(5))
            repeat = kind == REPEAT
            if repeat.any():
                yield _batch(kind=kind[repeat], h=h[repeat], c=c[repeat], doc=doc[repeat], p=p[repeat])
                h, c, doc, p = h[~repeat], c[~repeat], doc[~repeat], p[~repeat]
            if not len(h):
                continue
            row = np.stack([h, c, doc, p])
            before = np.concatenate([row[:, :1] if last is None else last, row[:, :-1]], axis=1)
            same = (row[:2] == before[:2]).all(axis=0)
            again = same & (row[2:] == before[2:]).all(axis=0)
            if last is None:
                same[0] = again[0] = False
            flagged = same & ~again
            last = row[:, -1:]
            if flagged.any():
                fd, fp = _joined(doc[flagged], p[flagged])
                yield _batch(kind=np.full(len(fd), REPEAT, np.int32), h=np.zeros_like(fd), c=np.zeros_like(fd), doc=fd, p=fp)
            reps = row[:, ~same]
            if kept is not None:
                reps = np.concatenate([kept, reps], axis=1)
            like = reps[0, 1:] == reps[0, :-1]
            several = np.zeros(reps.shape[1], bool)
            several[1:] |= like
            several[:-1] |= like
            if reps.shape[1]:
                several[0] |= beside
                beside = bool(several[-1]) if reps.shape[1] == 1 else bool(like[-1])
                kept = reps[:, -1:]
                out = reps[:, :-1][:, several[:-1]]
                if out.shape[1]:
                    yield _batch(kind=np.full(out.shape[1], RUN, np.int32), h=out[0], c=out[1], doc=out[2], p=out[3])
        if kept is not None and beside:
            yield _batch(kind=np.full(1, RUN, np.int32), h=kept[0], c=kept[1], doc=kept[2], p=kept[3])

    return runs.repartition("h").sortWithinPartitions("h", "c", "doc", "p").mapInArrow(run, ROWS)


def repeated_in_shard(h: np.ndarray, doc: np.ndarray, p: np.ndarray, raws: list[bytes], width: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Flagged windows of one shard's runs: those equal to an earlier window of the shard."""
    version, start, count = _unpack(p)
    sizes = np.array([len(r) for r in raws])
    text = np.frombuffer(b"".join(raws), np.uint8)
    base = np.cumsum(sizes) - sizes
    # Anchors again, to group windows by their offset from the anchor.
    anchor = base + _anchor_offsets(text, base, count, width)
    alive = np.zeros(int(count.sum()), bool)
    run_of = np.repeat(np.arange(len(p)), count)
    window = np.repeat(base, count) + np.arange(len(run_of)) - np.repeat(np.cumsum(count) - count, count)
    offset = anchor[run_of] - window
    for j in range(width // STEP + 1):
        low = anchor - STEP * j
        own = (low >= base) & (low + width - STEP <= base + sizes)
        rows = np.flatnonzero(own)
        if not len(rows):
            continue
        key = anchors.range_hashes(text, low[rows], low[rows] + width - STEP) ^ h[rows].view(np.uint64)
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        shared = np.zeros(len(p), bool)
        shared[rows] = n[inverse] > 1
        alive |= shared[run_of] & (offset >= STEP * j) & (offset < STEP * (j + 1))
    if not alive.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The text of the windows that are left, stretch by stretch, each after a separator.
    at = np.flatnonzero(alive)
    new = np.ones(len(at), bool)
    new[1:] = (run_of[at[1:]] != run_of[at[:-1]]) | (window[at[1:]] != window[at[:-1]] + 1)
    first = np.flatnonzero(new)
    low, high = window[at[first]], window[at[np.append(first[1:], len(at)) - 1]] + width
    length = high - low + 1
    where = np.cumsum(length) - length
    chars = np.ones(int(length.sum()) + 1, np.int64)
    chars[-1] = 0
    inner = np.repeat(low - where, length) + np.arange(int(length.sum()))
    mark = np.ones(int(length.sum()), bool)
    mark[where + length - 1] = False
    chars[:-1][mark] = text[inner[mark]].astype(np.int64) + 2
    place = np.repeat(where, np.diff(np.append(first, len(at)))) + window[at] - np.repeat(low, np.diff(np.append(first, len(at))))
    number = np.full(len(chars), -1, np.int64)
    number[place] = at
    order = suffix_order(chars, folder)
    order = order[number[order] >= 0]
    equal = shared_prefix_at_least(chars, order[:-1], order[1:], width)
    group = np.concatenate([[0], np.cumsum(~equal)])
    who = number[order]
    run = run_of[who]
    begin = start[run] + window[who] - base[run]
    sort = np.lexsort((begin, version[run], doc[run], group))
    later = np.zeros(len(sort), bool)
    later[1:] = group[sort][1:] == group[sort][:-1]
    pick = sort[later]
    return _joined(doc[run[pick]], _pack(version[run[pick]], begin[pick], np.ones(len(pick), np.int64)))


def _anchor_offsets(text: np.ndarray, base: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Per run the anchor's distance from the run's first byte: the anchor of its first window."""
    grams = anchors.gram_hashes(text) >> np.uint64(32)
    span = width - anchors.GRAM + 1
    index = base[:, None] + np.arange(span)
    out = np.empty(len(base), np.int64)
    for i in range(0, len(base), 4096):
        out[i:i + 4096] = grams[index[i:i + 4096]].argmin(axis=1)
    return out


def _cut_out(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the runs that ``wanted`` lists per document."""
    schema = "h long, doc long, p long, raw binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc, raw, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = raw.as_py()
                for r in runs:
                    piece = data[r["start"]:r["start"] + r["size"]]
                    rows.append((r["h"], doc, r["p"], piece))
                    size += len(piece)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["h", "doc", "p", "raw"])
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["h", "doc", "p", "raw"])

    return documents.join(wanted, ["doc", "version"]).select("doc", "raw", "runs").mapInArrow(cut, schema)


def _flagged_windows(pieces: DataFrame, width: int, salts: int = 64) -> DataFrame:
    """Repeated windows of crowded anchor strings, by two hashes of each window.

    The earliest per hash and salt is found first, then the earliest of those. Rows that
    repeat a document have equal places and so equal ranks.
    """
    schema = "one long, two long, doc long, p long"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, p = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            version, start, count = _unpack(p)
            raws = [x.as_py() for x in batch.column(3)]
            for i in range(0, len(raws), 2048):
                sizes = np.array([len(r) for r in raws[i:i + 2048]])
                text = np.frombuffer(b"".join(raws[i:i + 2048]), np.uint8)
                n = count[i:i + 2048]
                of = np.repeat(np.arange(len(n)), n)
                within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                at = (np.cumsum(sizes) - sizes)[of] + within
                grams = anchors.gram_hashes(text)
                two = grams[at] * np.uint64(3) ^ grams[at + width - anchors.GRAM]
                yield _batch(
                    one=anchors.range_hashes(text, at, at + width).view(np.int64), two=two.view(np.int64), doc=doc[i:i + 2048][of],
                    p=_pack(version[i:i + 2048][of], start[i:i + 2048][of] + within, np.ones(len(of), np.int64)),
                )

    rows = pieces.mapInArrow(windows, schema).withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)))
    near = Window.partitionBy("one", "two", "salt").orderBy("doc", "p")
    far = Window.partitionBy("one", "two").orderBy("doc", "p")
    first = rows.withColumn("nth", F.rank().over(near))
    again = first.where("nth > 1").select("doc", "p")
    return again.unionAll(first.where("nth = 1").withColumn("n", F.rank().over(far)).where("n > 1").select("doc", "p"))


def repeats(documents: DataFrame, width: int) -> DataFrame:
    """Flagged windows as ``doc`` and packed place ``p`` (runs of windows)."""
    found = stored(_compared(_window_runs(documents, width)), "runs", partition_by="kind")
    runs = found.where(F.col("kind") == RUN).select("h", "doc", "p")
    sizes = stored(runs.groupBy("h").agg(F.count("*").alias("n")), "anchors")
    total = runs.agg(F.sum(F.expr("(p & 127) + 99"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))

    def pieces(crowded: bool) -> DataFrame:
        own = sizes.where(F.col("n") > CROWD) if crowded else sizes.where(F.col("n") <= CROWD)
        start = F.expr(f"shiftright(p, {_COUNT_BITS}) & {(1 << _START_BITS) - 1}L")
        run = F.struct("h", "p", start.alias("start"), (F.expr(f"p & {(1 << _COUNT_BITS) - 1}L") + F.lit(width - 1)).alias("size"))
        wanted = runs.join(own.select("h"), "h").groupBy(
            "doc", F.shiftright("p", _START_BITS + _COUNT_BITS).alias("version")).agg(F.collect_list(run).alias("runs"))
        return _cut_out(documents, wanted)

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["h", "doc", "p"])  # of rows that repeat a document
        with tempfile.TemporaryDirectory() as folder:  # of the task alone, and gone with it
            doc, p = repeated_in_shard(
                rows["h"].to_numpy(), rows["doc"].to_numpy(), rows["p"].to_numpy(), rows["raw"].tolist(), width, folder)
        return pd.DataFrame({"doc": doc, "p": p})

    normal = pieces(False).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
    sorted_out = normal.groupBy("shard").applyInPandas(shard, FLAGGED)
    return found.where(F.col("kind") == REPEAT).select("doc", "p").unionAll(sorted_out).unionAll(
        _flagged_windows(pieces(True), width))


def deduplicated(docs: DataFrame, width: int = 100, digests: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes (or their hash)."""
    if not anchors.GRAM + STEP < width <= anchors.GRAM + 95:
        raise ValueError("the width must leave room for anchors and fit a packed place")
    documents = _documents(docs, text, key)
    by_doc = repeats(documents, width).groupBy(
        "doc", F.shiftright("p", _START_BITS + _COUNT_BITS).alias("version")).agg(F.collect_list("p").alias("repeats"))
    last = ("kept_sha256", "string") if digests else ("kept", "binary")
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {last[0]} {last[1]}"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, raw, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data, spans = raw.as_py(), []
                if runs.is_valid:
                    _, start, count = _unpack(np.sort(runs.values.to_numpy()))
                    for a, b in zip(start.tolist(), (start + count + width - 1).tolist(), strict=True):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(b, spans[-1][1])
                        else:
                            spans.append([a, b])
                parts, at = [], 0
                for a, b in spans:
                    parts.append(data[at:a])
                    at = b
                kept = b"".join([*parts, data[at:]])
                out.append((
                    None if doc == NO_KEY else doc, len(data), len(data) - len(kept), len(spans),
                    hashlib.sha256(kept).hexdigest() if digests else kept,
                ))
            kinds = [pa.int64()] * 4 + [pa.string() if digests else pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", last[0]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(5)], names=names)

    return documents.join(by_doc, ["doc", "version"], "left").select("doc", "raw", "repeats").mapInArrow(remove, schema)
