"""SimHash near-duplicates, found through Golay-code fuzzy keys.

A fingerprint's bit is 1 if more than half of the document's shingle hashes have it set.
Fingerprints link if they differ in at most two bits. Candidates come from keys:

* A 64-bit fingerprint is cut into three segments of at most 23 bits. Two errors leave at
  least one segment without an error, so two linked fingerprints agree there exactly, while
  every other segment has at most two errors.
* The binary Golay code is perfect: each 23-bit word lies within 3 bits of one codeword. A
  word's indices are those of the codewords within 4 bits of it: one codeword if the nearest
  is within 2 bits, else the nearest and five at distance 4. Words that differ in at most
  two bits always share one of these indices.
* A key is an exact segment with an index of the next segment. Equal keys are joined and
  the pairs verified.

A key that more than ``SMALL`` fingerprints share is not paired off. Its fingerprints are
grouped instead by the values within one bit of them: two fingerprints share such a value
exactly if they differ in at most two bits, and at most 65 can share one. So every link is
found whatever the size of a group, and no group is paired without bound.

Results: null or empty text has fingerprint zero, which links like any other; a null key
takes part but cannot name a component (null if a component has no other); rows that repeat
a key get one row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import stored
from ebbtide.llm.components import components

#: Generator polynomial of the binary Golay code [23, 12, 7]: a fixed value.
GENERATOR = 0b101011100011
#: Most fingerprints under one key that are compared pair by pair.
SMALL = 48
#: First bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


# The code ------------------------------------------------------------------------------

def remainders(words: np.ndarray) -> np.ndarray:
    """The 11-bit remainder of 23-bit words divided by the generator polynomial."""
    left = np.asarray(words, np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


def error_patterns() -> np.ndarray:
    """Per remainder the error patterns to codewords within 4 bits: one of them, or six (-1: none)."""
    bits = 1 << np.arange(23, dtype=np.int64)
    by_weight = [np.zeros(1, np.int64)]
    for _ in range(4):  # patterns of one bit more: a higher bit is added to each
        last = by_weight[-1]
        by_weight.append(np.concatenate([last[last < b] | b for b in bits]))
    near = np.full(2048, -1, np.int64)
    weight = np.zeros(2048, np.int64)
    for w in range(4):
        near[remainders(by_weight[w])] = by_weight[w]
        weight[remainders(by_weight[w])] = w
    out = np.full((2048, 6), -1, np.int64)
    out[:, 0] = near
    filled = np.ones(2048, np.int64)
    for pattern, r in zip(by_weight[4].tolist(), remainders(by_weight[4]).tolist(), strict=True):
        if weight[r] == 3:
            out[r, filled[r]] = pattern
            filled[r] += 1
    return out


def golay_indices(words: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Per 23-bit word the 12-bit indices of the codewords within 4 bits of it (-1: none)."""
    errors = patterns[remainders(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ np.maximum(errors, 0)) >> 11)


def keys(fingerprints: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """18 keys per unsigned 64-bit fingerprint; -1 where there are fewer."""
    parts = [(fingerprints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    out = []
    for i, exact in enumerate(parts):
        index = golay_indices(parts[(i + 1) % 3], patterns)
        out.append(np.where(index < 0, -1, (i << 40) | (exact[:, None] << 12) | index))
    return np.concatenate(out, axis=1)


# Fingerprints --------------------------------------------------------------------------

def simhash(text: str, words: int) -> int:
    """The fingerprint of one text, from shingles of ``words`` words."""
    import xxhash

    found = text.encode().lower().split()  # A-Z and ASCII white space alone
    if not found:
        return 0
    shingles = zip(*(found[i:] for i in range(words)), strict=False) if len(found) >= words else [found]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(x), 42) for x in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id", tagged: bool = False) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) per row; with ``tagged`` a ``tag`` of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([simhash(x or "", words) for x in batch.column(1).to_pylist()], np.uint64)
            rest = [batch.column(2)] if tagged else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made.view(np.int64)), *rest], names=["doc_id", "fp", "tag"][:2 + tagged])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if tagged:
        rows = rows.withColumn("tag", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, fp long" + ", tag long" * tagged)


# Links ---------------------------------------------------------------------------------

def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v) between the different fingerprints ``fp`` that connect all linked ones."""
    patterns = error_patterns()

    @F.pandas_udf("array<long>")
    def all_keys(fp: pd.Series) -> pd.Series:
        found = keys(fp.to_numpy("int64").view("uint64"), patterns)
        return pd.Series([row[row >= 0] for row in found])

    keyed = stored(distinct.select("fp", F.explode(all_keys("fp")).alias("key")), "keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    small = keyed.join(sizes.where(F.col("n") <= SMALL).select("key"), "key")
    groups = small.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # SMALL at most
    pairs = F.flatten(F.transform("fps", lambda a, i: F.transform(
        F.filter(F.slice("fps", i + 2, F.lit(SMALL)), lambda b: F.bit_count(a.bitwiseXOR(b)) <= 2),
        lambda b: F.struct(a.alias("u"), b.alias("v")),
    )))
    near = groups.select(F.explode(pairs).alias("e")).select("e.u", "e.v")

    crowded = keyed.join(sizes.where(F.col("n") > SMALL).select("key"), "key").select("fp").distinct()
    flips = F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))
    ))
    shared = (
        crowded.select("fp", F.explode(flips).alias("value"))
        .groupBy("value").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # 65 at most
        .where(F.size("fps") > 1)
        .select(F.col("fps")[0].alias("u"), F.explode(F.slice("fps", 2, 65)).alias("v"))
    )
    return near.unionAll(shared)


def components_of(made: DataFrame) -> DataFrame:
    """``fp`` and ``component`` of every distinct fingerprint."""
    distinct = made.select("fp").distinct()
    labels = components(links(distinct))
    return distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` (the smallest key reachable) per row."""
    made = stored(fingerprints(docs, words, text, key), "fingerprints")
    distinct = made.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = components(links(distinct.select("fp")))
    named = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id")
    return made.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` per component: that with the smallest key, a row without a key last.

    Rows that repeat a key go by their own texts. Of rows equal in key and text one stays.
    """
    made = stored(fingerprints(docs, words, text, key, tagged=True), "fingerprints")
    by_fp = components_of(made)
    least = made.join(by_fp, "fp").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first"), F.count("*").alias("n"))
    kept = stored(least.select(F.col("first.doc_id").alias("__key"), F.col("first.tag").alias("__tag")), "kept")
    own = docs.withColumn("__own", F.xxhash64(F.col(text).cast("string")))
    same = F.col(key).cast("long").eqNullSafe(F.col("__key")) & (F.col("__own") == F.col("__tag"))
    # Rows that are equal in key and text are told apart by nothing but their number.
    twice = made.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("__key"), F.col("tag").alias("__tag"))
    twice = stored(twice, "repeated")
    out = own.join(kept, same, "left_semi")
    if twice.isEmpty():
        return out.drop("__own")
    once = out.join(twice, same, "left_anti")
    repeated = out.join(twice, same, "left_semi").dropDuplicates([key, "__own"])
    return once.unionAll(repeated).drop("__own")
