"""Token ids as raw binary shards, with a minimal perfect hash index for keyed access.

Files, all under one folder on shared storage:

* ``ids/shard-<number>-<attempt>.bin``: one per range of keys, documents in ascending key
  order (null first; equal keys by the hash of their text). Little-endian: the magic bytes,
  the bytes per id (2 or 4, as the vocabulary needs), the number of documents, the number of
  ids; then the ids of all documents one after another, each ending in the end id; then
  where each document ends, as 64-bit counts of ids.
* ``shards``: one Parquet row per shard with its file and the ids before it.
* ``index``: one Parquet row per bucket of keys (a hash of the key), each with a minimal
  perfect hash of its keys.

A look-up hashes the key to its bucket and there to its slot, compares the stored
fingerprint, and reads the run of documents the slot names: constant time at any size.

Results: null or empty text is a document of the end id alone; a null key is a key; rows
that repeat a key are separate documents found together under that key; a key that was not
stored gives no row. An empty table gives a store without shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import dropped, encoder, new_folder, read_text, stored

MAGIC = b"EBBTOK1\0"
HEAD = "<8sI"
HEAD_BYTES = struct.calcsize(HEAD)
#: Keys of one index bucket on average: its hash takes about a megabyte.
BUCKET_KEYS = 32_768
#: Places per key at each level of the hash; more levels are needed with fewer places.
GAMMA = 1.5
#: Bytes read from a shard at once.
BLOCK = 8 << 20

WRITTEN = "shard int, file string, doc_id long, nth long, first_id long, n_ids long"
INDEX = (
    "bucket int, n_keys long, sizes array<long>, bits binary, prints binary, starts binary,"
    " shards binary, offsets binary, nths binary, counts binary"
)
FOUND = "doc_id long, shard int, id_offset long, first_doc long, n_docs long"


# Minimal perfect hash ------------------------------------------------------------------

def _mix(one: np.ndarray, two: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key's two hashes, another for each level."""
    x = one + (two | np.uint64(1)) * np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(one: np.ndarray, two: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and marks: at each level, keys alone at their place get a mark there.

    The others go on to the next level. A key's slot is the number of marks before its own,
    so slots are 0 .. n - 1 without gaps. ``one`` and ``two`` are unsigned 64-bit hashes of
    distinct keys.
    """
    sizes, marks = [], []
    left = np.arange(len(one))
    while len(left):
        if len(sizes) == 200:
            raise ValueError("two keys have the same 128-bit hash")
        size = max(64, int(GAMMA * len(left)))
        at = (_mix(one[left], two[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        marks.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(marks) if marks else np.zeros(0, bool)


def slots(sizes: list[int], marks: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Each key's slot; -1 for a key that no level marks (it is not in the set)."""
    rank = np.cumsum(marks) - 1
    out = np.full(len(one), -1, dtype=np.int64)
    left, base = np.arange(len(one)), 0
    for level, size in enumerate(sizes):
        at = base + (_mix(one[left], two[left], level) % np.uint64(size)).astype(np.int64)
        hit = marks[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def fingerprints(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """32 bits of each key, independent of the levels' places."""
    return (_mix(two, one, 1 << 20) >> np.uint64(32)).astype("<u4")


def _hashes(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return (frame["k1"].to_numpy("int64").view("uint64"), frame["k2"].to_numpy("int64").view("uint64"))


def with_hashes(df: DataFrame, buckets: int, key: str = "doc_id") -> DataFrame:
    """The key's two hashes and its bucket."""
    flag = F.col(key).isNull()
    return df.withColumns({
        "k1": F.xxhash64(F.col(key), flag), "k2": F.xxhash64(flag, F.col(key), F.lit("second")),
    }).withColumn("bucket", F.pmod(F.xxhash64("k1", "k2"), F.lit(buckets)).cast("int"))


# Writing -------------------------------------------------------------------------------

@dataclass
class TokenStore:
    """A written store; ``width`` is the number of bytes per id."""

    spark: SparkSession
    folder: str
    width: int
    buckets: int
    shards: DataFrame
    index: DataFrame
    documents: DataFrame

    def remove(self) -> None:
        """Delete all files of the store."""
        dropped(self.shards, self.index, self.documents)
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.folder)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def write(
    docs: DataFrame, tokenizer_path: str, end_id: int, chunks: str = "words",
    text: str = "text", key: str = "doc_id",
) -> TokenStore:
    """Tokenize ``docs`` and write shards and index; as many shards as shuffle partitions."""
    spark = docs.sparkSession
    spec = read_text(tokenizer_path)
    folder = new_folder(spark, "tokens")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec, chunks)
        task = TaskContext.get()
        name = f"shard-{task.partitionId():08d}-{task.taskAttemptId()}.bin"
        files, path = fs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        end = np.array([end_id], own.dtype).tobytes()
        out, ends, ids = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = files.open_output_stream(f"{path}/{name}", compression=None)
                out.write(struct.pack(HEAD, MAGIC, own.dtype.itemsize))
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            firsts, lengths = [], []
            for raw in own.encode([x or "" for x in texts]):
                out.write(raw)
                out.write(end)
                n = len(raw) // own.dtype.itemsize + 1
                firsts.append(ids)
                lengths.append(n)
                ids += n
                ends.append(ids)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array([task.partitionId()] * rows, pa.int32()), pa.array([name] * rows, pa.string()), keys,
                pa.array(range(len(ends) - rows, len(ends)), pa.int64()), pa.array(firsts, pa.int64()),
                pa.array(lengths, pa.int64()),
            ], names=[x.split()[0] for x in WRITTEN.split(", ")])
        if out is not None:
            out.write(np.asarray([*ends, len(ends)], "<i8").tobytes())
            out.close()

    ordered = (
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
    )
    documents = stored(ordered.mapInArrow(save, WRITTEN), "documents")
    width = encoder(spec, chunks).dtype.itemsize
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stored(
        documents.groupBy("shard", "file")
        .agg(F.count("*").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
        .withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0))),  # one row per shard
        "shards",
    )
    buckets = max(1, -(-documents.count() // BUCKET_KEYS))
    runs = documents.groupBy("doc_id", "shard").agg(
        F.min("first_id").alias("id_offset"), F.min("nth").alias("first_doc"), F.count("*").alias("n_docs")
    )
    index = stored(
        with_hashes(runs, buckets).groupBy("bucket").applyInPandas(_bucket_index, INDEX), "index"
    )
    return TokenStore(spark, folder, width, buckets, shards, index, documents)


def _bucket_index(runs: pd.DataFrame) -> pd.DataFrame:
    """The index row of one bucket; a key that shards split between them has several runs."""
    runs = runs.sort_values(["k1", "k2", "shard"], ignore_index=True)
    one, two = _hashes(runs)
    new = np.ones(len(runs), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    first = np.flatnonzero(new)
    sizes, marks = build_hash(one[first], two[first])
    slot = slots(sizes, marks, one[first], two[first])
    by_slot = np.argsort(slot)
    lengths = np.diff(np.append(first, len(runs)))[by_slot]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    order = np.repeat(first[by_slot] - starts[:-1], lengths) + np.arange(len(runs))
    prints = fingerprints(one[first], two[first])[by_slot]
    column = lambda name, kind: runs[name].to_numpy()[order].astype(kind).tobytes()
    return pd.DataFrame({
        "bucket": [int(runs["bucket"].iloc[0])], "n_keys": [len(first)], "sizes": [sizes],
        "bits": [np.packbits(marks).tobytes()], "prints": [prints.tobytes()],
        "starts": [starts.astype("<i8").tobytes()], "shards": [column("shard", "<i4")],
        "offsets": [column("id_offset", "<i8")], "nths": [column("first_doc", "<i8")],
        "counts": [column("n_docs", "<i8")],
    })


# Reading -------------------------------------------------------------------------------

def _look_up(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The runs of one bucket's keys."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    if not len(keys) or not len(index):
        return pd.DataFrame(columns=names)
    row = index.iloc[0]
    one, two = _hashes(keys)
    marks = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: int(sum(row["sizes"]))].astype(bool)
    slot = slots(list(row["sizes"]), marks, one, two)
    prints = np.frombuffer(row["prints"], "<u4")
    hit = slot >= 0
    hit[hit] = prints[slot[hit]] == fingerprints(one, two)[hit]
    starts = np.frombuffer(row["starts"], "<i8")
    lengths = starts[slot[hit] + 1] - starts[slot[hit]]
    run = np.repeat(starts[slot[hit]], lengths) + (
        np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    )
    column = lambda name, kind: np.frombuffer(row[name], kind)[run]
    return pd.DataFrame({
        "doc_id": keys["doc_id"].to_numpy()[np.flatnonzero(hit)].repeat(lengths),
        "shard": column("shards", "<i4"), "id_offset": column("offsets", "<i8"),
        "first_doc": column("nths", "<i8"), "n_docs": column("counts", "<i8"),
    })


def look_up(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Where the documents of each key lie: rows of shard, offset in ids, first document and count."""
    asked = with_hashes(keys.select(F.col("doc_id").cast("long")).distinct(), store.buckets)
    return (
        asked.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInPandas(_look_up, FOUND)
    )


def read(store: TokenStore, keys: DataFrame, digests: bool = False) -> DataFrame:
    """The stored documents of ``keys``: doc_id, start, n_tokens, and ids or their checksum.

    Keys are looked up in the index and each shard's documents are read from its file in
    the order in which they lie there, a block at a time.
    """
    folder, width = store.folder, store.width
    last = "ids_crc32 long" if digests else "ids array<long>"
    schema = f"doc_id long, start long, n_tokens long, {last}"

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = fs.FileSystem.from_uri(folder)
        opened, source, ends = None, None, None
        for rows in batches:
            out: list[tuple] = []
            for r in rows.itertuples(index=False):
                if r.file != opened:
                    if source is not None:
                        source.close()
                    source, opened = files.open_input_file(f"{path}/{r.file}"), r.file
                    source.seek(HEAD_BYTES + r.shard_ids * width)
                    ends = np.frombuffer(source.read(r.shard_docs * 8), "<i8")
                    block, block_at = b"", 0
                doc = None if pd.isna(r.doc_id) else int(r.doc_id)
                at = r.id_offset
                for end in ends[r.first_doc:r.first_doc + r.n_docs]:
                    low, high = at * width, int(end) * width
                    if low < block_at or high > block_at + len(block):
                        source.seek(HEAD_BYTES + low)
                        block_at, block = low, source.read(min(max(BLOCK, high - low), r.shard_ids * width - low))
                    raw = np.frombuffer(block[low - block_at:high - block_at], f"<u{width}")
                    value = zlib.crc32(raw.astype("<u4").tobytes()) if digests else raw.astype("int64")
                    out.append((doc, r.ids_before + at, len(raw), value))
                    at = int(end)
            yield pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")]).astype({"doc_id": "Int64"})
        if source is not None:
            source.close()

    about = store.shards.select(
        "shard", "file", "ids_before", F.col("n_ids").alias("shard_ids"), F.col("n_docs").alias("shard_docs")
    )
    runs = look_up(store, keys).join(about, "shard")
    return runs.repartition("shard").sortWithinPartitions("shard", "id_offset").mapInPandas(fetch, schema)
