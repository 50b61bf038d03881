"""Alignment of two tokenizers' tokens by an associative monoid of fragments.

The tokens of A (byte-level BPE) and of B (sentence pieces) cover the same bytes; where both
have a token that ends, a group ends. A range of a text yields a :class:`Fragment`: the tokens
before its first common end (open prefix), closed groups, and the tokens after its last one
(open suffix). Two neighbouring fragments compose: suffix and prefix are put together and cut
at the common ends that appear. Composition is associative, so the fragments of a very long
text are reduced in a tree, by Spark tasks that hold ``FAN`` of them.

* A text over ``CHUNK_CHARS`` is cut into chunks, for A and for B where no token of that
  tokenizer crosses, which need not be the same place. Closed groups are written where they
  arise; only the open ends travel up the tree.
* Any other text is one fragment without open ends. It is cut where neither tokenizer's tokens
  cross, a word with the space before it, and each distinct such part is aligned once for a
  block of documents or taken from the worker's memory.

Counts of linked id pairs: a block of documents is summed up first, so what is shuffled is one
row per block and pair. The counts come back to the block the same way. Long texts have one row
per text and pair.

Results: one row per row of the input; texts that are null or empty, or that the tokens of A or
B do not spell, have zeros and an empty digest, and link nothing; rows that repeat a key, or
have none, are documents of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import ChunkEncoder, byte_letters, read_text, stored

#: Longer texts are cut into chunks of about this many characters.
CHUNK_CHARS = 1 << 16
#: Characters of texts whose pairs are counted together.
BLOCK_CHARS = 4_000_000
#: Fragments composed in one task of a round.
FAN = 16
#: Parts remembered by one Python worker.
MEMO = 300_000
#: Longer parts are aligned each time.
LONG_PART = 64
#: Unicode white space, as the byte-level pattern has it.
SPACE = "\t-\r \x85\xa0  -     　"
#: Places that no token of A crosses: a letter before an ASCII mark, the end of a word.
CUT_A = re.compile(rf"(?<=[A-Za-z])(?=[!-/:-@\[-`{{-~])|(?<=[^{SPACE}])(?=[{SPACE}])")
#: And of B, as its pieces have a space in front alone.
CUT_B = re.compile("(?<=[^ ])(?= )")


# Tokens --------------------------------------------------------------------------------

@dataclass
class Tokens:
    """Ids and the byte offsets where they end."""

    ids: np.ndarray
    ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))

    def part(self, start: int, end: int | None = None) -> Tokens:
        return Tokens(self.ids[start:end], self.ends[start:end])


NONE = Tokens(np.zeros(0, np.int64), np.zeros(0, np.int64))
Pair = tuple[Tokens, Tokens]


def cut(a: Tokens, b: Tokens) -> tuple[list[Pair], Pair]:
    """Groups up to the last common end, and the tokens after it."""
    common = np.intersect1d(a.ends, b.ends, assume_unique=True)
    ia = [0, *(np.searchsorted(a.ends, common) + 1).tolist()]
    ib = [0, *(np.searchsorted(b.ends, common) + 1).tolist()]
    groups = [(a.part(ia[i], ia[i + 1]), b.part(ib[i], ib[i + 1])) for i in range(len(common))]
    return groups, (a.part(ia[-1]), b.part(ib[-1]))


@dataclass
class Fragment:
    """Open prefix and open suffix of a range that begins with chunk ``start``.

    Without a common end (``closed`` false) all tokens are in the prefix.
    """

    start: int
    closed: bool
    prefix: Pair
    suffix: Pair
    spelled: bool = True

    @staticmethod
    def of(start: int, a: Tokens, b: Tokens, spelled: bool) -> tuple[Fragment, list[Pair]]:
        """The fragment of one chunk and its closed groups; a text begins with a common end."""
        groups, rest = cut(a, b)
        if start == 0:
            return Fragment(0, True, (NONE, NONE), rest, spelled), groups
        if not groups:
            return Fragment(start, False, rest, (NONE, NONE), spelled), []
        return Fragment(start, True, groups[0], rest, spelled), groups[1:]

    def then(self, other: Fragment) -> tuple[Fragment, list[Pair]]:
        """This range and the next as one, and the groups that this closes."""
        left = self.suffix if self.closed else self.prefix
        groups, rest = cut(left[0] + other.prefix[0], left[1] + other.prefix[1])
        suffix = other.suffix if other.closed else rest
        spelled = self.spelled and other.spelled
        if self.closed:
            return Fragment(self.start, True, self.prefix, suffix, spelled), groups
        if not groups:
            return Fragment(self.start, False, rest, (NONE, NONE), spelled), []
        return Fragment(self.start, True, groups[0], suffix, spelled), groups[1:]


class Aligner:
    """Both tokenizers and what they say about parts of texts."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.chunks = ChunkEncoder(spec_a, "spaced")
        self.a = self.chunks.tokenizer
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters.get(c, 63) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any("▁" in p.lstrip("▁") for p in plain):
            raise ValueError("pieces with a space after a letter have no cuts between words")
        # White space that some piece joins to a letter before it is no place to cut.
        joined = {c for p in plain for x, c in zip(p, p[1:], strict=False) if re.match(f"[{SPACE}]", c) and not re.match(f"[{SPACE}▁]", x)}
        glue = "[" + "".join(map(re.escape, sorted(joined))) + "]" if joined else "(?!)"
        self.parts = re.compile(rf"[{SPACE}]*[^{SPACE}]+(?:{glue}[{SPACE}]*[^{SPACE}]*)*|[{SPACE}]+").findall
        #: A link's code: this times A's id, plus B's id.
        self.width = len(pieces)
        if self.width * len(self.bytes_a) >= 1 << 32:
            raise ValueError("link codes need 32 bits")
        #: Ids as text with what follows them in a group: the next, or the group's other side or end.
        self.names_a, self.names_b = (
            np.array([[f"{i}," for i in range(n)], [f"{i}{end}" for i in range(n)]], object)
            for n, end in ((len(self.bytes_a), "|"), (len(pieces), ";")))
        self.memo: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        """B's ids of ranges of a text as they stand there, without a space put in front."""
        # The space that B puts in front stands for one that is there, or goes with a letter that no piece joins to white space.
        own = [x[1:] if x[0] == " " else "x" + x for x in texts]
        return [ids if x[0] == " " else ids[1:] for x, ids in zip(texts, self.b.encode(own, out_type=int, num_threads=1), strict=True)]

    def _spelled(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])

    def _records(self, parts: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple | None]:
        """Groups as text, link codes, and counts of each part; nothing if its tokens do not spell it.

        Parts stand side by side: a part's end is a common end, so all are cut at once.
        """
        raw = [p.encode() for p in parts]
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        whole = b"".join(raw)
        spell = lambda names, ids: b"".join([names[i] for i in ids.tolist()])
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        ends, ends_a, ends_b = np.cumsum([len(r) for r in raw]), np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        if not (n_a.all() and n_b.all() and np.array_equal(ends_a[np.cumsum(n_a) - 1], ends) and np.array_equal(ends_b[np.cumsum(n_b) - 1], ends)
                and spell(self.bytes_a, ids_a) == whole == spell(self.bytes_b, ids_b)):
            good = [i for i, (r, x, y) in enumerate(zip(raw, a, b, strict=True)) if self._spelled(r, x, y)]
            out: list[tuple | None] = [None] * len(parts)
            if good:
                for i, made in zip(good, self._records(*[[x[i] for i in good] for x in (parts, a, b)]), strict=True):
                    out[i] = made
            return out
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        many_a, many_b = np.bincount(group_a), np.bincount(group_b)
        from_a, from_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        # Each group's tokens of A, then those of B, with what follows each.
        at_a, at_b = np.arange(len(ids_a)), np.arange(len(ids_b))
        flat = np.empty(len(ids_a) + len(ids_b), object)
        flat[at_a + from_b[group_a]] = self.names_a[(at_a == (from_a + many_a - 1)[group_a]).astype(int), ids_a]
        flat[at_b + (from_a + many_a)[group_b]] = self.names_b[(at_b == (from_b + many_b - 1)[group_b]).astype(int), ids_b]
        # Links: every token of A with all of B in its group.
        times = many_b[group_a]
        upto = np.cumsum(times)
        other = np.repeat(from_b[group_a] - (upto - times), times) + np.arange(int(upto[-1]))
        codes = (np.repeat(ids_a, times) * self.width + ids_b[other]).astype("<u4").tobytes()
        until = lambda counts: np.r_[0, np.cumsum(counts)].tolist()
        words, tokens = flat.tolist(), until(n_a + n_b)
        links = np.r_[0, 4 * upto[np.cumsum(n_a) - 1]].tolist()
        groups = np.diff(np.r_[0, np.searchsorted(common, ends) + 1]).tolist()
        return [
            ("".join(words[t:u]), codes[x:y], i, j, g) for t, u, x, y, i, j, g in zip(
                tokens, tokens[1:], links, links[1:], n_a.tolist(), n_b.tolist(), groups, strict=False)]

    def records(self, parts: set[str]) -> dict[str, tuple | None]:
        """What is known of each part; new ones are aligned."""
        out, missing = {}, []
        for p in parts:
            if p in self.memo:
                out[p] = self.memo[p]
            elif p in self.older:
                out[p] = self.memo[p] = self.older[p]
            else:
                missing.append(p)
        for at in range(0, len(missing), 50_000):
            some = missing[at:at + 50_000]
            ids = self.chunks.encode_parts(some)
            made = self._records(some, [array(self.chunks.code, ids[p]).tolist() for p in some], self.ids_b(some))
            for p, record in zip(some, made, strict=True):
                out[p] = record
                if len(p) <= LONG_PART:
                    self.memo[p] = record
            if len(self.memo) > MEMO // 2:  # the older half goes
                self.older, self.memo = self.memo, {}
        return out

    def whole(self, text: str) -> tuple | None:
        """The record of a whole text, where some part by itself is not spelled."""
        return self._records([" " + text], [self.chunks.text_ids(" " + text)], [self.b.encode(text, out_type=int, num_threads=1)])[0]

    def tokens(self, text: str, start: int, of_a: bool) -> tuple[Tokens, bool]:
        """Tokens of a range of a text that starts at a byte offset; whether they spell it."""
        if not text:
            return NONE, True
        ids = self.chunks.text_ids(text) if of_a else self.ids_b([text])[0]
        names, length = (self.bytes_a, self.length_a) if of_a else (self.bytes_b, self.length_b)
        spelled = b"".join([names[i] for i in ids]) == text.encode()
        ids = np.array(ids, np.int64)
        return Tokens(ids, start + np.cumsum(length[ids])), spelled


_aligners: dict = {}


def aligner(spec_a: str, model_b: bytes) -> Aligner:
    """The worker's aligner, kept between tasks."""
    key = (hash(spec_a), hash(model_b))
    if key not in _aligners:
        _aligners[key] = Aligner(spec_a, model_b)
    return _aligners[key]


# Rows of the tasks ---------------------------------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: A document of a block, a block's pairs, or a chunk of a long text.
FIRST = "kind string, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary, idx int, a string, a_start long, b string, b_start long"
#: Closed groups of a long text, in order by (one, two).
PIECE = "block long, one int, two int, n_a long, n_b long, n_groups long, n_links long, text string, pairs binary, times binary"
#: Open ends of a range of a long text.
ENDS = ("prefix_a", "prefix_b", "suffix_a", "suffix_b")
OPEN = "block long, start int, closed boolean, spelled boolean, " + ", ".join(f"{e} array<long>, {e}_ends array<long>" for e in ENDS)


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(n, types[t]) for n, t in (x.split(" ") for x in ddl.split(", "))])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def chunks(text: str, size: int) -> list[tuple[str, int, str, int]]:
    """Ranges of a text for A and for B, each with its first byte; together they are the text."""
    places = []
    for rule in (CUT_A, CUT_B):
        at = [0]
        while at[-1] < len(text):
            found = rule.search(text, len(at) * size) if len(at) * size < len(text) else None
            at.append(max(found.start(), at[-1]) if found else len(text))
        places.append(at)
    n = max(map(len, places)) - 1
    spans = []
    for at in places:
        at += [len(text)] * (n + 1 - len(at))
        raw = [text[x:y] for x, y in zip(at, at[1:], strict=False)]
        starts = np.cumsum([0, *[len(x.encode()) for x in raw]]).tolist()
        spans.append(list(zip(raw, starts, strict=False)))
    return [(*x, *y) for x, y in zip(*spans, strict=True)]


def _summed(codes: list[bytes] | bytes) -> tuple[np.ndarray, np.ndarray]:
    joined = codes if isinstance(codes, bytes) else b"".join(codes)
    return np.unique(np.frombuffer(joined, "<u4"), return_counts=True)


def _block_rows(rows: list[tuple], number: int, make: Aligner) -> list[dict]:
    """Rows of the documents of one block, and the row of the block."""
    parts = [make.parts(" " + text) if text else [] for _, text in rows]
    known = make.records(set().union(*parts))
    out, every = [], []
    for (doc, text), own in zip(rows, parts, strict=True):
        records = [known[p] for p in own]
        if None in records:
            whole = make.whole(text)
            records = [] if whole is None else [whole]
        row = {"kind": "doc", "block": number, "doc_id": doc, **dict.fromkeys(COUNTS, 0), "groups_sha256": "", "pairs": b"", "times": b""}
        if records:
            texts, codes, n_a, n_b, n_groups = zip(*records, strict=True)
            pairs, times = _summed(list(codes))
            every.append(pairs)
            row |= {
                "n_a": sum(n_a), "n_b": sum(n_b), "n_groups": sum(n_groups), "n_links": int(times.sum()),
                "groups_sha256": hashlib.sha256("".join(texts)[:-1].encode()).hexdigest(),
                "pairs": pairs.tobytes(), "times": times.astype("<u4").tobytes(),
            }
        out.append(row)
    if every:
        pairs, times = np.unique(np.concatenate(every), return_counts=True)
        out.append({"kind": "block", "block": number, "pairs": pairs.tobytes(), "times": times.astype("<u4").tobytes()})
    return out


def _first_pass(docs: DataFrame, sent, chunk_chars: int, block_chars: int) -> DataFrame:
    """Documents by blocks, the blocks' pairs, and chunks of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        make, number = aligner(*sent.value), TaskContext.get().partitionId() << 32
        rows, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and len(text) > chunk_chars:
                    for i, (a, a_start, b, b_start) in enumerate(chunks(" " + text, chunk_chars)):
                        yield _batch([{"kind": "chunk", "block": number, "doc_id": doc, "idx": i, "a": a, "a_start": a_start, "b": b, "b_start": b_start}], FIRST)
                    number += 1
                    continue
                rows.append((doc, text))
                size += len(text or "")
                if size >= block_chars:
                    yield _batch(_block_rows(rows, number, make), FIRST)
                    rows, size, number = [], 0, number + 1
        if rows:
            yield _batch(_block_rows(rows, number, make), FIRST)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, FIRST)


# Long texts ----------------------------------------------------------------------------

def _piece(block: int, one: int, two: int, groups: list[Pair], width: int) -> dict:
    a, b = (np.concatenate([g[i].ids for g in groups]) for i in (0, 1))
    codes = np.concatenate([(g[0].ids[:, None] * width + g[1].ids).ravel() for g in groups]).astype("<u4")
    pairs, times = np.unique(codes, return_counts=True)
    text = ";".join(",".join(map(str, g[0].ids.tolist())) + "|" + ",".join(map(str, g[1].ids.tolist())) for g in groups)
    return {
        "block": block, "one": one, "two": two, "n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(codes),
        "text": text, "pairs": pairs.tobytes(), "times": times.astype("<u4").tobytes(),
    }


def _open_row(block: int, f: Fragment) -> dict:
    sides = dict(zip(ENDS, (*f.prefix, *f.suffix), strict=True))
    return {"block": block, "start": f.start, "closed": f.closed, "spelled": f.spelled,
            **{e: t.ids for e, t in sides.items()}, **{f"{e}_ends": t.ends for e, t in sides.items()}}


def _fragment(row: dict) -> Fragment:
    a, b, c, d = (Tokens(np.array(row[e], np.int64), np.array(row[f"{e}_ends"], np.int64)) for e in ENDS)
    return Fragment(int(row["start"]), bool(row["closed"]), (a, b), (c, d), bool(row["spelled"]))


BOTH = ", ".join(["kind string", OPEN, *[x for x in PIECE.split(", ") if x != "block long"]])


def _fragments(chunk: DataFrame, sent) -> DataFrame:
    """Open ends and closed groups of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = aligner(*sent.value)
        for batch in batches:
            for r in batch.to_pylist():
                a, fits_a = make.tokens(r["a"], r["a_start"], True)
                b, fits_b = make.tokens(r["b"], r["b_start"], False)
                if not (fits_a and fits_b):
                    a = b = NONE
                made, groups = Fragment.of(r["idx"], a, b, fits_a and fits_b)
                out = [{"kind": "open", **_open_row(r["block"], made)}]
                if groups:
                    out.append({"kind": "piece", **_piece(r["block"], r["idx"], 1, groups, make.width)})
                yield _batch(out, BOTH)

    spread = chunk.select("block", "idx", "a", "a_start", "b", "b_start").repartition("block", "idx")
    return spread.mapInArrow(run, BOTH)


def _composed(opened: DataFrame, width: int, codes: int) -> DataFrame:
    """One round of the tree: ``FAN`` neighbouring ranges, ``width`` chunks each, become one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = [_fragment(r) for r in rows.sort_values("start").to_dict("records")]
        block, made, out = int(rows["block"].iloc[0]), ordered[0], []
        for after in ordered[1:]:
            made, groups = made.then(after)
            if groups:
                out.append({"kind": "piece", **_piece(block, after.start, 0, groups, codes)})
        return _batch([{"kind": "open", **_open_row(block, made)}, *out], BOTH).to_pandas(integer_object_nulls=True)

    return opened.groupBy("block", (F.col("start") / (width * FAN)).cast("int").alias("range")).applyInPandas(run, BOTH)


def _digests(pieces: DataFrame) -> DataFrame:
    """``block`` and ``groups_sha256``: the pieces of a text streamed through one hash in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([made.hexdigest()])], names=["block", "groups_sha256"])
        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != now:
                    if made is not None:
                        yield row()
                    now, made = block, hashlib.sha256(text.encode())
                else:
                    made.update(b";" + text.encode())
        if made is not None:
            yield row()

    ordered = pieces.repartition("block").sortWithinPartitions("block", "one", "two").select("block", "text")
    return ordered.mapInArrow(run, "block long, groups_sha256 string")


def _exploded(rows: DataFrame) -> DataFrame:
    """``block``, ``pair`` and ``times`` from packed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                pair = np.frombuffer(pairs, "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), block, np.int64)), pa.array(pair), pa.array(np.frombuffer(times, "<u4").astype(np.int64))],
                    names=["block", "pair", "times"])

    return rows.select("block", "pairs", "times").mapInArrow(run, "block long, pair long, times long")


# All together --------------------------------------------------------------------------

def aligned(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = CHUNK_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Token, group and link counts, the links' corpus counts, and the groups' digest per document."""
    spark = docs.sparkSession
    with open(path_b, "rb") as f:
        model = f.read()
    sent = spark.sparkContext.broadcast((read_text(path_a), model))  # two vocabulary files
    width = aligner(*sent.value).width
    first = stored(_first_pass(docs, sent, chunk_chars, block_chars), "aligned", partition_by="kind")
    short, blocks, chunk = (first.where(F.col("kind") == k) for k in ("doc", "block", "chunk"))

    # Long texts: a tree of compositions, as deep as the longest text needs.
    made = stored(_fragments(chunk, sent), "fragments", partition_by="kind")
    opened, pieces = made.where("kind = 'open'"), made.where("kind = 'piece'")
    last = opened.agg(F.max("start")).first()[0]
    span = 1
    while last is not None and span <= last:
        made = stored(_composed(opened, span, width), "fragments", partition_by="kind")
        opened, pieces = made.where("kind = 'open'"), pieces.unionAll(made.where("kind = 'piece'"))
        span *= FAN
    names = chunk.where("idx = 0").select("block", "doc_id")
    spelled = opened.where("spelled").select("block")
    pieces = pieces.select([x.split(" ")[0] for x in PIECE.split(", ")]).join(spelled, "block", "left_semi")
    long_pairs = stored(_exploded(pieces).groupBy("block", "pair").agg(F.sum("times").alias("times")), "long-pairs")

    # Documents by linked pair; the highest count of each id of A (as many rows as A has ids).
    per_block = _exploded(blocks)
    counts = per_block.select("pair", F.col("times").alias("n")).unionAll(long_pairs.select("pair", F.lit(1).cast("long").alias("n")))
    counts = stored(counts.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    one = F.floor(F.col("pair") / width).alias("one")
    most = counts.groupBy(one).agg(F.max("n").alias("most"))
    counts = stored(counts.withColumn("one", one).join(F.broadcast(most), "one").select(
        "pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "best")

    by_text = long_pairs.join(counts, "pair").groupBy("block").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    sums = pieces.groupBy("block").agg(*[F.sum(c).alias(c) for c in COUNTS])
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    result = ("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
    long = names.join(sums, "block", "left").join(by_text, "block", "left").join(_digests(pieces), "block", "left").select(
        "doc_id", *[zero(c) for c in (*COUNTS, "n_best", "count_sum")], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))

    def scored(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("pair")
        pair, n, best = (known[c].to_numpy(np.int64) for c in ("pair", "n", "best"))
        n_best, count_sum = [], []
        for pairs, times in zip(own["pairs"], own["times"], strict=True):
            at = np.searchsorted(pair, np.frombuffer(pairs, "<u4").astype(np.int64))
            m = np.frombuffer(times, "<u4").astype(np.int64)
            n_best.append(int((m * best[at]).sum()) if len(at) else 0)
            count_sum.append(int((m * n[at]).sum()) if len(at) else 0)
        return own.assign(n_best=n_best, count_sum=count_sum)[[*result, "no_id"]]

    back = per_block.select("block", "pair").join(counts, "pair")
    own = short.select("block", "doc_id", *COUNTS, "groups_sha256", "pairs", "times").withColumn("no_id", F.col("doc_id").isNull()).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(0).cast("long")))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, no_id boolean"
    brief = own.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(scored, schema)
    return brief.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).select(*result).unionAll(long.select(*result))
