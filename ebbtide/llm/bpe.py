"""Byte-level BPE with higher-order functions: ranked merges folded over the bytes of words.

1. A pass over the documents splits each text by the tokenizer's pattern and writes, per
   block of text, its distinct words in buckets and each document as numbers of words.
2. In each bucket the corpus's distinct words are encoded once each: an ``aggregate`` over
   the word's bytes merges, at each step, the leftmost adjacent pair with the lowest rank,
   found in a literal map. A fold copies its state at each step, so words of more than
   ``LONG_WORD`` bytes are merged with a heap instead; both give the same ids.
3. Ids return to their blocks, where documents are put together from them. Decoding puts
   the binary pieces of the ids one after another.

A block's words and documents are bounded by ``BLOCK_CHARS`` of text (or one document); a
bucket's words shrink with the number of shuffle partitions.

Results: null text is empty and has no ids; rows that repeat a doc_id give one row each;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import CUTS, LONG_PART, ODD_SPACE, give_back, giving_back, read_text, stored_buckets

#: Characters of text per block.
BLOCK_CHARS = 12 << 20
#: Words whose numbers are looked up together.
SOME_WORDS = 1 << 17
#: Parts whose words one Python worker remembers from block to block.
MEMO = 200_000
#: Longest word, in bytes, that is folded: beyond it the fold takes many times the heap's time.
LONG_WORD = 12
#: Parts of the literal rank map: a piece is looked up in the part that its hash names,
#: since Spark searches a map from end to end.
MAP_PARTS = 16_384
NO_RANK = 2**31 - 1
ANY_SPACE = re.compile(r"\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a vocabulary file: a base64 piece and its rank on each line."""
    pairs = (line.split() for line in read_text(path).splitlines() if line)
    return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word, with a heap of mergeable pairs over a linked list of pieces."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    piece: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (r := ranks.get(both := piece[i] + piece[after[i]])) is not None:
            heapq.heappush(heap, (r, i, both))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i] if piece[i] is not None else -1
        if j < 0 or piece[i] + piece[j] != both:
            continue  # one of the pair has been merged since
        piece[i], piece[j] = both, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in piece if p is not None]


# The fold ------------------------------------------------------------------------------

def _byte_string(piece: bytes) -> str:
    """A string with one character for each byte, its code point the byte's value."""
    return piece.decode("latin-1")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as one literal: ``MAP_PARTS`` maps from byte strings to ranks."""
    parts: list[dict[str, int]] = [{} for _ in range(MAP_PARTS)]
    for piece, rank in ranks.items():
        key = _byte_string(piece)
        parts[xxhash.xxh64_intdigest(key.encode(), 42) % MAP_PARTS][key] = rank
    # from_json of a literal is folded to a literal when the plan is optimized
    return F.from_json(F.lit(json.dumps(parts)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of a word as an array, by folding merges over the array of its bytes.

    The rank map is bound once: each further mention of it would be one more copy in every task.
    """
    return _let(table, lambda bound: _folded(word, bound))


def _folded(word: Column, table: Column) -> Column:
    def rank(piece: Column) -> Column:
        part = F.pmod(F.xxhash64(piece), F.lit(MAP_PARTS)).cast("int")
        return F.try_element_at(F.get(table, part), piece)

    def pair_rank(one: Column, two: Column) -> Column:
        return F.coalesce(rank(F.concat(one, two)), F.lit(NO_RANK))

    def merge_at(state: Column, at: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]
        size = F.size(parts)
        item = lambda i: F.get(parts, i)  # noqa: E731 - from 0; ``at`` counts from 1
        none = F.array().cast("array<int>")

        def joined(both: Column) -> Column:
            return F.struct(
                F.concat(F.slice(parts, F.lit(1), at - 1), F.array(both), F.slice(parts, at + 2, size)).alias("parts"),
                F.concat(
                    F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))),
                    F.when(at > 1, F.array(pair_rank(item(at - 2), both))).otherwise(none),
                    F.when(at + 1 < size, F.array(pair_rank(both, item(at + 1)))).otherwise(none),
                    F.slice(ranks, at + 2, size),
                ).alias("ranks"),
            )

        return _let(F.concat(item(at - 1), item(at)), joined)

    def step(state: Column, _: Column) -> Column:
        lowest = F.array_min(state["ranks"])
        return F.when(F.coalesce(lowest, F.lit(NO_RANK)) == NO_RANK, state).otherwise(
            _let(F.array_position(state["ranks"], lowest).cast("int"), lambda at: merge_at(state, at))
        )

    def folded(text: Column) -> Column:
        chars = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))
        return _let(chars, lambda c: F.aggregate(
            F.slice(c, F.lit(2), F.size(c)),
            F.struct(
                c.alias("parts"),
                F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c)), pair_rank).alias("ranks"),
            ),
            step,
            lambda state: F.transform(state["parts"], rank),
        ))

    def encoded(text: Column) -> Column:
        return _let(rank(text), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded(text)))

    return _let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), encoded)


# Whole documents -----------------------------------------------------------------------

def _packed(values: np.ndarray) -> bytes:
    """Integers as compressed bytes: all lowest bytes, then all second ones, and so on."""
    import zstandard

    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _packed_words(words: list[str]) -> bytes:
    """Words as compressed bytes: their number, their lengths, their UTF-8."""
    import zstandard

    raw = [w.encode() for w in words]
    lengths = np.array([len(words), *map(len, raw)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(lengths + b"".join(raw))


def _unpacked_words(raw: bytes) -> list[str]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (4 * (n + 1) + np.cumsum(np.frombuffer(data, "<u4", n, 4))).tolist()
    return [data[a:b].decode() for a, b in zip([4 * (n + 1), *ends], ends)]


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions ``start[i]`` to ``start[i] + size[i]`` of every i, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def word_numbers(texts: pa.Array, find, codes: dict[str, int]) -> list[np.ndarray | None]:
    """Each text as numbers of its words in ``codes``, which takes new words; None: not such a text.

    For texts whose only white space is single spaces and line breaks, each between other characters.
    No match of the pattern crosses the place before such a space, nor either side of such a break, so
    distinct parts between them are split once, all of them in one text, with line breaks between.
    """
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    words = pc.split_pattern(lines.flatten(), " ")
    found = words.flatten().dictionary_encode()
    distinct, code = found.dictionary.to_pylist(), found.indices.to_numpy()
    line_ends, ends = words.offsets.to_numpy(), lines.offsets.to_numpy()
    first = line_ends[:-1]  # every line has a word, if an empty one
    doc_ends = line_ends[ends]
    spaced = ANY_SPACE.search("".join(distinct)) is not None  # rare
    odd = np.array([not w or (spaced and ANY_SPACE.search(w) is not None) for w in distinct], bool)
    plain = ~np.logical_or.reduceat(odd[code], doc_ends[:-1]) if len(texts) else np.zeros(0, bool)
    # A word is led by a space, or else begins a line.
    led = np.ones(len(code), bool)
    led[first] = False
    breaks = np.zeros(len(code), bool)
    breaks[first] = True
    breaks[doc_ends[:-1]] = False
    mine = np.repeat(plain, np.diff(doc_ends))
    key = code * 2 + led
    there = np.zeros(2 * len(distinct), bool)
    there[key[mine]] = True
    keys = np.flatnonzero(there)
    if not len(keys):
        return [None] * len(texts)
    split = find("\n".join([(" " if k & 1 else "") + distinct[k >> 1] for k in keys.tolist()]))
    flat = np.array([-1 if w == "\n" else codes.setdefault(w, len(codes)) for w in split] + [-1], np.int64)
    stops = np.flatnonzero(flat < 0)
    size = np.diff(stops, prepend=-1) - 1
    start, rank = stops - size, np.cumsum(there) - 1
    if breaks[mine].any():  # the last part: a line break
        flat[-1] = codes.setdefault("\n", len(codes))
        size, start = np.append(size, 1), np.append(start, len(flat) - 1)
    flat, out = flat.astype("<u4"), []
    begin = np.flatnonzero(np.diff(doc_ends[:-1] // SOME_WORDS, prepend=-1)).tolist()
    for a, b in zip(begin, [*begin[1:], len(texts)], strict=True):
        own = slice(doc_ends[a], doc_ends[b])
        broken = breaks[own][mine[own]]
        at = np.arange(len(broken)) + np.cumsum(broken)
        parts = np.full(len(broken) + int(broken.sum()), len(size) - 1)
        parts[at] = rank[key[own][mine[own]]]
        # A text ends with its last word: the break before the next line is that text's own.
        last = np.cumsum(np.diff(doc_ends[a:b + 1])[plain[a:b]]) - 1
        numbers = np.split(flat[_ragged(start[parts], size[parts])], np.cumsum(size[parts])[at[last]][:-1])
        each = iter(numbers)
        out += [next(each) if p else None for p in plain[a:b].tolist()]
    return out


def _split(docs: DataFrame, pattern: str, buckets: int, text: str, key: str) -> DataFrame:
    """Blocks of text as three kinds of rows.

    ``doc``: a document as numbers of its block's words; ``block``: the bucket of each of the
    block's words, by number; ``word``: a bucket's words of the block, in that order.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, cut = regex.compile(pattern).findall, CUTS["spaced"].findall
        block = TaskContext.get().partitionId() << 32
        codes: dict[str, int] = {}
        parts: dict[str, bytes] = {}
        words_of: dict[str, list[str]] = {}
        size = 0

        def rows(kind: str, docs: list, raws: list[bytes], bucket: list) -> pa.RecordBatch:
            n = len(raws)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(bucket, pa.int32()),
                 pa.array(docs, pa.int64()), pa.array(raws, pa.binary())], schema=SPLIT)

        def numbered(part: str) -> bytes:
            words = words_of.get(part)
            if words is None:
                words = find(part)
                if len(part) <= LONG_PART:
                    if len(words_of) >= MEMO:
                        words_of.clear()
                    words_of[part] = [part] if words == [part] else words
            return np.array([codes.setdefault(w, len(codes)) for w in words], "<u4").tobytes()

        def document(x: str) -> np.ndarray:
            if ODD_SPACE.search(x):
                return np.frombuffer(numbered(x), "<u4")
            every = cut(x)
            found = list(map(parts.get, every))
            if None in found:
                for i, (p, v) in enumerate(zip(every, found, strict=True)):
                    if v is None:
                        if (v := parts.get(p)) is None:
                            v = parts[p] = numbered(p)
                        found[i] = v
            return np.frombuffer(b"".join(found), "<u4")

        def words() -> Iterator[pa.RecordBatch]:
            bucket = np.array([xxhash.xxh32_intdigest(w) % buckets for w in codes], np.int64)
            yield rows("block", [None], [_packed(bucket)], [None])
            every = list(codes)
            order = np.argsort(bucket, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                if len(own):
                    yield rows("word", [None], [_packed_words([every[i] for i in own.tolist()])], [int(bucket[own[0]])])

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            lengths, every = pc.utf8_length(texts).to_pylist(), batch.column(0).to_pylist()
            at = 0
            while at < len(every):
                if size and size + lengths[at] > BLOCK_CHARS:
                    yield from words()
                    codes, parts, size, block = {}, {}, 0, block + 1
                    give_back()
                end = at
                while end < len(every) and (not size or size + lengths[end] <= BLOCK_CHARS):
                    size += lengths[end]
                    end += 1
                some = texts.slice(at, end - at)
                numbers = word_numbers(some, find, codes)
                raws = [_packed(document(some[i].as_py()) if x is None else x) for i, x in enumerate(numbers)]
                made = rows("doc", every[at:end], raws, [None] * len(raws))
                del some, numbers, raws
                yield made
                del made
                at = end
        if size or codes:
            yield from words()

    schema = "kind string, block long, bucket int, doc_id long, raw binary"
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        lambda batches: giving_back(split(batches)), schema)


SPLIT = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("raw", pa.binary())])


def encode_words(words: DataFrame, ranks: dict[bytes, int], keep: list[str]) -> DataFrame:
    """``words`` with the ids of each ``word`` and the columns to ``keep``; a null word has null ids."""

    @F.pandas_udf("array<int>")
    def by_heap(word: pd.Series) -> pd.Series:
        return word.map(lambda w: merged(w.encode(), ranks))

    short = F.coalesce(F.octet_length("word") <= LONG_WORD, F.lit(True))
    folded = words.where(short).select(*keep, fold_merges(F.col("word"), rank_literal(ranks)).alias("ids"))
    return folded.unionAll(words.where(~short).select(*keep, by_heap("word").alias("ids")))


def _encoded_buckets(words: DataFrame, ranks: dict[bytes, int], buckets: int) -> DataFrame:
    """Per block and bucket the ids of its words, each distinct word of a bucket encoded once.

    All within one task per bucket: distinct words go through the fold as rows, followed by
    each block's list of them.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        lists: list[tuple[int, int, bytes]] = []
        schema = pa.schema([("word", pa.string()), ("long_ids", pa.list_(pa.int32())), ("block", pa.int64()), ("bucket", pa.int32()), ("numbers", pa.binary())])
        for batch in batches:
            for block, bucket, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = np.array([number.setdefault(w, len(number)) for w in _unpacked_words(raw)])
                lists.append((block, bucket, _packed(own)))
        every = list(number)
        for i in range(0, len(every), 20_000):
            some = every[i:i + 20_000]
            long = [merged(b, ranks) if len(b) > LONG_WORD else None for b in (w.encode() for w in some)]
            short = [w if v is None else None for w, v in zip(some, long, strict=True)]
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(short, pa.string()), pa.array(long, pa.list_(pa.int32())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        for i in range(0, len(lists), 100):
            some = lists[i:i + 100]
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32()))] + [pa.array([x[j] for x in some], k) for j, k in enumerate((pa.int64(), pa.int32(), pa.binary()))],
                schema=schema)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, sizes = [], []
        table = None
        for batch in batches:
            lists = batch.column(1).is_valid()
            words_in, lists_in = batch.filter(pc.invert(lists)), batch.filter(lists)
            if words_in.num_rows:
                ids = words_in.column(0)
                flat.append(ids.flatten().to_numpy())
                sizes.append(pc.list_value_length(ids).to_numpy())
            if lists_in.num_rows:
                if table is None:
                    size = np.concatenate(sizes)
                    table = np.concatenate(flat), np.cumsum(size) - size, size
                values, start, size = table
                out = []
                for raw in lists_in.column(3).to_pylist():
                    own = _unpacked(raw)
                    out.append((_packed(size[own]), _packed(values[_ragged(start[own], size[own])])))
                yield pa.RecordBatch.from_arrays([
                    lists_in.column(1), lists_in.column(2), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary()),
                ], names=["block", "bucket", "sizes", "ids"])

    spread = words.select("block", "bucket", "raw").repartition(buckets, "bucket")  # a bucket a task: not merged
    rows = spread.mapInArrow(
        lambda batches: giving_back(distinct(batches)), "word string, long_ids array<int>, block long, bucket int, numbers binary")
    folded = rows.select(F.coalesce("long_ids", fold_merges(F.col("word"), rank_literal(ranks))).alias("ids"), "block", "bucket", "numbers")
    return folded.mapInArrow(lambda batches: giving_back(answered(batches)), "block long, bucket int, sizes binary, ids binary")


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, digests: bool = False,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Each document's ids; or, with ``digests``, their number and the hashes of ids and decoded bytes."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Filed by block, so the documents need no second shuffle to meet their ids.
    parts = stored_buckets(_split(docs, pattern, buckets, text, key), "words", "kind", "block", buckets)
    words = _encoded_buckets(parts.where("kind = 'word'"), ranks, buckets)
    whole = parts.where("kind != 'word'").select("block", "doc_id", "raw", (F.col("kind") == "doc").alias("is_doc"))
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece

    def joined(sizes: np.ndarray, values: pa.Array, mark: bytes) -> pa.Array:
        """Runs of ``values``, ``sizes`` long, with ``mark`` between."""
        ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int64())
        return pc.binary_join(pa.LargeListArray.from_arrays(ends, values), pa.scalar(mark, values.type))

    def whole_block(own: pd.DataFrame, words_in: pd.DataFrame) -> pd.DataFrame:
        docs_in = own[own["is_doc"]]
        bucket = np.concatenate([np.zeros(0, "<u4"), *map(_unpacked, own["raw"][~own["is_doc"]])])
        # Words come bucket by bucket; ``place`` is a word's place among them.
        place = np.empty(len(bucket), np.int64)
        place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
        words_in = words_in.sort_values("bucket")
        size = np.concatenate([np.zeros(0, np.int64), *map(_unpacked, words_in["sizes"])]).astype(np.int64)
        ids = np.concatenate([np.zeros(0, "<u4"), *map(_unpacked, words_in["ids"])]).astype(np.int64)
        start = np.cumsum(size) - size
        if digests:
            written = joined(size, pc.cast(pc.cast(pa.array(ids), pa.string()), pa.large_binary()), b",")
            decoded = joined(size, pa.array(pieces, pa.large_binary()).take(pa.array(ids)), b"")
        out = []
        for raw in docs_in["raw"]:
            code = place[_unpacked(raw)]
            if digests:
                pick, whole = pa.array(code), np.array([len(code)])
                out.append((int(size[code].sum()), *[
                    hashlib.sha256(joined(whole, x.take(pick), mark)[0].as_buffer()).hexdigest() for x, mark in ((written, b","), (decoded, b""))
                ]))
            else:
                out.append((ids[_ragged(start[code], size[code])].astype("int32"),))
        names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids"]
        result = pd.DataFrame(out, columns=names)
        result.insert(0, "doc_id", docs_in["doc_id"].astype("Int64").to_numpy())
        return result

    def join(own: pd.DataFrame, words_in: pd.DataFrame) -> pd.DataFrame:
        result = whole_block(own, words_in)
        give_back()
        return result

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>"
    return whole.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(join, schema)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: its binary pieces one after another."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""))
