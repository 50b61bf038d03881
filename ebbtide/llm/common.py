"""Helpers shared by the corpus operators: tables, stored results, exact chunked tokenizing."""

from __future__ import annotations

import ctypes
import json
import os
import pathlib
import re
import shutil
import string
import tempfile
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ebbtide.session import shared_dir


def ship_code(spark: SparkSession) -> None:
    """Send this package to Python workers that would not find it by themselves.

    A cluster gets it with ``--py-files`` or an installed package; a driver that has only
    put the source folder on its own path does not share that with its workers.
    """
    root = pathlib.Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if not root.is_dir() or str(root) in known or getattr(context, "_ebbtide_shipped", False):
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp()}/ebbtide", "zip", root, "ebbtide")
    context.addPyFile(made)
    context._ebbtide_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that the cluster shares (not yet created)."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet on shared storage and read back: lineage ends there.

    One attempt of each task is committed, so later readers agree on the rows even
    where ``df`` depends on partitioning, and lost executors lose nothing.
    """
    path = new_folder(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def stored_buckets(df: DataFrame, name: str, partition_by: str, bucket_by: str, buckets: int) -> DataFrame:
    """Like :func:`stored`, filed in folders and hashed into buckets: joins on the hashed column
    read it without a shuffle. The files are a table of the session's catalog."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    made = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.partitionBy(partition_by).bucketBy(buckets, bucket_by).saveAsTable(made)
    out = spark.table(made)
    out._stored_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete what :func:`stored` wrote for frames that no later result reads."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def give_back() -> None:
    """Return the memory that this process has freed to the system.

    Python workers stay after their tasks, and what their allocators keep adds up over an executor's workers.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def giving_back(batches: Iterator) -> Iterator:
    """The same batches; memory is returned after the last, when what made them is gone."""
    yield from batches
    give_back()


#: Letters, and the ASCII marks that can end the word before white space: neither family of
#: tokenizers joins such a mark to a letter before it (İ is left out: its lower case ends in one).
_WORD, _MARKS = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]++", r"(?=[!-/:-@\[-`{-~]+(?:\s|\Z))"
#: Where a text may be cut without changing its ids, by tokenizer family.
#: "words": white space is dropped and never joins two words.
#: "spaced": a word carries at most the one space before it (the byte-level pattern).
CUTS = {
    "words": re.compile(rf"{_WORD}{_MARKS}|\S+"),
    "spaced": re.compile(rf" ?{_WORD}{_MARKS}| ?\S+|\s+(?!\S)|\s"),
}
#: Python's white space minus the Unicode property White_Space: texts with these are encoded whole.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Parts of words remembered by one Python worker; a full memory is emptied. Results never change.
MEMO = 500_000
#: Longer parts are encoded each time.
LONG_PART = 64
#: Characters of text handled at once.
SLICE = 1_000_000
#: Parts that can be encoded side by side in one text, by family: "words" drops the white space
#: between single words, and each ends in a token that ends a word; "spaced" makes a line break
#: between two such parts a token of its own.
SIDE_BY_SIDE = {"words": (re.compile("[A-Za-z]+"), " "), "spaced": (re.compile(r" ?\S+"), "\n")}
#: Parts in such a text.
JOINED = 10_000
#: Words that :func:`by_letters` takes: composed letters, each lowered to one of the same.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Characters of text whose words are found together ("words").
WORDS_SLICE = 2_000_000
_BYTES = [chr(i) for i in range(128)] + [""] * 128
_SPACE_BYTE = np.array([c in tuple(" \t\n\v\f\r") for c in _BYTES])
_MARK_BYTE = np.array([c in tuple(string.punctuation) for c in _BYTES])
_LETTER_BYTE = np.array([c.isalpha() for c in _BYTES])

_encoders: dict = {}


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: itself where it prints, else from 256 on."""
    plain = [b for b in range(256) if 33 <= b < 127 or (161 <= b and b != 173)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: The pattern of byte-level pre-tokenizers: a fixed value.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: The pattern of the "words" tokenizer that :func:`by_letters` knows: a fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_ranks(spec: str):
    """An encoder by ranks, several times as fast, where a byte-level vocabulary numbers its tokens
    in the order of its merges, so that both give the same ids; else nothing."""
    import tiktoken

    made = json.loads(spec)
    model, cut = made["model"], made.get("pre_tokenizer") or {}
    if made.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("end_of_word_suffix"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"].get(a + b) for a, b in pairs]
    letters, single = byte_letters(), {t: i for t, i in model["vocab"].items() if len(t) == 1}
    if any(c not in letters for a, b in pairs for c in a + b) or set(single) != set(letters):
        return None
    piece = lambda token: bytes(letters[c] for c in token)
    ranks = {piece(t): i for t, i in single.items()} | {piece(a + b): i for (a, b), i in zip(pairs, order, strict=True)}
    if None in order or order != sorted(set(order)) or len(ranks) != 256 + len(order) or min(order) < max(single.values()):
        return None
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def by_letters(spec: str):
    """An encoder of lines of :data:`LATIN` words by the tokenizer's model alone, where the steps
    before the model only lower such words, part them and write their bytes as letters; else nothing."""
    from tokenizers import Tokenizer

    made = json.loads(spec)
    listed = lambda step, kind: step.get(kind, [step]) if step else []
    changes = listed(made.get("normalizer"), "normalizers")
    cuts = listed(made.get("pre_tokenizer"), "pretokenizers")
    plain = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    if changes != plain or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, level = cuts
    if (split["pattern"], split["behavior"], split["invert"]) != ({"Regex": WORD_PATTERN}, "Removed", True):
        return None
    if level.get("add_prefix_space") or level.get("use_regex", True) or made["model"].get("end_of_word_suffix") != "</w>":
        return None
    if not all(t["special"] for t in made["added_tokens"]):
        return None
    model = Tokenizer.from_str(json.dumps({
        **made, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": [],
    }))
    letters = np.zeros(256, "<u4")
    for letter, byte in byte_letters().items():
        letters[byte] = ord(letter)
    letters[ord(" ")] = ord(" ")

    def ids(line: str) -> list[int]:
        raw = letters[np.frombuffer(line.lower().encode(), np.uint8)].tobytes().decode("utf-32-le")
        return model.encode_batch_fast([raw], add_special_tokens=False)[0].ids

    return ids


def word_parts(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The parts of all texts one after another ("words"), and how many there are up to each text's end.

    Texts are cut at ASCII white space, which is dropped (other white space stays inside of a
    part), and between a letter and the ASCII marks after it that end the word.
    """
    data = [x.encode() for x in texts]
    raw = np.frombuffer(b"".join([b" ", b" ".join(data), b" "]), np.uint8)
    ends = np.cumsum([len(x) + 1 for x in data])
    space, mark = _SPACE_BYTE[raw], _MARK_BYTE[raw]
    words = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    first, last = np.flatnonzero(mark[1:] & ~mark[:-1]) + 1, np.flatnonzero(mark[:-1] & ~mark[1:])
    one, two = raw[first - 1], raw[first - 2]  # the byte before the marks and the one before that
    latin = (one >= 0x80) & (one < 0xC0) & (((two >= 0xC3) & (two <= 0xC8)) | ((two == 0xC9) & (one < 0x90)))
    latin &= ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7)) | (two == 0xC4) & (one == 0xB0))  # × ÷ İ
    cuts = np.sort(np.concatenate([words, first[(_LETTER_BYTE[one] | latin) & space[last + 1]]]))
    kept = np.cumsum(~space)
    offsets = np.append(kept[cuts - 1], kept[-1]).astype("<i8")
    parts = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(raw[~space]))
    return parts, np.searchsorted(cuts, ends)


class ChunkEncoder:
    """Ids of whole texts as the ``tokenizers`` library gives them, from distinct parts of words.

    The cuts of :data:`CUTS` are places that no match of the tokenizer's own pattern crosses,
    so the ids of a text are those of its parts one after another. A corpus repeats its
    words, so most parts are found in the memory; the others are encoded side by side.
    """

    def __init__(self, spec: str, chunks: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.cut = CUTS[chunks].findall
        self.memo: dict[str, bytes] = {}
        if chunks == "spaced" and (ranked := by_ranks(spec)):
            self.text_ids = ranked
        self.line_ids = self.text_ids
        probe = self.tokenizer.encode("Word", add_special_tokens=False).ids
        self.lower = probe == self.tokenizer.encode("word", add_special_tokens=False).ids
        self.simple, self.glue = SIDE_BY_SIDE[chunks]
        self.words = chunks == "words"
        if self.words and (lettered := by_letters(spec)):
            self.line_ids, self.simple = lettered, LATIN
        # Tokens after which a part has ended ("words"), or that stand between parts ("spaced").
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        between = self.tokenizer.encode(self.glue, add_special_tokens=False).ids
        self.ends[between or [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.between = bool(between)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def text_ids(self, text: str) -> list[int]:
        """The ids of one text."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _joined(self, parts: list[str]) -> list[bytes]:
        """The ids of simple parts, encoded as one text and taken apart again."""
        ids = np.array(self.line_ids(self.glue.join(parts)), self.dtype)
        at = np.flatnonzero(self.ends[ids])
        starts, stops = (np.r_[0, at + 1], np.r_[at, len(ids)]) if self.between else (np.r_[0, at[:-1] + 1], at + 1)
        if len(starts) != len(parts):
            return self._whole(parts)
        raw, size = ids.tobytes(), self.dtype.itemsize
        return [raw[a:b] for a, b in zip((starts * size).tolist(), (stops * size).tolist(), strict=True)]

    def encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of distinct parts, as bytes of ``dtype``."""
        simple = [p for p in parts if self.simple.fullmatch(p)]
        other = list(set(parts).difference(simple)) if simple else parts
        out = dict(zip(other, self._whole(other), strict=True))
        for i in range(0, len(simple), JOINED):
            some = simple[i:i + JOINED]
            out.update(zip(some, self._joined(some), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``."""
        out: list[bytes] = []
        encode, most = (self._words_slice, WORDS_SLICE) if self.words else (self._slice, SLICE)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= most):
                size += len(texts[end])
                end += 1
            out += encode(texts[at:end])
            at = end
        return out

    def _words_slice(self, texts: list[str]) -> list[bytes]:
        """Each distinct part of the texts is looked up once, and ids are put together by Arrow."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        parts, ends = word_parts([x.lower() if self.lower and x.isascii() else x for x in texts])
        if not len(parts):
            return [b""] * len(texts)
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.memo.get, distinct))
        new = self.encode_parts([p for p, v in zip(distinct, found, strict=True) if v is None])
        self.memo.update((k, v) for k, v in new.items() if len(k) <= LONG_PART)
        known = [new[p] if v is None else v for p, v in zip(distinct, found, strict=True)]
        _, offsets, raw = pa.array(known, pa.large_binary()).take(coded.indices).buffers()
        stops = np.frombuffer(offsets, "<i8")[ends].tolist()
        raw = raw or pa.py_buffer(b"")  # no part has an id
        return [raw[a:b].to_pybytes() for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _slice(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        known = self.memo.get
        odd = {i: self._whole([x])[0] for i, x in enumerate(texts) if ODD_SPACE.search(x)}
        split = [
            [] if i in odd else self.cut(x.lower() if self.lower and x.isascii() else x) for i, x in enumerate(texts)
        ]
        found = [list(map(known, parts)) for parts in split]
        missing: set[str] = set()
        for parts, ids in zip(split, found, strict=True):
            if None in ids:
                missing.update([p for p, v in zip(parts, ids, strict=True) if v is None])
        new = self.encode_parts(list(missing))
        self.memo.update((k, v) for k, v in new.items() if len(k) <= LONG_PART)
        out = []
        for i, (parts, ids) in enumerate(zip(split, found, strict=True)):
            if i in odd:
                out.append(odd[i])
            elif None in ids:
                out.append(b"".join([new[p] if v is None else v for p, v in zip(parts, ids, strict=True)]))
            else:
                out.append(b"".join(ids))
        return out


def encoder(spec: str, chunks: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file's content, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (hash(spec), len(spec), chunks)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(spec, chunks)
    return _encoders[key]


def read_text(path: str) -> str:
    """A vocabulary file's content, read once on the driver (a few MB, whatever the input)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
