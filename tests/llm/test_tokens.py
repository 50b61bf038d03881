"""Token shards with their index, BPE by folding, and packing."""

import hashlib
import json
import multiprocessing
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from ebbtide.llm import bpe, packing, token_store
from ebbtide.llm.common import ChunkEncoder, by_letters, encoder, read_text

FILES = {"words": "word_bpe_49k.json", "spaced": "byte_bpe_50k.json"}


def whole(file, texts):
    t = Tokenizer.from_file(public_tokenizers.path(file))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunks", FILES)
def test_parts_give_the_ids_of_whole_texts(chunks):
    r = random.Random(3)
    odd = [chr(c) for c in (0x1C, 0x85, 0xA0, 0x130, 0x2028, 0x3000, 0x301, 0xFB01, 0x1F600, 0x660, 0xB2, 0x3A3, 0x200B)]
    bits = ["the", " ", "  ", "\n", ".", "'s", "'", "don't", "Sun", "!", "x" * 70, "<|endoftext|>", "42", "-", "_", "\t", *odd]
    texts = ["", " ", "a b"] + ["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(3000)]
    own = encoder(read_text(public_tokenizers.path(FILES[chunks])), chunks)
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)]
    assert got == whole(FILES[chunks], texts)


def words_encoder():
    return ChunkEncoder(read_text(public_tokenizers.path(FILES["words"])), "words")


def test_word_parts_of_latin_texts_give_the_ids_of_whole_texts():
    r, own = random.Random(4), words_encoder()
    bits = [*"aeJjßéÈöÿÅ×÷İıǅȳɏɐµª1", "\u0301", "\u030c", "\u0307", "\u212a", "\u212b", "\x1d", "\xa0", "\u3000", "\0"]
    bits += [*"  \n\t\r\x0b\x0c", "'s", "'", ",", ".", "!!", "###", "<|endoftext|>", "w", "word"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(20_000)] + ["\n", "", " ,", "é,", "É"]
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)] == whole(FILES["words"], texts)
    for few in ([], [""], [" ", ""], ["\xa0"], ["\u3000", "\xa0 \xa0"]):
        assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(few)] == whole(FILES["words"], few)


def test_a_word_is_looked_up_once_and_latin_words_need_no_normalizer():
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    own, singly = words_encoder(), []
    own.memo, own._whole = Counted(), lambda parts: singly.extend(parts) or ChunkEncoder._whole(own, parts)
    texts = ["Größe, année niño " * 50] * 20
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)] == whole(FILES["words"], texts)
    assert own.memo.asked == 4 and singly == [","]


def test_only_the_known_tokenizer_skips_its_normalizer():
    spec = json.loads(read_text(public_tokenizers.path(FILES["words"])))
    assert by_letters(json.dumps(spec))
    assert by_letters(read_text(public_tokenizers.path(FILES["spaced"]))) is None
    split, level = spec["pre_tokenizer"]["pretokenizers"]
    for change in (
        {"normalizer": None}, {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": split},
        {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [{**split, "pattern": {"Regex": "."}}, level]}},
        {"model": {**spec["model"], "end_of_word_suffix": None}},
        {"added_tokens": [{**t, "special": False} for t in spec["added_tokens"]]},
    ):
        assert by_letters(json.dumps({**spec, **change})) is None, change


def test_store_gives_back_every_document(spark, odd_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    store = token_store.write(odd_docs, path, end_id=1)
    rows = token_store.read(store, odd_docs).collect()
    docs = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda x: (x.doc_id is not None, x.doc_id or 0))
    ids = [x + [1] for x in whole("word_bpe_49k.json", [d.text or "" for d in docs])]
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((d.doc_id, tuple(x)) for d, x in zip(docs, ids))
    rows = sorted(rows, key=lambda x: x.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    digest = token_store.read(store, odd_docs, digests=True).collect()
    assert sorted(x.ids_crc32 for x in digest) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)
    some = token_store.read(store, spark.createDataFrame([(9,), (777,)], "doc_id long")).collect()
    assert [x.doc_id for x in some] == [9]
    store.remove()


def test_store_of_nothing(spark, no_docs, odd_docs):
    store = token_store.write(no_docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    assert token_store.read(store, odd_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    one, two = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    sizes, marks = token_store.build_hash(one, two)
    assert sorted(token_store.slots(sizes, marks, one, two).tolist()) == list(range(n))
    if n >= 1000:  # strangers are told by their fingerprints
        a, b = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64)
        slot = token_store.slots(sizes, marks, a, b)
        prints = np.zeros(n, "<u4")
        prints[token_store.slots(sizes, marks, one, two)] = token_store.fingerprints(one, two)
        assert (prints[slot[slot >= 0]] == token_store.fingerprints(a, b)[slot >= 0]).sum() == 0


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        token_store.build_hash(np.array([5, 5], np.uint64), np.array([7, 7], np.uint64))


def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_bpe_as_the_library_does(spark, odd_docs):
    own = ranks()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens={})
    docs = odd_docs.collect()
    expect = Counter((d.doc_id, tuple(library.encode_ordinary(d.text or ""))) for d in docs)
    encoded = bpe.encode(odd_docs, own, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == expect
    back = encoded.select("doc_id", bpe.decode(encoded["ids"], own).alias("raw")).collect()
    assert Counter((r.doc_id, bytes(r.raw)) for r in back) == Counter((d.doc_id, (d.text or "").encode()) for d in docs)
    digests = bpe.encode(odd_docs, own, public_tokenizers.PATTERN, digests=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == Counter((
        d.doc_id, len(i := library.encode_ordinary(d.text or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
        hashlib.sha256((d.text or "").encode()).hexdigest()) for d in docs)


def test_fold_and_heap_agree(spark):
    own, r = ranks(), random.Random(8)
    words = ["".join(r.choice("abeinorst éß日") for _ in range(r.randint(1, 40))) for _ in range(300)] + ["ab" * 200, "é" * 127, "x" * 257]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for row in bpe.encode_words(df, own, ["word"]).collect():
        assert row.ids == bpe.merged(row.word.encode(), own), row.word


def test_bpe_of_nothing(no_docs):
    assert bpe.encode(no_docs, ranks(), public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("some_words", [1 << 17, 3])
def test_words_of_plain_texts_are_found_together(monkeypatch, some_words):
    monkeypatch.setattr(bpe, "SOME_WORDS", some_words)
    find, r = regex.compile(public_tokenizers.PATTERN).findall, random.Random(8)
    some = ["a", "B", "don't", "42", "!", "x.", "é", "日本", "'s", " ", " ", "\n", "\n", "\t", "\u3000", "\x1c", "\xa0"]
    for _ in range(300):
        texts = [None if r.random() < 0.1 else "".join(r.choice(some) for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 6))]
        codes = {}
        got = bpe.word_numbers(pa.array(texts, pa.string()), find, codes)
        words = list(codes)
        for text, numbers in zip(texts, got, strict=True):
            if re.search(r"[^\S \n]|\s\s|^\s|\s\Z|^\Z", text or ""):
                assert numbers is None, text
            else:
                assert [words[i] for i in numbers.tolist()] == find(text), text
    assert bpe.word_numbers(pa.array(["b a\nb"]), find, {}) is not None


def test_a_split_leaves_no_memory_with_its_worker(spark, monkeypatch):
    """Idle workers stay on their executor: what 24 MB of text took is given back to the system at the end."""
    docs, seen, r = spark.createDataFrame([(1, "a")], "doc_id long, text string"), [], random.Random(6)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: seen.append(f) or self)
    monkeypatch.setattr(bpe, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    bpe._split(docs, public_tokenizers.PATTERN, 4, "text", "doc_id")

    def held_mb():
        with open("/proc/self/status") as f:
            return int(re.search(r"RssAnon:\s+(\d+)", f.read())[1]) / 1024

    def made():
        words = ["".join(r.choices("abeinorst", k=r.randint(2, 12))) for _ in range(200_000)]
        for at in range(2):
            texts = [" ".join(r.choices(words, k=500)) for _ in range(3000)]
            yield pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(texts, pa.string())], names=["doc_id", "text"])

    def measured(queue):
        batches = list(made())
        before, kinds = held_mb(), Counter()
        for batch in seen[0](iter(batches)):
            kinds.update(batch.column(0).to_pylist())
        queue.put((kinds["doc"], held_mb() - before))

    fork = multiprocessing.get_context("fork")
    queue = fork.Queue()
    child = fork.Process(target=measured, args=(queue,))
    child.start()
    n_docs, more = queue.get(timeout=120)
    child.join()
    assert n_docs == 6000 and more < 20, more


def one_by_one(lengths, capacity):
    """Best-fit decreasing, a piece at a time over a plain list."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, left in enumerate(room) if left >= n]
        if fits:
            room[min(fits, key=lambda i: (room[i], i))] -= n
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("seed", range(25))
def test_best_fit_as_one_by_one(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 7, 20, 64])
    lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 300))]
    places, sequences = packing.best_fit_decreasing(Counter(lengths), capacity)
    assert sequences == one_by_one(lengths, capacity)
    taken = Counter()
    for p in places:
        for k in range(p.high - p.low):
            for at in range(p.length):
                cell = (p.sequence + k // p.each, p.offset + k % p.each * p.length + at)
                taken[cell] += 1
    assert sum(taken.values()) == sum(lengths) and max(taken.values(), default=1) == 1
    for s in range(sequences):
        own = sorted(at for q, at in taken if q == s)
        assert own == list(range(len(own))) and len(own) <= capacity


def test_tree_finds_the_tightest():
    r, tree, marked = random.Random(1), packing.FirstAtLeast(37), set()
    for _ in range(2000):
        at = r.randint(0, 37)
        tree.mark(at, at not in marked)
        marked ^= {at}
        least = r.randint(0, 37)
        assert tree.find(least) == min((m for m in marked if m >= least), default=None)


def test_packed_documents(odd_docs, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.packed_documents(odd_docs, path, 2, 64).collect()
    ids = whole("byte_bpe_50k.json", [d.text or "" for d in odd_docs.collect()])
    assert sum(r.length for r in rows) == sum(len(x) + 1 for x in ids)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda x: x.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    long = sorted((r for r in rows if r.doc_id == 11), key=lambda r: r.piece)
    assert all(r.length == 64 for r in long[1:]) and [r.start for r in long] == np.cumsum([0] + [r.length for r in long])[:-1].tolist()
    assert packing.packed_documents(no_docs, path, 2, 64).count() == 0
