"""Vectors linked by rotated codes, the trie of conversations, and token alignment, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex

from ebbtide.llm import fragments, prefix_trie, rotated_codes
from ebbtide.llm import queries as corpus
from ebbtide.llm.fragments import Fragment, Tokens

# Vectors -------------------------------------------------------------------------------

def links_by_force(rows, least):
    """(vec_id, n_links, component_id, kept) of every row, sorted."""
    ok = [
        label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    n = len(rows)
    near = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= least:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least_id = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least_id, rows[i][0] == least_id))
    return sorted(out, key=repr)


def linked(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, node int")
    return sorted(map(tuple, rotated_codes.near_duplicates(df, **options).collect()), key=repr)


def crowd(rng, n, dim, noise):
    centre = rng.standard_normal(dim)
    return [[float(np.float32(x)) for x in centre + rng.standard_normal(dim) * noise] for _ in range(n)]


@pytest.mark.parametrize("dim", [1, 2, 3, 16, 64])
def test_links_equal_all_pairs(spark, dim):
    rng = np.random.default_rng(dim)
    vectors = [v for n, noise in [(60, 0.05), (20, 0.1), (15, 0.12), (40, 2.0)] for v in crowd(rng, n, dim, noise)]
    vectors += vectors[:5] + [[2 * x for x in v] for v in vectors[60:64]]
    rows = [(1000 - i, v, int(rng.integers(2))) for i, v in enumerate(vectors)]
    assert linked(spark, rows) == links_by_force(rows, 0.98)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(rotated_codes, "BLOCK", 16)
    monkeypatch.setattr(rotated_codes, "GROUP_ROWS", 64)
    rng = np.random.default_rng(3)
    rows = [(i, v, 1) for i, v in enumerate(crowd(rng, 150, 32, 0.1) + crowd(rng, 60, 32, 1.0))]
    # Tasks that import the module anew have its own sizes: compare in this process.
    assert linked(spark, rows) == links_by_force(rows, 0.98)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 2.0], 1), (7, [float("nan"), 1.0, 1.0], 1),
        (8, [float("inf"), 1.0, 1.0], 1), (None, v, 1), (9, [2.0, 4.0, 6.0], 1), (9, v, 1), (9, v, 1), (10, v, 2), (11, [1.0, 2.0], 1),
        (12, [-1.0, -2.0, -3.0], 1), (None, [1.0, 0.0, 0.0], 3), (13, [-0.0, 1.0, 0.0], 4), (14, [0.0, 1.0, 0.0], 4),
        (15, [1e38, 1e38, 0.0], 5), (16, [1e-38, 1e-38, 0.0], 5),
    ]
    assert linked(spark, rows) == links_by_force(rows, 0.98)
    assert linked(spark, rows[1:1]) == []
    assert linked(spark, [(1, None, None)]) == [(1, 0, 1, True)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    a = rotated_codes.units_of(rng.standard_normal((4000, 48)))
    other = rotated_codes.units_of(rng.standard_normal((4000, 48)))
    other -= (other * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * rotated_codes.units_of(other)
    codes, along, scale = rotated_codes.encode(a, 528)
    error = (rotated_codes.estimator(codes, along, 48) * b).sum(axis=1) - 0.98
    assert abs(error.mean()) < 4 * error.std() / math.sqrt(len(a))
    assert (error + 0.98 >= rotated_codes.least_estimate(scale, 48, 0.98)).all()
    assert error.std() < scale.mean() * 0.2 / math.sqrt(47) * 1.1


def test_bands_leave_out_one_pair_in_a_million():
    for rows in (1, 1000, 10**6, 10**9):
        bits, bands = rotated_codes.band_plan(rows, 0.98)
        agree = (1 - math.acos(0.98) / math.pi) ** bits
        assert (1 - agree) ** bands <= 1e-6 and bits % 8 == 0 and 2**bits >= rows


# Conversations -------------------------------------------------------------------------

def trie_by_force(rows):
    """Node rows by (conv_id, depth), from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    made = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + t[h:])
    members = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(regex.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if made[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def talks(seed, n, longest, words=3):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, longest)):
            rows.append((c, t, r.choice(["user", "assistant"][: 1 + t % 2]), " ".join("ab"[: 1 + r.randrange(2)] for _ in range(r.randint(0, words)))))
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "p") for r in rows], "conv_id long, turn long, role string, text string, skeleton int, path string")


@pytest.mark.parametrize("seed,n,longest", [(1, 300, 4), (2, 150, 30), (3, 40, 3)])
def test_trie_equals_brute_force(spark, seed, n, longest):
    rows = talks(seed, n, longest)
    got = prefix_trie.prefix_trie(frame(spark, rows)).select(*TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)


@pytest.mark.parametrize("shard_rows,split_turns", [(1, 128), (3, 1), (7, 2), (10**6, 4)])
def test_trie_is_the_same_whatever_the_shards(spark, shard_rows, split_turns):
    rows = talks(5, 120, 6) + [(c, t, "user", "same") for c in range(200, 260) for t in range(5)]
    paths = prefix_trie.rebuilt(prefix_trie.turns(frame(spark, rows)))
    got = prefix_trie.trie(paths, shard_rows, split_turns).select(*TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)


def test_odd_conversations(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "a b"), (1, 2, "user", ""), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 0, "user", "lost"),
        (-3, 0, "user", "neg"), (-41, 1, "user", "neg"), (-41, 0, None, "n"), (40, 0, "user", "one two\x0bthree four"), (41, 0, "user", "y"),
        (43, 5, "user", "long " * 5000), (45, 5, "user", "long " * 5000), (45, 6, "a\x1fb", "c"), (60, 1, "ab", "c"), (61, 1, "a", "bc"),
    ]
    got = prefix_trie.prefix_trie(frame(spark, rows)).select(*TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)
    assert prefix_trie.prefix_trie(frame(spark, rows[:1]).where("false")).count() == 0


def test_turns_may_be_absent(spark):
    rows = [(c, 0, "user", "only") for c in range(21, 40)]  # no conversation 20: some lose their turn
    want = trie_by_force(rows)
    assert any(r[1] == 0 and r[7] != prefix_trie.EMPTY for r in want)
    assert sorted(map(tuple, prefix_trie.prefix_trie(frame(spark, rows)).select(*TRIE).collect()), key=repr) == want


# Alignment -----------------------------------------------------------------------------

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def make():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        return fragments.Aligner(f.read(), g.read())


def alignment_by_force(make, rows):
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of (doc_id, text)."""
    docs, counts = [], Counter()
    for doc, text in rows:
        a = make.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = make.b.encode(text) if text else []
        want = (" " + text).encode() if text else b""
        if not text or b"".join(make.bytes_a[i] for i in a) != want or b"".join(make.bytes_b[i] for i in b) != want:
            docs.append((doc, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(make.bytes_a[i]) for i in a]), np.cumsum([len(make.bytes_b[i]) for i in b])
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = [([], []) for _ in common]
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            for i, e in zip(ids, ends.tolist(), strict=True):
                groups[np.searchsorted(common, e)][side].append(i)
        docs.append((doc, a, b, groups))
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc, a, b, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


ODD = [
    "", None, " ", "  \n\n x", "a\r\nb \r c;\r\n", "plain words, and more.\nNext line's  end ", "<s> </s> <|endoftext|> <unk> <0x0A>", "a▁b",
    "日本語のテキスト、句読点。", "naïve café   　x ", "\x00\x1c\x1d \x85  ", "emoji 😀👩‍👩‍👧 ok", "x" * 3000, "don't can't we'll I'm",
    "1234567 3.14 a1b2", "tab\tand\t\ttabs", "Ελληνικά кириллица עברית", "é é ﬁ", "a" * 50 + " " * 60 + "b", "\n" * 40,
]


def documents(seed, n, longest):
    r = random.Random(seed)
    words = ["the", "quick", "Brown", "fox,", "it's", "naïve", "日本", "1999", "(x)", "\n", "\t", "  ", "a.b-c", "zz\r", "Überraschung", "end."]
    return [" ".join(r.choice(words) for _ in range(r.randint(1, longest))) for _ in range(n)] + ODD


def aligned(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "b", 1) for d, t in rows], "doc_id long, text string, block string, pair int")
    columns = ("doc_id", *fragments.COUNTS, "n_best", "count_sum", "groups_sha256")
    return sorted(map(tuple, fragments.aligned(df, A, B, **options).select(*columns).collect()), key=repr)


def test_alignment_equals_brute_force(spark, make):
    rows = list(enumerate(documents(1, 60, 60))) + [(3, "again a key"), (None, "no key"), (3, "again a key")]
    assert aligned(spark, rows, block_chars=3000) == alignment_by_force(make, rows)


@pytest.mark.parametrize("chunk", [7, 50, 400])
def test_long_texts_go_through_the_tree(spark, make, chunk):
    rows = list(enumerate(documents(2, 12, 300)))
    assert aligned(spark, rows, chunk_chars=chunk) == alignment_by_force(make, rows)


def test_alignment_of_nothing(spark):
    assert aligned(spark, []) == []
    assert aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_fragments_compose_in_any_order():
    """Any cut of both token rows into ranges, put together in any order, gives the same groups."""
    r = random.Random(7)
    for _ in range(200):
        total = r.randint(1, 40)
        ends = [sorted({*r.sample(range(1, total + 1), r.randint(0, total // 2)), total}) for _ in range(2)]
        a, b = (Tokens(np.arange(len(e)), np.array(e)) for e in ends)
        whole, _ = fragments.cut(a, b)
        n = r.randint(1, 6)
        cuts = [[0, *sorted(r.randint(0, len(e)) for _ in range(n - 1)), len(e)] for e in ends]
        parts, closed = [], {}
        for i in range(n):
            made, groups = Fragment.of(i, a.part(*cuts[0][i:i + 2]), b.part(*cuts[1][i:i + 2]), True)
            parts.append(made)
            closed[i, 1] = groups
        while len(parts) > 1:
            at = r.randrange(len(parts) - 1)
            made, groups = parts[at].then(parts[at + 1])
            closed[parts[at + 1].start, 0] = groups
            parts[at:at + 2] = [made]
        flat = lambda groups: [(g[0].ids.tolist(), g[1].ids.tolist()) for g in groups]
        assert flat(g for k in sorted(closed) for g in closed[k]) == flat(whole)
        assert not len(parts[0].suffix[0].ids) and not len(parts[0].prefix[0].ids)


def test_queries_on_given_tables(spark, make):
    folder = "/root/testdata/sf0.001"
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    vectors = [(r[0], list(r[1]), r[2]) for r in table("embeddings").select("vec_id", "embedding", "label").collect()]
    got = corpus.QUERIES["op11_rotated_codes"](spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == links_by_force(vectors, 0.98)
    rows = [tuple(r) for r in table("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = corpus.QUERIES["op12_prefix_trie"](spark, folder).select(*TRIE).collect()
    assert sorted(map(tuple, got), key=repr) == trie_by_force(rows)
    docs = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    got = corpus.QUERIES["op13_fragments"](spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == alignment_by_force(make, docs)
