"""Personal data by plain patterns, extended by a semi-Markov conditional random field.

The plain patterns give the base spans, and those always stay. The field reads the parts of
a text around digits and at-signs as short tokens (runs of letters, runs of digits, single
marks). A segmentation is a chain of single outside tokens and of entities of at most
``MAX_TOKENS`` tokens; each candidate entity is scored as a whole, by features of the whole
span (groups and number of digits, separators, checks such as Luhn, what stands around it),
and a dynamic program over segment ends picks boundaries and types together. Spans that the
field is sure of and that touch no base span are added: written-out addresses
(``name at mail dot com``), numbers without ``+``, bracketed dots.

The field is trained here, by maximum likelihood with the forward-backward sums, on examples
made from a fixed seed: written forms of each kind and look-alikes among filler. So it is
the same whatever the corpus.

Results: null text is empty and has no spans; offsets count code points, the end exclusive;
rows are independent, so repeated rows give equal results; other columns are ignored by
:func:`found` and kept by :func:`redacted`; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Most tokens of an entity, and tokens read on either side of a trigger.
MAX_TOKENS, AROUND = 24, 8
#: Most tokens of one chain: a longer one is cut where the most tokens lie between triggers.
MAX_CHAIN = 400
#: Least probability, under the field, of a span that is added.
SURE = 0.8
SEED, EXAMPLES, ROUNDS, RATE, DECAY = 11, 500, 60, 1.5, 1e-4


class Span(NamedTuple):
    kind: str
    start: int
    end: int


# Base ----------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(parts: list[str]) -> bool:
    return len(parts) == 4 and all(p and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their at-signs so that long runs cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        tail = _DOMAIN.match(text, at)
        start = at
        if tail:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if tail and start < at:
            yield Span("email", start, tail.end())
            done = tail.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """The plain patterns' spans, by kind and start."""
    out = list(_emails(text))
    if not re.search("[0-9]", text):
        return out
    out += [Span("ip", *m.span()) for m in _IP.finditer(text) if _octets(m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(Span("card", *m.span()))
    out += [Span("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


# Chains and candidate segments ---------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_NEAR = re.compile(
    r"[0-9@]|\b[Aa][Tt]\b(?=\s?[\])]?\s?[A-Za-z0-9-]+(?:\.[A-Za-z]|\s?[\[(]?\s?(?:[Dd][Oo][Tt]\b|\.\])))"
)


class Chain(NamedTuple):
    text: str
    starts: list[int]
    ends: list[int]


def chains(text: str) -> Iterator[Chain]:
    """Stretches of tokens around triggers: a digit, an at-sign, the word at before a host."""
    size = 40 * AROUND
    windows: list[list[int]] = []
    for m in _NEAR.finditer(text):
        low, high = max(0, m.start() - size), min(len(text), m.end() + size)
        if windows and low <= windows[-1][1]:
            windows[-1][1] = high
        else:
            windows.append([low, high])
    for low, high in windows:
        spans = [m.span() for m in _TOKEN.finditer(text, low, high)]
        sure = [bool(_NEAR.match(text, a)) for a, _ in spans]
        hits = [i for i, s in enumerate(sure) if s]
        first = 0
        while first < len(hits):
            last = first
            while (
                last + 1 < len(hits) and hits[last + 1] - hits[last] <= 2 * AROUND
                and hits[last + 1] - hits[first] < MAX_CHAIN
            ):
                last += 1
            part = spans[max(0, hits[first] - AROUND):hits[last] + AROUND + 1]
            yield Chain(text, [a for a, _ in part], [b for _, b in part])
            first = last + 1


_AT = re.compile(r"@|(?i:[\[(]\s*at\s*[\])]|(?<=\s)at(?=\s))")
_DOT = re.compile(r"(?i:[\[(]\s*dot\s*[\])]|\[\.\]|(?<=\s)dot(?=\s))")
FEATURES = (
    "bias", "at_sign", "at_word", "one_at", "dots", "dot_word", "domain_tail", "spaces", "local_part",
    "four_groups", "octets", "dot_separated", "bracket_dots", "no_letters", "card_digits", "luhn", "card_shape",
    "plus", "phone_digits", "parens", "phone_groups", "few_digits", "many_digits", "clean_left", "clean_right",
    "letters_and_digits", "one_number", "sentence_end",
)


def features(text: str, start: int, end: int) -> list[float]:
    """What the field sees of a whole candidate span."""
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall("[0-9]+", span)
    letters = any(c.isalpha() for c in span)
    at = _AT.findall(span)
    plain = _DOT.sub(".", span)
    dotted = [p.strip() for p in plain.split(".")]
    shape = [len(g) for g in groups]
    n = len(digits)
    split = _AT.split(span)
    tail = _DOT.sub(".", split[-1]).replace(" ", "") if at else ""
    local = split[0].strip() if at else ""
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    after = text[end + 1] if end + 1 < len(text) else " "
    only = lambda allowed: all(c in allowed or "0" <= c <= "9" for c in span)
    four = len(groups) == 4
    value = {
        "bias": 1, "at_sign": "@" in span, "at_word": bool(at) and "@" not in span, "one_at": len(at) == 1,
        "dots": "." in span, "dot_word": plain != span,
        "domain_tail": bool(re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,6}", tail)),
        "spaces": " " in _AT.sub("", _DOT.sub("", span)).strip() and bool(at),
        "local_part": bool(re.fullmatch(r"[A-Za-z0-9._%+-]+", local)),
        "four_groups": four, "octets": four and _octets(groups), "dot_separated": four and dotted == groups,
        "bracket_dots": four and "[" in span, "no_letters": not letters,
        "card_digits": 16 <= n <= 19, "luhn": 16 <= n <= 19 and luhn(digits),
        "card_shape": 16 <= n <= 19 and only(" -.") and (len(groups) == 1 or shape[:-1] == [4] * (len(groups) - 1)),
        "plus": span[0] == "+", "phone_digits": 8 <= n <= 15, "parens": "(" in span and ")" in span,
        "phone_groups": only(" ()-.+") and shape[-2:] == [3, 4] and len(groups) in (3, 4) and shape[0] <= 3,
        "few_digits": n < 4, "many_digits": n > 19,
        "clean_left": not (left.isalnum() or left in "+.@_/-="), "clean_right": not (
            right.isalnum() or right in "@_/=" or right in ".-" and after.isalnum()),
        "letters_and_digits": letters and n > 0 and not at, "one_number": len(groups) == 1 and not letters and n < 12,
        "sentence_end": span[-1] in ".,",
    }
    return [float(value[k]) for k in FEATURES]


def candidates(chain: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Segments (first token, last token) that could be entities, and their features."""
    text, starts, ends = chain
    n = len(starts)
    digit = [("0" <= text[s] <= "9") for s in starts]
    word = [text[s].isalnum() for s in starts]
    trigger = [bool(_NEAR.match(text, s)) for s in starts]
    segments, rows = [], []
    for i in range(n):
        if not (word[i] or text[starts[i]] in "+("):
            continue
        digits = at = 0
        for j in range(i, min(n, i + MAX_TOKENS)):
            if j > i and starts[j] - ends[j - 1] > 1:
                break  # more than one space, or a new line with indentation
            if j > i and starts[j] > ends[j - 1] and text[ends[j - 1]] != " ":
                break
            digits += (ends[j] - starts[j]) * digit[j]
            at += trigger[j] and not digit[j]
            if not word[j] or (digits < 8 and not at and digits < 4) or at > 1:
                continue
            if not at and not digit[j]:
                break  # numbers do not end in letters, nor go on after them
            segments.append((i, j))
            rows.append(features(text, starts[i], ends[j]))
    if not segments:
        return np.zeros((0, 2), int), np.zeros((0, len(FEATURES)))
    return np.array(segments), np.array(rows)


# The field -----------------------------------------------------------------------------

def _forward(n: int, segments: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Log sums over segmentations of the first tokens; an outside token scores 0."""
    a = np.zeros(n + 1)
    by_end: list[list[int]] = [[] for _ in range(n)]
    for k, (_, j) in enumerate(segments):
        by_end[j].append(k)
    total = np.logaddexp.reduce(scores, axis=1) if len(segments) else scores
    for j in range(n):
        if by_end[j]:
            a[j + 1] = np.logaddexp.reduce([a[j], *(a[segments[k][0]] + total[k] for k in by_end[j])])
        else:
            a[j + 1] = a[j]
    return a


def marginals(n: int, segments: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Probability of each segment and kind, by sums from both ends."""
    if not len(segments):
        return np.zeros((0, len(KINDS)))
    a = _forward(n, segments, scores)
    mirrored = np.column_stack([n - 1 - segments[:, 1], n - 1 - segments[:, 0]])
    b = _forward(n, mirrored, scores)[::-1]
    return np.exp(a[segments[:, 0]][:, None] + scores + b[segments[:, 1] + 1][:, None] - a[n])


def best(n: int, segments: np.ndarray, scores: np.ndarray) -> list[tuple[int, int]]:
    """The best segmentation's entities, as (segment, kind)."""
    value, back = [0.0] * (n + 1), [None] * (n + 1)
    kind = scores.argmax(axis=1) if len(segments) else []
    by_end: dict[int, list[int]] = {}
    for k, (_, j) in enumerate(segments):
        by_end.setdefault(int(j), []).append(k)
    for j in range(n):
        value[j + 1] = value[j]
        for k in by_end.get(j, ()):
            v = value[segments[k][0]] + scores[k, kind[k]]
            if v > value[j + 1]:
                value[j + 1], back[j + 1] = v, k
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            out.append((back[j], int(kind[back[j]])))
            j = int(segments[back[j]][0])
    return out[::-1]


def _examples() -> list[tuple[str, list[Span]]]:
    """Texts with known spans, from a fixed seed."""
    r = random.Random(SEED)
    word = lambda: "".join(r.choice("abcdefghilmnoprstuvw") for _ in range(r.randint(2, 9)))
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card(valid: bool) -> str:
        while luhn(d := digits(r.choice((16, 16, 16, 19)))) != valid:
            pass
        return r.choice((d, " ".join(d[i:i + 4] for i in range(0, len(d), 4)), "-".join(d[i:i + 4] for i in range(0, len(d), 4)),
                         ".".join(d[i:i + 4] for i in range(0, len(d), 4))))

    def email() -> str:
        name = r.choice((word(), f"{word()}.{digits(2)}", f"{word()}.{word()}", f"{word()}{digits(3)}"))
        host, top = f"{word()}{r.choice(('', digits(1)))}", r.choice(("com", "org", "net", "de"))
        middle = r.choice(("", f"{word()}."))
        return r.choice((
            f"{name}@{host}.{middle}{top}", f"{name} at {host} dot {top}", f"{name} (at) {host} (dot) {top}",
            f"{name} [at] {host} [dot] {top}", f"{name}[at]{host}[dot]{top}", f"{name}(at){host}.{top}",
        ))

    def ip(high: int) -> str:
        p = [str(r.randint(0, 255)) for _ in range(4)]
        if high > 255:
            p[r.randrange(4)] = str(r.randint(256, 999))
        return r.choice((".", ".", "[.]", " . ")).join(p)

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"+{digits(2)} {a} {b} {c}", f"({a}) {b} {c}"))

    def unlike() -> str:
        return r.choice((
            f"{r.randint(1900, 2030)}", f"{r.randint(1, 9)}.{r.randint(0, 9)}.", f"{r.randint(1, 12)}.{r.randint(0, 30)}.{r.randint(0, 99)}",
            f"{r.randint(1900, 2030)}-{digits(2)}-{digits(2)}", card(False), ip(999), digits(r.randint(4, 15)), f"{word()} at {word()} {word()}",
            f"met at {r.randint(1, 12)} dot {word()}", f'token = "{hashlib.sha1(digits(9).encode()).hexdigest()}"', f"{digits(2)}:{digits(2)}",
            f"{r.randint(1, 999)},{digits(3)}", f"@{word()}", f"{word()}@{word()}", f"{digits(3)} {digits(3)}", f"{digits(4)}-{digits(4)}",
            f"{word()} at {word()}.{word()} dot", f"{digits(25)}", f"{digits(3)}-{digits(2)}-{digits(4)}-{digits(3)}", f"{digits(5)}/{digits(4)}",
        ))

    made = (("email", email), ("ip", lambda: ip(255)), ("card", lambda: card(True)), ("phone", phone))
    out = []
    for _ in range(EXAMPLES):
        text, spans = " ".join(word() for _ in range(r.randint(0, 6))), []
        for _ in range(r.randint(1, 3)):
            text += " " * bool(text)
            if r.random() < 0.55:
                kind, make = r.choice(made)
                value = make()
                spans.append(Span(kind, len(text), len(text) + len(value)))
                text += value
            else:
                text += unlike()
            text += r.choice(("", "", ".", ",", "!!", "###")) + " " + " ".join(word() for _ in range(r.randint(1, 5)))
        out.append((text, spans))
    return out


@functools.cache
def trained() -> np.ndarray:
    """Weights by feature and kind: gradient ascent on the examples' log likelihood."""
    data, size = [], 0
    for text, spans in _examples():
        for chain in chains(text):
            segments, x = candidates(chain)
            if not len(segments):
                continue
            y = np.zeros((len(segments), len(KINDS)))
            place = {(chain.starts[i], chain.ends[j]): k for k, (i, j) in enumerate(segments)}
            for s in spans:
                if (k := place.get((s.start, s.end))) is not None:
                    y[k, KINDS.index(s.kind)] = 1
            data.append((len(chain.starts), segments, x, y))
            size += 1
    w = np.zeros((len(FEATURES), len(KINDS)))
    w[0] = -2.0
    square = np.full_like(w, 1e-8)
    for _ in range(ROUNDS):
        grad = -DECAY * w * size
        for n, segments, x, y in data:
            grad += x.T @ (y - marginals(n, segments, x @ w))
        square += grad * grad
        w = w + RATE * grad / np.sqrt(square)
    return w


def all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that the field adds, by kind and start."""
    base = base_spans(text)
    if not _NEAR.search(text):
        return base, base
    added = []
    for chain in chains(text):
        segments, x = candidates(chain)
        if not len(segments):
            continue
        scores = x @ weights
        n = len(chain.starts)
        chosen = best(n, segments, scores)
        if not chosen:
            continue
        sure = marginals(n, segments, scores)
        for k, kind in chosen:
            s = Span(KINDS[kind], chain.starts[segments[k][0]], chain.ends[segments[k][1]])
            if sure[k, kind] >= SURE and not any(b.start < s.end and s.start < b.end for b in base):
                added.append(s)
    kept: list[Span] = []
    for s in sorted(set(added), key=lambda s: (s.start, s.end)):
        if not kept or s.start >= kept[-1].end:
            kept.append(s)
    return base, sorted(base + kept, key=lambda s: (KINDS.index(s.kind), s.start))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def found(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Numbers of base spans per kind, their hash, and all spans, one row per document."""
    weights = trained()
    schema = pa.schema(
        [("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [all_spans(x or "", weights) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                *[pa.array([sum(s.kind == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS],
                pa.array([hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in rows]),
                pa.array([_written(every) for _, every in rows]),
            ], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(text: str, weights: np.ndarray) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, done = [], 0
    merged: list[Span] = []
    for s in sorted(all_spans(text, weights)[1], key=lambda s: (s.start, s.end)):
        if merged and s.start < merged[-1].end:
            merged[-1] = merged[-1]._replace(end=max(s.end, merged[-1].end))
        else:
            merged.append(s)
    for s in merged:
        out += [text[done:s.start], f"[{s.kind.upper()}]"]
        done = s.end
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null stays null."""
    weights = trained()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else redact(x, weights))

    return docs.withColumn(text, clean(F.col(text)))
