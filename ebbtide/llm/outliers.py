"""Quality rules: counts per document, and robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. For every group of language and
source, a minimum-covariance-determinant estimate is made: from a start without outliers
(medians and scaled deviations), concentration steps keep the part ``SUPPORT`` of the rows
that lies nearest and take mean and covariance of those, until the determinant no longer
falls. A document is rejected if its squared Mahalanobis distance, scaled so that the
median row is as far as under a normal distribution, exceeds the chi-square value of
``LEVEL``, or if a plain rule fails (too few words, too much repeated).

Every step is an aggregate of sums per group over all rows; quantiles come from counts on a
fixed grid of distances, so they are the same in whatever order rows arrive. The statistics
are written once and are a few numbers per document. A group, however large, is only ever
summed. Groups with fewer than ``LEAST_ROWS`` documents use the estimate of their language,
and if that has too few as well, the estimate over all rows; a table with fewer rows is
judged by the plain rules alone. ``FLOOR`` is added to the
variances: differences below it are no reason to reject, also where most rows are equal.

Results: null text has no words and fails the plain rule; null languages and sources are
groups of their own; rows that repeat a key are judged each by itself, one row each; other
columns are ignored by :func:`judged` and kept by :func:`kept_documents`; an empty table gives
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import dropped, stored

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\r\x0b\x0c"
WINDOW = 5
MIN_WORDS = 10
#: Part of a group's rows that an estimate is made from.
SUPPORT = 0.75
#: Most concentration steps; a handful is enough for the determinant to settle.
STEPS = 6
LEAST_ROWS = 40
#: Chance of a normal row to lie beyond the limit.
LEVEL = 1e-9
#: Cells of the distance grid per doubling.
CELLS = 64

#: Transformed statistics and what is added to their variances.
STATISTICS = {
    "mean_word": 0.10, "symbols": 0.10, "dup_lines": 0.35, "repeats": 0.35, "variety": 0.10,
    "capitals": 0.10, "marks": 0.10,
}
FLOOR = tuple(v * v for v in STATISTICS.values())
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    code, distinct = ids[:n], len(number)
    for i in range(1, width):
        if distinct * len(number) >= 2**62:  # number the prefixes anew, so that codes stay exact
            found, code = np.unique(code, return_inverse=True)
            distinct = len(found)
        code = code * len(number) + ids[i:i + n]
        distinct *= len(number)
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[inverse] > 1)
    if not len(starts):
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def counts_of(text: str) -> dict[str, float]:
    """The contract's counts of one text, and its transformed statistics."""
    raw = text.encode()
    words = raw.split()
    spaces = sum(text.count(c) for c in SPACE)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    n, chars = len(words), len(text) - spaces
    out = {
        "n_words": n, "word_chars": chars, "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": dup, "n_repeat_words": repeated_words(words, WINDOW),
    }
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = sum(raw.count(c) for c in b".,;:!?")
    share = lambda a, b: a / b if b else 0.0
    return out | {
        "mean_word": math.log(share(chars, n) or 1.0),
        "symbols": math.asinh(10 * share(out["n_symbols"], n)),
        "dup_lines": math.asinh(5 * share(dup, lines)),
        "repeats": math.asinh(5 * share(out["n_repeat_words"], n)),
        "variety": math.log(len(set(words)) + 1) / math.log(n + 1) if n > 1 else 1.0,
        "capitals": math.asinh(5 * share(capitals, chars)),
        "marks": math.asinh(5 * share(marks, n)),
    }


def _version(text: str) -> Column:
    """What tells rows of one key apart: a verdict follows from text, language and source."""
    return F.xxhash64(F.col(text).cast("string"), F.col("lang").cast("string"), F.lit("|"), F.col("source").cast("string"))


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, plain verdict and statistic vector ``x`` of every document."""
    fields = [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), ("version", pa.int64())]
    fields += [(k, pa.int64()) for k in COUNTS] + [("x", pa.list_(pa.float64()))]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(x or "") for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3)]
                + [pa.array([f[k] for f in found], pa.int64()) for k in COUNTS]
                + [pa.array([[f[k] for k in STATISTICS] for f in found], pa.list_(pa.float64()))],
                schema=schema,
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), _version(text).alias("version"), F.col(text).cast("string").alias("text"),
    )
    kinds = ", ".join(f"{k} long" for k in COUNTS)
    out = rows.mapInArrow(run, f"doc_id long, lang string, source string, version long, {kinds}, x array<double>")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


# The estimate --------------------------------------------------------------------------

def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows, sums and sums of products of ``x`` per group, for the rows with ``inside``."""
    p = len(STATISTICS)
    x = [F.col("x")[i] for i in range(p)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(p) for j in range(i + 1)]
    return rows.where("inside").groupBy(*by).agg(F.count("*").alias("n"), *sums, *products).select(
        *by, "n", F.array(*[f"s{i}" for i in range(p)]).alias("sums"),
        F.array(*[f"p{i}_{j}" for i in range(p) for j in range(i + 1)]).alias("products"),
    )


def _estimates(moments: DataFrame, by: list[str]) -> DataFrame:
    """Centre, inverse covariance (row by row) and log determinant per group."""
    p = len(STATISTICS)

    @F.pandas_udf("struct<centre:array<double>,inverse:array<double>,logdet:double>")
    def solve(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        out = []
        for count, s, q in zip(n, sums, products, strict=True):
            mean = np.asarray(s) / count
            square = np.zeros((p, p))
            square[np.tril_indices(p)] = q
            square = square + np.tril(square, -1).T
            cov = square / count - np.outer(mean, mean) + np.diag(FLOOR)
            out.append((mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
        return pd.DataFrame(out, columns=["centre", "inverse", "logdet"])

    return moments.select(*by, solve("n", "sums", "products").alias("e")).select(*by, "e.*")


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from the row's ``centre`` by its ``inverse``."""
    p = len(STATISTICS)
    d = [F.col("x")[i] - F.col("centre")[i] for i in range(p)]
    terms = [(1 if i == j else 2) * d[i] * d[j] * F.col("inverse")[i * p + j] for i in range(p) for j in range(i + 1)]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _cell(d: Column) -> Column:
    """The grid cell of a distance; cells are as wide as a fixed part of their distance."""
    return F.floor(F.log2(d + 1e-6) * CELLS).cast("int")


def _cell_at(cells: DataFrame, by: list[str], part: float, *keep: Column) -> DataFrame:
    """Per group the first cell with at least ``part`` of the rows up to it, and aggregates to ``keep``."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("cell")
    total = F.sum("n").over(Window.partitionBy(*by))
    return (
        cells.withColumn("up_to", F.sum("n").over(w)).withColumn("total", total)
        .where(F.col("up_to") >= part * F.col("total")).groupBy(*by).agg(F.min("cell").alias("limit_cell"), *keep)
    )


def _joined(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their group's values; groups without one drop out. Null names match."""
    own = groups.select(*[F.col(c).alias(f"{c}__") for c in by], *[c for c in groups.columns if c not in by])
    on = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in by]
    return rows.join(own, on).drop(*[f"{c}__" for c in by])


def robust_estimates(vectors: DataFrame, by: list[str]) -> DataFrame:
    """Minimum-covariance-determinant centre, inverse covariance and scale for groups of LEAST_ROWS or more.

    ``vectors`` has ``by`` and ``x`` and is read twice at each step. What a step finds per group is
    stored, so its size is known when it meets the rows: they are not shuffled to meet a small table,
    and the driver's plans do not grow with the steps.
    """
    p = len(STATISTICS)
    # The start: medians and deviations from them, statistic by statistic, on a fixed grid.
    one = vectors.select(*by, F.posexplode("x").alias("i", "v"))
    grid = stored(one.groupBy(*by, "i", F.round(F.col("v") * 1000).cast("int").alias("cell")).agg(F.count("*").alias("n")), "grid")
    large = grid.where("i = 0").groupBy(*by).agg(F.sum("n").alias("rows")).where(F.col("rows") >= LEAST_ROWS)
    middle = _cell_at(grid, [*by, "i"], 0.5).withColumnRenamed("limit_cell", "middle")
    spread = _joined(grid, middle, [*by, "i"]).groupBy(*by, "i", F.abs(F.col("cell") - F.col("middle")).alias("cell")).agg(
        F.sum("n").alias("n"), F.first("middle").alias("middle"))
    # One ``middle`` a group and statistic, so it is its own smallest.
    start = _cell_at(spread, [*by, "i"], 0.5, F.min("middle").alias("middle")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(
        "i", (F.col("middle") / 1000).alias("m"), (F.col("limit_cell") / 1000 * 1.4826).alias("s")))).alias("e"))
    floor = F.array(*map(F.lit, FLOOR))
    variance = F.transform("e", lambda e: e["s"] * e["s"] + F.get(floor, e["i"]))
    now = _joined(start, large.drop("rows"), by).select(
        *by, F.transform("e", lambda e: e["m"]).alias("centre"),
        F.flatten(F.transform(variance, lambda v, i: F.transform(
            F.sequence(F.lit(0), F.lit(p - 1)), lambda j: F.when(i == j, 1 / v).otherwise(F.lit(0.0))))).alias("inverse"),
        F.lit(math.inf).alias("logdet"),
    )
    now = stored(now, "estimates")
    dropped(grid)

    def with_cell(part: float) -> DataFrame:
        """``now`` with the distance that ``part`` of each group's rows lie within."""
        cells = _joined(vectors, now, by).select(*by, _cell(_distance()).alias("cell")).groupBy(*by, "cell").agg(F.count("*").alias("n"))
        return stored(_joined(_cell_at(cells, by, part), now, by), "limits")

    for _ in range(STEPS):
        limits = with_cell(SUPPORT)
        inside = _joined(vectors, limits.drop("logdet"), by).select(*by, "x", (_cell(_distance()) <= F.col("limit_cell")).alias("inside"))
        new = _estimates(_moments(inside, by), by)
        both = _joined(new, limits.select(*by, F.col("centre").alias("c0"), F.col("inverse").alias("i0"), F.col("logdet").alias("l0")), by)
        better = F.col("logdet") < F.col("l0") - 1e-9
        after = stored(both.select(
            *by, F.when(better, F.col("centre")).otherwise(F.col("c0")).alias("centre"),
            F.when(better, F.col("inverse")).otherwise(F.col("i0")).alias("inverse"),
            F.least("logdet", "l0").alias("logdet"), better.alias("moved"),
        ), "estimates")
        moved = after.where("moved").limit(1).count()
        dropped(now, limits)
        now = after.drop("moved")
        now._stored_at = after._stored_at
        if not moved:
            break
    # Scale: the median row lies where the chi-square distribution has its median.
    median = F.greatest(F.pow(F.lit(2.0), (F.col("limit_cell") + 1) / CELLS), F.lit(1e-6))
    scale = F.greatest(median / chi_square(0.5, p), F.lit(1.0))
    found = with_cell(0.5)
    dropped(now)
    return found.select(*by, "centre", "inverse", scale.alias("scale"))


def chi_square(upper: float, degrees: int) -> float:
    """The value that a chi-square variable exceeds with chance ``upper``, by bisection."""
    def above(x: float) -> float:
        # Upper tail by its finite series (even degrees) or with the error function (odd).
        h = x / 2
        if degrees % 2 == 0:
            term, total = math.exp(-h), 0.0
            for k in range(degrees // 2):
                total += term
                term *= h / (k + 1)
            return total
        total, term = math.erfc(math.sqrt(h)), math.exp(-h) * math.sqrt(h) / math.gamma(1.5)
        for k in range((degrees - 1) // 2):
            total += term
            term *= h / (k + 1.5)
        return total

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) > upper else (low, mid)
    return high


def judged(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, ``base_failed``, the scaled ``distance`` (null: no estimate) and ``kept`` per row."""
    rows = stored(statistics(docs, text, key), "statistics")
    # Each row counts in three groups: its language and source, its language, all rows.
    none = F.lit(None).cast("string")
    levels = F.array(*[
        F.struct(F.lit(i).alias("level"), lang.alias("lang"), source.alias("source"))
        for i, (lang, source) in enumerate(((F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)))
    ])
    groups = robust_estimates(rows.select(F.explode(levels).alias("g"), "x").select("g.*", "x"), ["level", "lang", "source"])
    fine, coarse, whole = (groups.where(F.col("level") == i) for i in range(3))
    with_fine = rows.join(
        fine.select(F.col("lang").alias("l1"), F.col("source").alias("s1"), "centre", "inverse", "scale"),
        F.col("lang").eqNullSafe(F.col("l1")) & F.col("source").eqNullSafe(F.col("s1")), "left",
    )
    with_both = with_fine.join(
        coarse.select(F.col("lang").alias("l2"), *[F.col(c).alias(f"{c}2") for c in ("centre", "inverse", "scale")]),
        F.col("lang").eqNullSafe(F.col("l2")), "left",
    ).withColumn("all_rows", F.lit(2)).join(
        # One row.
        F.broadcast(whole.select(F.col("level").alias("all_rows"), *[F.col(c).alias(f"{c}3") for c in ("centre", "inverse", "scale")])), "all_rows", "left")
    chosen = with_both.select(
        "doc_id", "version", *COUNTS, "base_failed", "x",
        *[F.coalesce(c, f"{c}2", f"{c}3").alias(c) for c in ("centre", "inverse", "scale")],
    )
    distance = _distance() / F.col("scale")
    limit = chi_square(LEVEL, len(STATISTICS))
    return chosen.select(
        "doc_id", "version", *COUNTS, "base_failed", distance.alias("distance")
    ).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))


def kept_documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that :func:`judged` rejects."""
    bad = judged(docs, text, key).where("not kept").select(F.col("doc_id").alias("__key"), F.col("version").alias("__version")).distinct()
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__own") == F.col("__version"))
    return docs.withColumn("__own", _version(text)).join(bad, same, "left_anti").drop("__own")
