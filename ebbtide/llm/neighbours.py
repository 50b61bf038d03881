"""Approximate nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on at most ``FIT_ROWS`` rows (those with the smallest hash of their id):
each node is split into ``BRANCH`` clusters until a leaf stands for about ``LEAF_ROWS`` rows
of the table. Every row is then filed under its leaf. A query visits leaves best bin first:
a priority queue holds the branches not taken, and the nearest is taken next.

How many leaves a query visits is calibrated: for ``CALIBRATION`` queries, rows outside the
fitted sample, the true neighbours among all rows are computed in blocks, and the visits are
widened until the recall is ``TARGET`` or more with a confidence of 95 %: its mean over the
queries less ``CONFIDENCE`` standard errors.

The nearest of these leaves are searched first; the others then return only what reaches the
query's last place so far. Leaves are joined with the queries that visit them, in blocks of ``BLOCK_ROWS`` rows and
``BLOCK_QUERIES`` queries, so a leaf that holds a third of the rows is many tasks. What is
sent to the tasks, the tree and the calibration queries, has a size set by the parameters.

Results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; repeated rows of an id count
once; of an id with several vectors, the one with the smallest hash is the query, and none of
them is its neighbour; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import stored

FIT_ROWS, LEAF_ROWS, BRANCH, LEAST_LEAF = 16_384, 256, 8, 8
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 2_048
CALIBRATION, TARGET, CONFIDENCE = 256, 0.93, 1.645
#: Scores this near to the last place are computed anew before ranking.
MARGIN = 1e-9
#: One in so many of the leaves is visited first.
EARLY = 16
ITERATIONS, SEED = 12, 5


# The tree ------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes by number: centres of the children, and their numbers (below zero: ~leaf)."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def nearest_leaf(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each row, going to the nearest child at every node."""
        out = np.zeros(len(units), np.int64)
        todo = [(0, np.arange(len(units)))] if self.centres else []
        while todo:
            node, rows = todo.pop()
            pick = _nearest(units[rows], self.centres[node])
            for i, child in enumerate(self.children[node]):
                own = rows[pick == i]
                if len(own) and child < 0:
                    out[own] = ~child
                elif len(own):
                    todo.append((child, own))
        return out

    def visits(self, unit: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for a query, best bin first."""
        out: list[int] = []
        queue: list[tuple[float, int]] = [(0.0, 0 if self.centres else ~0)]
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while node >= 0:
                far = ((self.centres[node] - unit) ** 2).sum(axis=1)
                best = int(far.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), child))
                node = self.children[node][best]
            out.append(~node)
        return out


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def _clusters(rows: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and assignment by k-means; centres that get no rows are left out."""
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(ITERATIONS):
        pick = _nearest(rows, centres)
        used = np.unique(pick)
        centres = np.array([rows[pick == i].mean(axis=0) for i in used])
    return centres, _nearest(rows, centres)


def fit(units: np.ndarray, leaf_size: int) -> Tree:
    """A tree whose leaves hold at most about ``leaf_size`` of the rows given."""
    tree, rng = Tree(), np.random.default_rng(SEED)

    def grow(rows: np.ndarray) -> int:
        if len(rows) > leaf_size:
            centres, pick = _clusters(rows, min(BRANCH, len(rows)), rng)
            if len(np.unique(pick)) > 1:
                node = len(tree.centres)
                tree.centres.append(centres)
                tree.children.append([])
                tree.children[node] = [grow(rows[pick == i]) for i in range(len(centres))]
                return node
        tree.leaves += 1
        return ~(tree.leaves - 1)

    grow(units)
    return tree


# Rows ----------------------------------------------------------------------------------

def _valid(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (length["size"] if length else 0))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 0))


def _units(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosine of a vector with each row, each by the same sums wherever the row stands."""
    a, b = one / np.abs(one).max(), many / np.abs(many).max(axis=1, keepdims=True)
    return (b * a).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def _top(ids: np.ndarray, m: np.ndarray, query: int, vector: np.ndarray, near: np.ndarray, k: int, least: float = -2.0) -> list[tuple]:
    """The query's best ``k`` of some rows, exactly scored: (query, vec_id, score).

    ``near`` are scores up to rounding; rows below ``least`` are left out.
    """
    near = np.where((ids == query) | (near < least - MARGIN), -np.inf, near)
    n = int((near > -np.inf).sum())
    if not n:
        return []
    last = np.partition(near, len(near) - min(k, n))[len(near) - min(k, n)]
    while True:
        pick = np.flatnonzero(near >= last - MARGIN)
        found = sorted({(-s, int(i)) for s, i in zip(cosine(vector, m[pick]), ids[pick], strict=True)})
        if len(found) >= min(k, n) or len(pick) >= n:
            return [(query, i, -s) for s, i in found[:k]]
        rest = near[near < last - MARGIN]  # repeated rows took places: widen
        last = np.partition(rest, len(rest) - min(k, len(rest)))[len(rest) - min(k, len(rest))]


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per query, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_visits(rows: DataFrame, tree: Tree, sample: pd.DataFrame, k: int) -> int:
    """Leaves to visit so that the sample's recall is ``TARGET`` or more, at its lower bound."""
    ids, vectors = sample["vec_id"].to_numpy(), _matrix(sample["vector"])
    units = _units(vectors)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, m = batch["vec_id"].to_numpy(), _matrix(batch["vector"])
            if not len(own):
                continue
            u = _units(m)
            leaf = dict(zip(own.tolist(), tree.nearest_leaf(u).tolist(), strict=True))
            near = units @ u.T
            out = [r for i in range(len(ids)) for r in _top(own, m, int(ids[i]), vectors[i], near[i], k)]
            yield pd.DataFrame([(q, v, s, leaf[v]) for q, v, s in out], columns=["query_id", "vec_id", "score", "leaf"])

    found = _best(rows.mapInPandas(blocks, "query_id long, vec_id long, score double, leaf long"), k)
    place = {int(q): {leaf: i for i, leaf in enumerate(tree.visits(u, tree.leaves))} for q, u in zip(ids, units, strict=True)}
    asked: dict[int, list[int]] = {}
    for r in found.select("query_id", "leaf").collect():  # k per sampled query
        asked.setdefault(r["query_id"], []).append(place[r["query_id"]][r["leaf"]])
    return enough_visits(list(asked.values()))


def enough_visits(ranks: list[list[int]]) -> int:
    """The fewest leaves whose recall is ``TARGET`` at its lower bound; the ranks are those of each query's true leaves."""
    every = sorted({r for own in ranks for r in own})
    low, high = 0, len(every) - 1
    while low < high:
        middle = (low + high) // 2
        recall = np.array([np.mean(np.array(own) <= every[middle]) for own in ranks])
        if recall.mean() - CONFIDENCE * recall.std() / np.sqrt(len(recall)) >= TARGET:
            high = middle
        else:
            low = middle + 1
    return 1 + every[low] if every else 1


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest ``k`` found for each query row."""
    schema = "query_id long, vec_id long, score double"
    rows = _valid(vectors)
    spark = vectors.sparkSession
    by_hash = rows.orderBy(F.xxhash64("vec_id"), F.xxhash64("vector"))
    sample = by_hash.limit(FIT_ROWS + CALIBRATION).toArrow().to_pandas()  # a bounded sample
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = rows.count()
    # The last by hash are kept out of the fit: their own leaf is not drawn towards them.
    outside = min(CALIBRATION, len(sample) // 3)
    asked_first, sample = sample.tail(outside) if outside else sample, sample.head(len(sample) - outside)
    units = _units(_matrix(sample["vector"]))
    tree = fit(units, max(LEAST_LEAF, LEAF_ROWS * len(sample) // max(total, 1)))
    visits = calibrated_visits(rows, tree, asked_first.drop_duplicates("vec_id"), k)

    def file_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.nearest_leaf(_units(_matrix(batch["vector"]))))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaves = [tree.visits(u, visits) for u in _units(_matrix(batch["vector"]))]
                yield pd.DataFrame({
                    "query_id": batch["vec_id"], "query": batch["vector"], "leaves": leaves,
                })

    filed = stored(rows.mapInPandas(file_rows, "vec_id long, vector array<double>, leaf long"), "leaves")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min_by("vector", F.xxhash64("vector")).alias("vector"))
    asked = stored(asked.mapInPandas(visit, "query_id long, query array<double>, leaves array<long>"), "queries")
    def compare(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(own) and len(queries):
            ids, m, q = own["vec_id"].to_numpy(), _matrix(own["vector"]), _matrix(queries["query"])
            u, qu = _units(m), _units(q)
            number, bound = queries["query_id"].to_numpy(), queries["bound"].to_numpy()
            for at in range(0, len(q), 256):
                near = qu[at:at + 256] @ u.T
                for i in range(len(near)):
                    out += _top(ids, m, int(number[at + i]), q[at + i], near[i], k, bound[at + i])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    rows_by_leaf = filed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    on = ["leaf", "rb", "qb"]

    def visited(queries: DataFrame) -> DataFrame:
        """The best of each leaf for the queries that visit it, in blocks."""
        # Numbers of rows and queries by leaf: as many rows as the tree has leaves. Both sides'
        # keys need the same types, or they would be dealt out differently.
        per_leaf = queries.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
        size = F.broadcast(rows_by_leaf.join(per_leaf, "leaf"))
        spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = filed.join(size, "leaf").withColumn("rb", F.pmod(F.xxhash64("vec_id"), "row_blocks").cast("int"))
        left = left.withColumn("qb", spread(F.col("query_blocks"))).select(*on, "vec_id", "vector")
        right = queries.join(size, "leaf").withColumn("qb", F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int"))
        right = right.withColumn("rb", spread(F.col("row_blocks"))).select(*on, "query_id", "query", "bound")
        return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(compare, schema)

    # The nearest leaves give each query a bound; the others need only return what reaches it.
    early = max(1, visits // EARLY)
    first = asked.select("query_id", "query", F.lit(-2.0).alias("bound"), F.explode(F.slice("leaves", 1, early)).alias("leaf"))
    found = stored(_best(visited(first), k).drop("rank"), "nearest")
    bound = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).otherwise(-2.0).alias("bound"))
    late = asked.join(bound, "query_id", "left").select(
        "query_id", "query", F.coalesce("bound", F.lit(-2.0)).alias("bound"), F.explode(F.slice("leaves", early + 1, visits)).alias("leaf"))
    return _best(found.unionAll(visited(late)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
