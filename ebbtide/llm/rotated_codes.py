"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors.

A unit vector is turned by random rotations and keeps the signs of its coordinates: its code.
With the code two factors are stored: the inner product of vector and sign vector, and how far
the sign vector stands off the vector. From a code and another vector comes an unbiased
estimate of their cosine, and since the rotation is random, the part that makes the estimate
err is one coordinate of a random direction: bounds of the error hold for any data.

* Candidates: the code is cut into bands. Linked vectors agree in each bit with a chance of
  at least ``1 - angle / pi``, so there are as many bands as leave a pair at the least cosine
  without an equal band with chance ``MISSED``. Bands are long enough for the largest label,
  so vectors that are not alike seldom share one; the number of bands grows very slowly.
* Rows that share no band with another row of their label are left out by counting hashes
  before any vector moves.
* A pair is decided at the first band that it shares, so each is counted once. Its cosine is
  computed anew, in double precision, unless the estimate's upper bound lies below the least
  cosine. The bound fails with a chance of about ``2 exp(-BOUND**2 / 2)``.
* A bucket of more than ``BLOCK`` rows is compared in pairs of blocks, each a group of its own.
  Tasks return sums and spanning stars, never pairs.

Equal vectors of a label are one node with a weight, so copies cost one row each.

Results: one row per row of the input. Vectors that are null, empty, zero, or hold null or
non-finite components, and rows without a label, have no links and are their own component.
Vectors of different lengths have no cosine. Rows that repeat an id are separate vectors. A
row without an id takes part, but names its component only if no other can (null then). Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import stored
from ebbtide.llm.components import components

#: Chance that a pair at the least cosine shares no band.
MISSED = 1e-6
#: Error bounds in standard deviations of the estimate.
BOUND = 6.5
#: Rows of a bucket compared in one group, and rows of small buckets put into one group.
BLOCK, GROUP_ROWS = 2_048, 50_000
#: Pairs looked at together.
PAIRS = 1 << 17
#: Bits by which a band is longer than the largest label's count needs.
SPARE_BITS = 3
SEED = 11


def band_plan(rows: int, least: float) -> tuple[int, int]:
    """Bits per band (whole bytes) and number of bands for so many vectors of one label."""
    agree = 1 - math.acos(least) / math.pi
    bits = 8 * max(1, math.ceil((math.log2(max(rows, 2)) + SPARE_BITS) / 8))
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-(agree**bits))))


@functools.lru_cache(4)
def rotation(dim: int, bits: int) -> np.ndarray:
    """``bits`` directions: random rotations one under another, the last one cut."""
    rng, blocks = np.random.default_rng([SEED, dim]), []
    for _ in range(math.ceil(bits / dim)):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        blocks.append(q * np.where(np.diag(r) < 0, -1.0, 1.0))
    return np.concatenate(blocks)[:bits]


def encode(units: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, inner product with the sign vector, and the error's scale, per row."""
    turn = rotation(units.shape[1], bits)
    turned = units @ turn.T
    signs = turned > 0
    along = np.abs(turned).sum(axis=1)
    whole = (np.where(signs, 1.0, -1.0) @ turn)
    off = np.sqrt(np.maximum((whole * whole).sum(axis=1) - along**2, 0.0))
    return np.packbits(signs, axis=1), along, off / np.maximum(along, 1e-300)


def estimator(codes: np.ndarray, along: np.ndarray, dim: int) -> np.ndarray:
    """Rows whose inner product with a unit vector is the unbiased estimate of the cosine."""
    bits = codes.shape[1] * 8
    signs = np.unpackbits(codes, axis=1).astype(np.float64) * 2 - 1
    return signs @ rotation(dim, bits) / along[:, None]


def least_estimate(scale: np.ndarray, dim: int, least: float) -> np.ndarray:
    """Estimates below this leave no cosine of ``least`` or more within the bounds."""
    spread = min(1.0, BOUND / math.sqrt(max(dim - 1, 1)))
    return least - math.sqrt(max(0.0, 1 - least * least)) * scale * spread - 1e-9


def units_of(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of rows ``i`` and ``j``, pair by pair; ``label`` names each row's set."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(label, up := label[label]):
            label[:] = up


class _Group:
    """Rows of one length that are compared: who is linked, counted with weights."""

    def __init__(self, rows: pd.DataFrame, dim: int, bands: int, least: float):
        self.vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        self.units = units_of(self.vectors)
        codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
        self.made = estimator(codes, rows["along"].to_numpy(), dim)
        self.least, self.floor = least, least_estimate(rows["scale"].to_numpy(), dim, least)
        self.bands = codes.reshape(len(rows), bands, -1)
        self.band, self.bucket = rows["band"].to_numpy(), rows["bucket"].to_numpy()
        self.group, self.block = pd.factorize(rows["label"])[0], rows["block"].to_numpy()
        self.weight = rows["weight"].to_numpy()
        self.links = np.zeros(len(rows), np.int64)
        self.root = np.arange(len(rows))

    def decide(self, i: np.ndarray, j: np.ndarray) -> None:
        """Exact cosines for the pairs that meet here first and may reach the least cosine."""
        equal = (self.bands[i] == self.bands[j]).all(axis=2)
        here = equal[np.arange(len(i)), self.band[i]] & (equal.argmax(axis=1) == self.band[i]) & (self.group[i] == self.group[j])
        i, j = i[here], j[here]
        near = cosines(self.vectors[i], self.vectors[j]) >= self.least
        i, j = i[near], j[near]
        np.add.at(self.links, i, self.weight[j])
        np.add.at(self.links, j, self.weight[i])
        merge(self.root, i, j)

    def small(self, starts: np.ndarray, ends: np.ndarray) -> None:
        """All pairs of neighbouring rows in small buckets, by their distance in the order."""
        left = np.repeat(ends, ends - starts) - np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)])
        at = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)])
        step = 1
        while len(at := at[left > step]):
            left = left[left > step]
            for x in range(0, len(at), PAIRS):
                i = at[x:x + PAIRS]
                may = np.einsum("ij,ij->i", self.made[i], self.units[i + step]) >= self.floor[i]
                self.decide(i[may], i[may] + step)
            step += 1

    def large(self, one: np.ndarray, other: np.ndarray, same: bool) -> None:
        """All pairs of two blocks of a bucket, or of one with itself."""
        step = max(1, PAIRS // max(len(other), 1))
        for x in range(0, len(one), step):
            i = one[x:x + step]
            may = self.made[i] @ self.units[other].T >= self.floor[i][:, None]
            if same:
                may &= other[None, :] > i[:, None]
            a, b = np.nonzero(may)
            self.decide(i[a], other[b])


def _compare(rows: pd.DataFrame, dim: int, bands: int, least: float) -> pd.DataFrame:
    rows = rows.sort_values(["bucket", "block"], kind="stable").reset_index(drop=True)
    g = _Group(rows, dim, bands, least)
    starts = np.flatnonzero(np.r_[True, g.bucket[1:] != g.bucket[:-1]])
    ends = np.r_[starts[1:], len(rows)]
    crossed = (rows["bi"] != rows["bj"]).to_numpy()
    few = (ends - starts <= 32) & ~crossed[starts]
    if few.any():
        g.small(starts[few], ends[few])
    for s, e in zip(starts[~few], ends[~few], strict=True):
        at = np.arange(s, e)
        if crossed[s]:
            low = g.block[at] == g.block[s]
            g.large(at[low], at[~low], same=False)
        else:
            g.large(at, at, same=True)
    hit = g.links > 0
    root = rows.iloc[g.root[hit]]
    own = rows[hit]
    return pd.DataFrame({
        "no_id": own["no_id"].to_numpy(), "first": own["first"].to_numpy(), "node": own["node"].to_numpy(), "links": g.links[hit],
        "root_no_id": root["no_id"].to_numpy(), "root_first": root["first"].to_numpy(), "root_node": root["node"].to_numpy(),
    })


def _valid(vector: Column) -> Column:
    """The vector where it takes part, else null."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), vector)


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        _valid(F.col(vector).cast("array<double>")).alias("vector"),
    )
    part = rows.where(F.col("vector").isNotNull() & F.col("label").isNotNull())
    nodes = part.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least_id")).select(
        F.monotonically_increasing_id().alias("node"), "label", "vector", F.size("vector").alias("dim"), "weight",
        F.col("least_id").isNull().alias("no_id"), F.coalesce("least_id", F.lit(0).cast("long")).alias("first"),
    )
    nodes = stored(nodes, "vectors")
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0]  # one number
    bits, bands = band_plan(largest or 1, least)

    def codes(batches):
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                packed, along, scale = encode(units_of(np.stack(own["vector"].to_numpy())), bits * bands)
                yield own.assign(code=[x.tobytes() for x in packed], along=along, scale=scale)

    fields = "node long, label string, vector array<double>, dim int, weight long, no_id boolean, first long"
    coded = stored(nodes.mapInPandas(codes, f"{fields}, code binary, along double, scale double"), "codes")

    # Who shares a band with whom: hashes alone, before any vector is sent.
    wide = bits // 8
    key_of = lambda b: F.xxhash64(F.col("label"), F.col("dim"), b, F.substring(F.col("code"), b * wide + 1, F.lit(wide)))
    keyed = stored(coded.select("node", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key_of)).alias("band", "bucket")), "bands")
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(keyed.join(sizes, "bucket"), "shared")
    groups = max(1, math.ceil(shared.count() / GROUP_ROWS))

    # Small buckets are put together; a large one is cut into blocks, and pairs of blocks are groups.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = shared.join(coded, "node").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.when(F.col("blocks") == 1, F.pmod("bucket", F.lit(groups))).otherwise(F.col("bucket")).alias("group"),
        F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "dim",
        "node", "no_id", "first", "label", "weight", "vector", "code", "along", "scale", "band", "bucket", "block",
    )

    def compare(own: pd.DataFrame) -> pd.DataFrame:
        return _compare(own, int(own["dim"].iloc[0]), bands, least)

    found = stored(placed.groupBy("group", "bi", "bj", "dim").applyInPandas(
        compare, "no_id boolean, first long, node long, links long, root_no_id boolean, root_first long, root_node long"), "links")
    # Nodes sort by their least id, so the smallest node of a component names it.
    named = found.select(F.struct("no_id", "first", "node").alias("u"), F.struct(
        F.col("root_no_id").alias("no_id"), F.col("root_first").alias("first"), F.col("root_node").alias("node")).alias("v"))
    linked = components(named).select(F.col("node.node").alias("node"), "component")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    facts = nodes.join(sums, "node", "left").join(linked, "node", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.when(~F.coalesce("component.no_id", "no_id"), F.coalesce("component.first", "first")).alias("component_id"),
        F.lit(True).alias("takes_part"),
    )
    return rows.join(facts, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("takes_part"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.n AS i, b.n AS j FROM ok a JOIN ok b ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(n, m) AS (
  SELECT n, n FROM v UNION SELECT r.n, l.j FROM reach r JOIN links l ON r.m = l.i
), named AS (SELECT r.n, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.n = r.m GROUP BY r.n
), counted AS (SELECT i AS n, count(*) AS n_links FROM links GROUP BY i)
SELECT v.vec_id, coalesce(c.n_links, 0) AS n_links, named.component_id, v.vec_id IS NOT DISTINCT FROM named.component_id AS kept
FROM v JOIN named USING (n) LEFT JOIN counted c USING (n)
"""
