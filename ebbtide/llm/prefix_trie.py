"""The trie of conversation prefixes, by range partitions and the skeleton of their splitters.

A conversation is a path: 16-byte digests of its turns, one after another, so that the order
of the bytes is the order of a walk through the trie. Paths (ties by conversation) are cut
into ranges at splitters taken from the rows themselves, and each range is a sorted shard.

The members of a node are neighbours in this order. If they lie in more than one shard, a
splitter lies among them, so the node is a prefix of that splitter. The trie of all splitters
is therefore the only place where shards must be put together: it is broadcast, and

* a shard walks its sorted paths with a stack of open nodes and finishes every node outside
  the skeleton by itself;
* for skeleton nodes it returns partial sums, which are added up; children and leaves
  below skeleton nodes, and their own savings, are added along the skeleton.

The broadcast is bounded: at most ``MOST_SHARDS`` splitters of ``SPLIT_TURNS`` turns. A
longer splitter is cut there, which keeps deeper nodes in one shard. A shard holds its open
nodes and the finished children of those, never its rows.

The digest of a node's ends is one hash over ids in ascending order. Where the ends lie in
several shards, their ids alone are dealt out by node, sorted, and streamed through the hash.

Results: turns are ordered by turn (null first), then by their digest; a null role or text is
empty; repeated rows are repeated turns; rows without a conversation id are left out; ids
below zero take ``conv_id % 20`` with their sign, as Spark does; other columns are ignored; a
table without conversations has no nodes, not even a root.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import stored

#: Conversations aimed at per shard, shards at most, and turns of a splitter at most.
SHARD_ROWS, MOST_SHARDS, SPLIT_TURNS = 100_000, 2_048, 128
#: Rows looked at per splitter.
OVERSAMPLE = 8
#: Bytes of a turn's digest.
WIDTH = 16
#: Conversations of such a block may take their first turns from the first of them; how many is at most HEAD.
FAMILY, HEAD = 20, 3

COUNTS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


# Paths ---------------------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """Per conversation its turns in order, as an array of digest (hex) and number of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH).alias("digest"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).alias("words"),
    ).where(F.col("conv_id").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("has"), "turn", "digest", "words")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` and ``words``: the family's first turns, then the conversation's own."""
    first = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "base", "left")
    none = F.slice("turns", 1, 0)
    whole = F.concat(F.coalesce(F.slice("head", F.lit(1), h), none), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1))))
    made = joined.select("conv_id", whole.alias("turns"))
    return made.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


# Splitters -----------------------------------------------------------------------------

def splitters(paths: DataFrame, rows: int, shard_rows: int, split_turns: int) -> list[tuple[bytes, int]]:
    """Where shards begin: (path, conversation), from a bounded sample of the rows."""
    least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    shards = min(MOST_SHARDS, max(-(-rows // shard_rows), min(least, rows)))
    if shards < 2:
        return []
    cut = F.length("path") > split_turns * WIDTH
    sample = paths.select(
        F.substring("path", 1, split_turns * WIDTH).alias("path"), F.when(cut, F.lit(-(2**63))).otherwise(F.col("conv_id")).alias("conv_id"),
        F.xxhash64("conv_id").alias("h"),
    ).orderBy("h").limit(shards * OVERSAMPLE)
    found = sorted({(bytes(r["path"]), r["conv_id"]) for r in sample.collect()})  # at most MOST_SHARDS * OVERSAMPLE short rows
    picked = {found[i * len(found) // shards] for i in range(1, shards)}
    return sorted(picked)


class Skeleton:
    """The trie of the splitters: nodes by number in the order of a walk; the root is 0."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.end = [-1], [0], [0]
        for path, _ in cuts:
            node = 0
            for at in range(0, len(path), WIDTH):
                step = (node, path[at:at + WIDTH])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(at // WIDTH + 1)
                    self.end.append(0)
                node = self.child[step]
        # Splitters are sorted, so numbers grow along the walk and a subtree is a run of numbers.
        for node in range(len(self.parent) - 1, -1, -1):
            self.end[node] = max(self.end[node], node)
            if node:
                self.end[self.parent[node]] = max(self.end[self.parent[node]], self.end[node])


# Walking a shard -----------------------------------------------------------------------

class _Node:
    __slots__ = ("children", "depth", "ends", "finished", "leaves", "least", "members", "saved", "skeleton", "words")

    def __init__(self, depth: int, words: int, skeleton: int):
        self.depth, self.words, self.skeleton = depth, words, skeleton
        self.members = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None
        self.finished: list[tuple] = []


EMPTY = hashlib.sha256(b"").hexdigest()
#: Rows of a walk: finished nodes (parent by id or by skeleton number), partial sums, and ends.
WALKED = pa.schema([
    ("kind", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("skeleton", pa.int64()),
    *[(c, pa.int64()) for c in COUNTS], ("words", pa.int64()), ("ends_sha256", pa.string()),
])
WALKED_DDL = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in WALKED)


class Walk:
    """Open nodes from the root to the path at hand; ``out`` takes the rows that are ready."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.out = skeleton, []
        self.path, self.open = b"", [_Node(0, 0, 0)]

    def take(self, conv: int, path: bytes, words: list[int]) -> None:
        depth, last = len(path) // WIDTH, self.path
        same = 0
        while same < min(depth, len(self.open) - 1) and path[same * WIDTH:(same + 1) * WIDTH] == last[same * WIDTH:(same + 1) * WIDTH]:
            same += 1
        while len(self.open) - 1 > same:
            self._close()
        for d in range(same, depth):
            above = self.open[-1].skeleton
            number = self.skeleton.child.get((above, path[d * WIDTH:(d + 1) * WIDTH]), -1) if above >= 0 else -1
            self.open.append(_Node(d + 1, words[d], number))
        self.path = path
        node = self.open[-1]
        node.members += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton >= 0:
            self.out.append(("end", conv, None, None, node.skeleton, *[None] * len(COUNTS), None, None))
        elif node.ends is None:
            node.ends = hashlib.sha256(b"%d" % conv)
        else:
            node.ends.update(b",%d" % conv)

    def _close(self) -> None:
        node = self.open.pop()
        parent = self.open[-1]
        if node.skeleton >= 0:
            self._partial(node)
            parent.leaves += node.leaves
            parent.saved += node.saved
        else:
            node.leaves = node.leaves or 1
            node.saved += (node.members - 1) * node.words
            self.out += [("node", c, d, node.least, -1, *rest) for c, d, *rest in node.finished]
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
            row = (node.least, node.depth, node.members, node.children, node.leaves, node.saved, None,
                   EMPTY if node.ends is None else node.ends.hexdigest())
            if parent.skeleton >= 0:
                self.out.append(("node", row[0], row[1], None, parent.skeleton, *row[2:]))
            else:
                parent.finished.append(row)
        parent.members += node.members
        parent.least = node.least if parent.least is None else min(parent.least, node.least)

    def _partial(self, node: _Node) -> None:
        self.out.append(("part", node.least, node.depth, None, node.skeleton, node.members, node.children, node.leaves, node.saved, node.words, None))

    def finish(self) -> None:
        while len(self.open) > 1:
            self._close()
        if self.open[0].members:
            self._partial(self.open[0])
        self.path, self.open = b"", [_Node(0, 0, 0)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in WALKED]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, WALKED, strict=True)], schema=WALKED)


def walk_shards(paths: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """Finished nodes, partial sums of skeleton nodes, and the ends that lie at those."""
    sent = paths.sparkSession.sparkContext.broadcast((cuts, Skeleton(cuts)))  # bounded by the parameters

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, _ = sent.value
        for batch in batches:
            at = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            shard = [bisect.bisect_right(cuts, (path, conv)) for conv, path in at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=["conv_id", "path", "words", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, now = Walk(sent.value[1]), None
        for batch in batches:
            for conv, path, words, shard in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if shard != now:
                    walk.finish()
                    now = shard
                walk.take(conv, path, words)
                if len(walk.out) >= 10_000:
                    yield _batch(walk.out)
                    walk.out.clear()
        walk.finish()
        yield _batch(walk.out)

    placed = paths.select("conv_id", "path", "words").mapInArrow(place, "conv_id long, path binary, words array<int>, shard int")
    return placed.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, WALKED_DDL)


# The skeleton --------------------------------------------------------------------------

def end_digests(ends: DataFrame) -> DataFrame:
    """``skeleton`` and ``ends_sha256``: each node's ids streamed through one hash in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([made.hexdigest()])], names=["skeleton", "ends_sha256"])

        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != now:
                    if made is not None:
                        yield row()
                    now, made = node, hashlib.sha256(b"%d" % conv)
                else:
                    made.update(b",%d" % conv)
        if made is not None:
            yield row()

    picked = ends.select("skeleton", "conv_id").repartition("skeleton").sortWithinPartitions("skeleton", "conv_id")
    return picked.mapInArrow(run, "skeleton long, ends_sha256 string")


def finished_skeleton(parts: DataFrame, ends: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes: partial sums added over shards, then along the skeleton."""
    spark = parts.sparkSession
    shape = pd.DataFrame({"skeleton": range(len(skeleton.parent)), "parent": skeleton.parent, "end": skeleton.end})
    shape = spark.createDataFrame(shape, "skeleton long, parent long, end long")
    total = parts.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in COUNTS],
    )
    own_children = shape.groupBy(F.col("parent").alias("skeleton")).agg(F.count("*").alias("below"))
    nodes = total.join(shape, "skeleton").join(own_children, "skeleton", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("below", F.lit(0)))
    # Own savings and leaves of skeleton nodes, summed over the run of numbers that is a subtree.
    nodes = nodes.withColumns({
        "own_saved": (F.col("n_convs") - 1) * F.col("words"), "own_leaf": (F.col("n_children") == 0).cast("long"),
    })
    order = Window.orderBy("skeleton")  # at most MOST_SHARDS * SPLIT_TURNS rows
    before = nodes.select(
        "skeleton", *[F.sum(c).over(order).alias(f"to_{c}") for c in ("own_saved", "own_leaf")])
    upto = lambda at: before.select(F.col("skeleton").alias(at), *[F.col(f"to_{c}").alias(f"{at}_{c}") for c in ("own_saved", "own_leaf")])
    summed = nodes.join(upto("end"), "end").join(upto("own").withColumnRenamed("own", "skeleton"), "skeleton")
    along = lambda c: F.col(f"end_{c}") - F.col(f"own_{c}") + F.col(c)
    summed = summed.select(
        "skeleton", "parent", "conv_id", "depth", "n_convs", "n_children",
        (F.col("n_leaves") + along("own_leaf")).alias("n_leaves"), (F.col("saved_tokens") + along("own_saved")).alias("saved_tokens"),
    )
    return summed.join(end_digests(ends), "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))


def _least(nodes: DataFrame, number: str) -> DataFrame:
    return nodes.select(F.col("skeleton").alias(number), F.col("conv_id").alias("above"))


def trie(paths: DataFrame, shard_rows: int = SHARD_ROWS, split_turns: int = SPLIT_TURNS) -> DataFrame:
    """One row per distinct prefix of the paths (``conv_id``, ``path``, ``words``)."""
    paths = stored(paths, "paths")
    cuts = splitters(paths, paths.count(), shard_rows, split_turns)
    walked = stored(walk_shards(paths, cuts), "walked", partition_by="kind")
    skeleton = stored(finished_skeleton(walked.where("kind = 'part'"), walked.where("kind = 'end'"), Skeleton(cuts)), "skeleton")
    columns: list[Column | str] = ["conv_id", "depth", "parent_conv_id", *COUNTS, "ends_sha256"]
    own = walked.where("kind = 'node'")
    # Bounded like the skeleton itself.
    local = own.join(F.broadcast(_least(skeleton, "skeleton")), "skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("above", "parent_conv_id")).select(*columns)
    top = skeleton.join(F.broadcast(_least(skeleton, "parent")), "parent", "left").withColumn("parent_conv_id", F.col("above")).select(*columns)
    return local.unionAll(top)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations of the table."""
    return trie(rebuilt(turns(conversations)))


#: One step of the CRC of a byte, bit by bit, with its fixed polynomial.
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),"
    " lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),"
    " lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"
)
SQL = f"""
WITH g AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, turn, substr(sha256(length(r)::VARCHAR || ':' || r || x), 1, {2 * WIDTH}) AS digest,
         len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words FROM g
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS i FROM t
), c AS (SELECT conv_id, {_CRC} % {HEAD + 1} AS h FROM (SELECT DISTINCT conv_id FROM t)
), made AS (
  SELECT c.conv_id, 0 AS part, o.i, o.digest, o.words FROM c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {FAMILY} AND o.i <= c.h
  UNION ALL SELECT c.conv_id, 1, o.i, o.digest, o.words FROM c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
), paths AS (
  SELECT c.conv_id, coalesce(string_agg(digest, '' ORDER BY part, i), '') AS path, list(words ORDER BY part, i) AS words, count(digest) AS n
  FROM c LEFT JOIN made USING (conv_id) GROUP BY c.conv_id
), steps AS (SELECT conv_id, path, words, n, unnest(range(0, n + 1)) AS depth FROM paths
), nodes AS (
  SELECT depth, substr(path, 1, {2 * WIDTH} * depth) AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256
  FROM steps GROUP BY 1, 2
), below AS (
  SELECT depth - 1 AS depth, substr(k, 1, {2 * WIDTH} * (depth - 1)) AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), every AS (
  SELECT n.*, coalesce(b.n_children, 0) AS n_children FROM nodes n LEFT JOIN below b USING (depth, k)
), up AS (SELECT *, unnest(range(0, depth + 1)) AS above FROM every
), sums AS (
  SELECT above AS depth, substr(k, 1, {2 * WIDTH} * above) AS k, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM up GROUP BY 1, 2
)
SELECT e.conv_id, e.depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, s.n_leaves, s.saved_tokens, e.ends_sha256
FROM every e JOIN sums s USING (depth, k)
LEFT JOIN every p ON p.depth = e.depth - 1 AND p.k = substr(e.k, 1, {2 * WIDTH} * (e.depth - 1))
"""
