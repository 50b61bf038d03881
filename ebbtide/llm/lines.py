"""Near-duplicate lines by deletion neighbourhoods; of equal or near lines the earliest stays.

Lines stand at places (key of the document, number in it) and the smaller place is earlier.
A line goes if an earlier place has the same line, or one at an edit distance of 1 (a
character put in, left out or replaced) where both have ``LEAST_CHARS`` characters or more.
Lines of white space alone always stay.

Two lines are one edit apart exactly if they become equal when a character is deleted from
the longer one, or at the same place from both. All deletions of all lines would be the text
times its line length, so the neighbourhood is refined: first blocks of the line are deleted
(halves, then sixteenths), and only lines that equal another line after the same deletion
go on, for the blocks where they do. An edit lies inside one block, so nothing is lost. Then
the characters of those blocks are deleted one by one. Variants are hashed and equal hashes
are joined:

* the same deletion of two lines of equal length: all lines of such a group are one edit
  apart, so each only needs the group's earliest;
* a line and a deletion of a longer one: either needs the earliest of the other kind.

So no group is paired off, whatever its size. The pairs named are verified with
``levenshtein``. Lines are compared whole, once each: repeats shrink to their earliest place
first. Everything is DataFrame code.

Results: null text has no lines and stays null; a null key comes before all others; of rows
that share a key each keeps and loses lines of its own: two equal lines at one place are one
line, so repeated rows stay alike, and other lines there are compared like any; other columns
stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import dropped, stored

#: Shorter lines go only if they repeat exactly.
LEAST_CHARS = 20
#: Blocks of the first deletions, and of the second.
COARSE, FINE = 2, 16
#: A place is the key times this plus the line's number; times ``TIES``, plus bits of the line's
#: hash that tell lines of rows with one key apart, it names the line.
PLACE, TIES = 1 << 31, 1 << 20
NO_KEY = -(2**63)

def _place(key: Column, number: Column, line: Column) -> Column:
    """Places as one number that sorts by key, then line."""
    at = (F.coalesce(key, F.lit(NO_KEY)).cast("decimal(20,0)") * F.lit(PLACE) + number).cast("decimal(32,0)")
    return (at * F.lit(TIES) + F.pmod(F.xxhash64(line), F.lit(TIES))).cast("decimal(38,0)")


def _without_ties(place: Column) -> Column:
    """The part of a place that key and number make."""
    return place - F.pmod(place, F.lit(TIES).cast("decimal(38,0)"))


def _id(line: Column) -> list[Column]:
    """Two hashes that stand for the line."""
    return [F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit("second")).alias("b")]


def _bounds(block: Column, blocks: int, length: Column) -> tuple[Column, Column]:
    """First character of a block, and of the next, for lines of up to ``length`` characters."""
    at = lambda k: F.floor(k * length / F.lit(blocks)).cast("int")
    return at(block), at(block + 1)


def _without(line: Column, n: Column, block: Column, blocks: int, length: Column) -> Column:
    """Hash of the line without a block, in a neighbourhood whose longest line has ``length``."""
    low, high = _bounds(block, blocks, length)
    return F.xxhash64(length, block, F.substring(line, F.lit(1), low), F.substring(line, n - (length - high) + 1, length - high))


def _deletions(line: Column, n: Column, blocks: int) -> Column:
    """All block deletions, for neighbourhoods where the line is the longest and one shorter."""
    return F.flatten(F.transform(F.array(n, n + 1), lambda length: F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda block: F.struct(length.alias("length"), block.alias("block"), _without(line, n, block, blocks, length).alias("variant")),
    )))


def _numbered(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per line that is not blank."""
    return docs.select(F.col(key).cast("long").alias("key"), F.posexplode(F.split(F.col(text), "\n")).alias("number", "line")).where(
        F.col("line").rlike(r"[^ \t\r\x0B\f]")
    )


def places(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Place, hashes, length and coarse deletions of every line that is not blank."""
    lines = _numbered(docs, text, key).withColumn("n", F.length("line"))
    cases = [(length, F.lit(block)) for length in (F.col("n"), F.col("n") + 1) for block in range(COARSE)]
    return lines.select(
        _place(F.col("key"), F.col("number"), F.col("line")).alias("place"), "key", "number", *_id(F.col("line")), "n",
        *[_without(F.col("line"), F.col("n"), block, COARSE, length).alias(f"v{i}") for i, (length, block) in enumerate(cases)],
    )


def near_lines(docs: DataFrame, distinct: DataFrame, text: str, key: str) -> DataFrame:
    """``place`` of the distinct lines that an earlier line is one edit away from."""
    long = distinct.where(F.col("n") >= LEAST_CHARS)
    variants = [F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("variant")) for i in range(2 * COARSE)]
    coarse = long.select("a", F.explode(F.array(*variants)).alias("v")).select("a", "v.variant")
    shared = coarse.groupBy("variant").agg(F.count("*").alias("m")).where("m > 1").select("variant")
    # One hash names the line here: the few others that it may name as well do no harm.
    found = coarse.join(shared, "variant", "left_semi").select("a").distinct()
    some = long.join(found, "a", "left_semi").select("a", "b", "place")

    # The text of the lines that go on, from the document of each one's earliest place.
    at = (_without_ties(F.col("place")) / TIES).cast("decimal(38,0)")
    number = F.pmod(at, F.lit(PLACE).cast("decimal(38,0)")).cast("int")
    doc = ((at - number) / PLACE).cast("decimal(20,0)").cast("long")
    wanted = some.groupBy(doc.alias("wanted_key")).agg(F.collect_set(number).alias("numbers"))
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(text).alias("text"))
    joined = source.join(wanted, F.col("key") == F.col("wanted_key"))
    texts = joined.select("key", F.explode(F.get(F.transform(F.array(F.split("text", "\n")), lambda every: F.transform(
        "numbers", lambda i: F.struct(i.alias("number"), F.get(every, i).alias("line")))), F.lit(0))).alias("l"))
    texts = texts.select(_place(F.col("key"), F.col("l.number"), F.col("l.line")).alias("place"), "l.line", *_id(F.col("l.line")))
    lines = stored(
        texts.join(some, ["a", "b", "place"], "left_semi").dropDuplicates(["a", "b"])
        .withColumn("n", F.length("line")), "lines",
    )

    fine = lines.select("place", "line", "n", F.explode(_deletions(F.col("line"), F.col("n"), FINE)).alias("v"))
    fine = fine.select("place", "line", "n", "v.*")
    common = fine.groupBy("variant").agg(F.count("*").alias("m")).where("m > 1").select("variant")
    low, high = _bounds(F.col("block"), FINE, F.col("length"))
    matched = fine.join(common, "variant", "left_semi").where(high > low)
    # Single characters: 'same' deletes from lines of equal length, 'cut' makes a shorter line, 'own' is one.
    at = F.explode(F.transform(F.sequence(low, high - 1), lambda e: F.struct(e.alias("e"), F.concat(
        F.substring("line", F.lit(1), e), F.substring(F.col("line"), e + 2, F.col("n"))).alias("rest"))))
    longest = matched.where(F.col("n") == F.col("length")).select("place", "variant", at.alias("c"))
    one = longest.select("place", F.explode(F.array(
        F.struct(F.lit("same").alias("kind"), F.xxhash64("variant", "c.e", "c.rest").alias("hash")),
        F.struct(F.lit("cut").alias("kind"), F.xxhash64("variant", "c.rest").alias("hash")),
    )).alias("k")).select("place", "k.*")
    own = matched.where(F.col("n") < F.col("length")).select(
        "place", F.lit("own").alias("kind"), F.xxhash64("variant", "line").alias("hash"))
    hashed = stored(one.unionAll(own), "variants")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("place"))).alias(f"least_{kind}")
    groups = hashed.groupBy("hash").agg(*map(least, ("same", "cut", "own")), F.count("*").alias("m")).where("m > 1").drop("m")
    other = F.when(F.col("kind") == "same", F.col("least_same")).when(
        F.col("kind") == "cut", F.col("least_own")).otherwise(F.col("least_cut"))
    pairs = hashed.join(groups, "hash").select("place", other.alias("earlier")).where(
        _without_ties(F.col("earlier")) < _without_ties(F.col("place"))).groupBy("place").agg(
        F.min("earlier").alias("earlier"))
    found = pairs.join(lines.select("place", F.col("line").alias("x")), "place").join(
        lines.select(F.col("place").alias("earlier"), F.col("line").alias("y")), "earlier")
    return found.where(F.levenshtein("x", "y", 1) >= 0).select("place")


def removed_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``number`` and hash ``a`` of every line that goes."""
    every = stored(places(docs, text, key), "places")
    distinct = stored(every.groupBy("a", "b").agg(
        F.min("place").alias("place"), F.min("n").alias("n"), *[F.min(f"v{i}").alias(f"v{i}") for i in range(2 * COARSE)]
    ), "distinct")
    near = near_lines(docs, distinct, text, key).withColumn("near", F.lit(True))
    verdict = distinct.select("a", "b", "place").join(near, "place", "left").select(
        "a", "b", F.when(F.col("near").isNull(), F.col("place")).alias("stays"))
    return every.join(verdict, ["a", "b"]).where(F.col("stays").isNull() | (F.col("place") != F.col("stays"))).select("key", "number", "a")


def cleaned(docs: DataFrame, text: str = "text", key: str = "doc_id", counts: bool = False) -> DataFrame:
    """``docs`` without removed lines in ``text``; with ``counts`` also ``n_lines`` and ``n_removed``."""
    gone = removed_lines(docs, text, key).groupBy(F.coalesce("key", F.lit(NO_KEY)).alias("__key")).agg(
        F.collect_set(F.struct("number", "a")).alias("__gone"))
    own = docs.withColumn("__own", F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)))
    joined = own.join(gone, F.col("__own") == F.col("__key"), "left").withColumn("__lines", F.split(F.col(text), "\n"))
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    # Rows may share a key: a place is only lost by the row that has the removed line there.
    here = F.filter("__gone", lambda g: F.xxhash64(F.get(F.col("__lines"), g["number"])) == g["a"])
    joined = joined.withColumn("__stay", F.when(
        F.col("__gone").isNotNull() & F.col("__lines").isNotNull(), F.array_except(every, F.transform(here, lambda g: g["number"]))))
    numbers = {
        "n_lines": F.coalesce(F.size("__lines"), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("__lines") - F.size("__stay"), F.lit(0)).cast("long"),
    } if counts else {}
    return joined.withColumns(numbers | {
        text: F.when(F.col("__stay").isNull(), F.col(text)).otherwise(
            F.array_join(F.transform("__stay", lambda i: F.get("__lines", i)), "\n")),
    }).drop("__own", "__key", "__gone", "__lines", "__stay")


SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents
), parts AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number FROM rows
), l AS (
  SELECT r, number, line, rank() OVER (ORDER BY doc_id NULLS FIRST, number) AS place FROM parts
  WHERE length(translate(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12), '')) > 0
), d AS (SELECT line, length(line) AS n, min(place) AS place FROM l GROUP BY line
), near AS (
  SELECT DISTINCT x.line FROM d x JOIN d y
    ON y.n BETWEEN x.n - 1 AND x.n + 1 AND y.place < x.place AND x.n >= {LEAST_CHARS} AND y.n >= {LEAST_CHARS}
   AND levenshtein(x.line, y.line) <= 1
), gone AS (
  SELECT l.r, l.number FROM l JOIN d USING (line) LEFT JOIN near ON near.line = l.line
  WHERE near.line IS NOT NULL OR l.place <> d.place
), every AS (
  SELECT r, doc_id, text, coalesce(len(string_split(text, chr(10))), 0) AS n_lines FROM rows
), kept AS (
  SELECT p.r, string_agg(p.line, chr(10) ORDER BY p.number) AS text, count(*) AS n
  FROM parts p ANTI JOIN gone g ON p.r = g.r AND p.number = g.number GROUP BY p.r
)
SELECT e.doc_id, e.n_lines, e.n_lines - coalesce(k.n, 0) AS n_removed,
       CASE WHEN e.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM every e LEFT JOIN kept k USING (r)
"""
