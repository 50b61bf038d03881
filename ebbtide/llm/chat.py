"""Chat rendering of maximal conversations: logged snapshots of longer ones are left out.

A conversation is its turns in order: turn number, role and text. A turn prefix has a
rolling hash, the exclusive or of the hashes of its turns, each of which holds its turn
number; two 64-bit hashes and the number of turns identify it. A conversation whose last
prefix hash is that of a shorter prefix of another is a snapshot, and an anti-join drops it.
Of equal conversations the smallest id stays.

Prefix hashes come from window sums in blocks of ``BLOCK`` turns and running sums of the
blocks' totals, so a conversation that holds much of the table is spread over tasks.
Prefixes are made distinct before the join, so a first turn that many conversations share
is one row. Everything is DataFrame code.

Results: null roles and texts read as empty, a null turn as before all others, and the rows
of a null conv_id as one conversation; repeated rows count once; different rows of one turn
follow each other by role and text and enter a prefix together; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import stored

#: Turns that one window task handles at most for a block of a conversation.
BLOCK = 64
FIRST_TURN = -(2**63)


def _turns(messages: DataFrame) -> DataFrame:
    """Distinct messages with defined values; ``turn_key`` orders them."""
    return messages.select(
        F.col("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN)).alias("turn_key"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """One row per conversation and turn: ``n``, ``h1``, ``h2`` of the prefix, and ``last``."""
    one = F.xxhash64("turn_key", "role", "text")
    two = F.xxhash64(F.lit("second"), "text", "role", "turn_key")
    by_turn = turns.groupBy("conv_id", "turn_key").agg(
        F.count("*").alias("n"), F.bit_xor(one).alias("h1"), F.bit_xor(two).alias("h2")
    ).withColumn("block", F.floor(F.col("turn_key") / BLOCK))
    blocks = by_turn.groupBy("conv_id", "block").agg(
        F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_block = Window.partitionBy("conv_id")
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("x1"),
        F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("x2"),
        (F.col("block") == F.max("block").over(last_block)).alias("last_block"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn_key").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.partitionBy("conv_id", "block").orderBy(F.desc("turn_key"))
    rows = by_turn.select(
        "conv_id", "block", F.sum("n").over(within).alias("n"), F.bit_xor("h1").over(within).alias("h1"),
        F.bit_xor("h2").over(within).alias("h2"), (F.row_number().over(rest) == 1).alias("last_in_block"),
    )
    return rows.join(blocks, rows["conv_id"].eqNullSafe(blocks["c"]) & (rows["block"] == blocks["b"])).select(
        "conv_id", (F.col("n") + F.col("n0")).alias("n"), F.col("h1").bitwiseXOR(F.col("x1")).alias("h1"),
        F.col("h2").bitwiseXOR(F.col("x2")).alias("h2"), (F.col("last_block") & F.col("last_in_block")).alias("last"),
    )


def maximal(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``n_copies`` of the conversations that no longer one begins with."""
    prefixes = stored(prefix_hashes(_turns(messages)), "prefixes")
    whole = prefixes.where("last").groupBy("n", "h1", "h2").agg(
        F.min_by("conv_id", F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("conv_id"), F.count("*").alias("n_copies")
    )
    shorter = prefixes.where("not last").select("n", "h1", "h2").distinct()
    return whole.join(shorter, ["n", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("n").alias("n_turns"), "n_copies"
    )


def _message(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def rendered(messages: DataFrame) -> DataFrame:
    """Maximal conversations with their ``chat`` text."""
    kept = stored(maximal(messages).withColumnRenamed("conv_id", "kept_id"), "kept")
    # Turns that are not kept go before any conversation is put together.
    turns = _turns(messages).join(kept.select("kept_id"), F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn_key", "role", "text"))).alias("t"))
    return whole.join(kept, whole["conv_id"].eqNullSafe(kept["kept_id"])).select(
        "conv_id", "n_turns", "n_copies",
        F.array_join(F.transform("t", lambda m: _message(m["role"], m["text"])), "").alias("chat"),
    )


SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), g AS (
  SELECT conv_id, turn, count(*) AS n,
         string_agg(coalesce(turn::VARCHAR, '') || chr(1) || role || chr(1) || text, chr(2) ORDER BY role, text) AS line,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY role, text) AS chat
  FROM t GROUP BY conv_id, turn
), p AS (
  SELECT conv_id, sum(n) OVER w AS n_turns, string_agg(line, chr(3)) OVER w AS prefix, string_agg(chat, '') OVER w AS chat,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS last
  FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
)
SELECT min(conv_id) AS conv_id, any_value(n_turns)::BIGINT AS n_turns, count(*) AS n_copies, any_value(chat) AS chat
FROM p WHERE last AND prefix NOT IN (SELECT prefix FROM p WHERE NOT last)
GROUP BY prefix
"""
