"""Chat formatting: conversations logged again and again as they grow are collapsed, then rendered.

Every turn gets the hash of the conversation up to and including it (a rolling 128-bit hash over
place, role and text). A conversation whose last hash is a proper prefix hash of another one is a
snapshot of it and goes (anti-join); of conversations with equal turns the smallest id stays. The rest,
the maximal conversations, are rendered: ``<|role|>``, a line feed, the text, ``<|end|>``, a line feed
for each turn.

The running hash of a conversation is made per cell of ``CELL`` turn numbers first and then over the
cells, so a very long conversation is not ordered in one task; it is gathered only where it is rendered
into its one output row, and only if it is maximal. Prefix hashes are made distinct before the join, so
a first turn that very many conversations share is one row.

Defined results: turns are ordered by turn number (null first), then role, then text; a turn row that
is repeated in every one of the four columns counts once; a null role or text counts as empty; turns
without a conv_id belong to no conversation and are left out; an empty table gives no rows; extra
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrum.llm.base import stored

CELL = 256


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, nth (1 ..), turn, role, text, and the hash (a, b) of the conversation so far."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.where("conv_id IS NOT NULL").distinct().withColumn("cell", F.floor(F.col("turn") / CELL))
    before = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = t.groupBy("conv_id", "cell").agg(F.count("*").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    here = Window.partitionBy("conv_id", "cell").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = ["conv_id", "cell"]
    other = [F.col("c.conv_id") == F.col("t.conv_id"), F.col("c.cell").eqNullSafe(F.col("t.cell"))]
    t = t.alias("t").join(cells.alias("c"), other).select("t.*", "first").withColumn(
        "nth", F.col("first") + F.row_number().over(here))
    t = t.withColumn("x", F.xxhash64("nth", "role", "text")).withColumn("y", F.xxhash64("text", "nth", "role", F.lit("y")))
    t = stored(t.drop("first"), "chat-turns")
    cells = t.groupBy(*same).agg(F.bit_xor("x").alias("cx"), F.bit_xor("y").alias("cy"))
    cells = cells.select(*same, F.coalesce(F.bit_xor("cx").over(before), F.lit(0)).alias("px"),
                         F.coalesce(F.bit_xor("cy").over(before), F.lit(0)).alias("py"))
    upto = Window.partitionBy("conv_id", "cell").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({"wx": F.bit_xor("x").over(upto), "wy": F.bit_xor("y").over(upto)})
    return t.alias("t").join(cells.alias("c"), other).select(
        "t.conv_id", "nth", "turn", "role", "text", F.col("px").bitwiseXOR(F.col("wx")).alias("a"),
        F.col("py").bitwiseXOR(F.col("wy")).alias("b"))


def maximal(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, turns): conv_id, n_turns, n_copies of the maximal conversations, and all turns in order."""
    hashed = stored(prefix_hashes(turns), "chat-hashes")
    size = hashed.groupBy("conv_id").agg(F.max("nth").alias("n_turns"))
    marked = hashed.select("conv_id", "nth", "a", "b").join(size, "conv_id")
    last = marked.where("nth = n_turns").groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_turns").alias("n_turns"), F.count("*").alias("n_copies"))
    inner = marked.where("nth < n_turns").select("a", "b").distinct()
    return last.join(inner, ["a", "b"], "left_anti").select("conv_id", "n_turns", "n_copies"), hashed


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and chat of every maximal conversation."""
    kept, hashed = maximal(turns)
    one = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    lines = hashed.join(kept, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("nth", one.alias("s")))).alias("parts"))
    return lines.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("parts.s"), "").alias("chat"))


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS n_turns,
             string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '') OVER (w ROWS UNBOUNDED PRECEDING) AS chat
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT chat, min(conv_id) AS conv_id, max(n_turns) AS n_turns, count(*) AS n_copies FROM o WHERE nth = n_turns GROUP BY chat)
SELECT conv_id, n_turns, n_copies, chat FROM f WHERE chat NOT IN (SELECT chat FROM o WHERE nth < n_turns)
"""
