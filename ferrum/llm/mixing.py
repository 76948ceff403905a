"""Mixing sources to target weights by Pareto order sampling.

A document's size is its number of words. Source targets share the total size by weight; a target
stops at ``most`` times its source's size and the excess is reshared by weight until none is above.
Each document first gets ``floor(target / source size)`` certain whole copies. What is left of the
target is an order sample: with u uniform from a hash of the id and inclusion odds that fall with the
square root of a document's size (``odds ~ 1 / sqrt(size)``, so that the partial copy is not a handful
of long texts), documents are ranked by ``(u / (1 - u)) / odds`` and taken from the smallest rank while
their words fit into what is left. Where a document does not fit, the sample goes on down the ranking with
those that do: the step is repeated over the documents not yet taken that fit into what is left, until none
does or the gap is at most ``GAP`` of the target. Common factors of the odds cancel in the ranking, so the
sample size is fixed by words. Two more picks per source then narrow the gap that is left: each takes the
largest document that still fits.

Running sums per source are made from histograms: ranks fall into ``CELLS`` cells, only the cell in
which the budget ends is split again, and only documents of that fine cell are ordered in a window.
So no source, however hot, is ordered in one task.

Defined results: null and empty texts have size 0 and are taken with 0 words; a null source is a
source of its own, last in order; sources are one row each and are numbered in one window (the source
list, not documents); repeated rows are ranked alike and may share one cell; a row without an id is
hashed as null. Same input, same result. Extra columns of the input are kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrum.llm.base import stored, unused

CELLS = 4096
#: Share of a source's target that the words taken may stay below it while documents that fit are left.
GAP = 0.001
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of words: runs of bytes other than space and 0x09-0x0D."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """source, source_size, target for every source of ``sizes`` (source, size)."""
    by_source = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    place = Window.orderBy(F.col("source").asc_nulls_last())
    shares = F.array(*[F.lit(float(w)) for w in weights])
    by_source = by_source.withColumn("weight", F.element_at(shares, (F.row_number().over(place) - 1) % len(weights) + 1))
    by_source = stored(by_source, "mix-weights")
    total = float(by_source.agg(F.sum("source_size")).first()[0] or 0)
    # level: words per unit of weight. Sources under their share at this level stop at their cap.
    level, full = 0.0, F.lit(False)
    while True:
        r = by_source.agg(F.sum(F.when(full, F.col("source_size") * most)).alias("capped"),
                          F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count(F.when(full, 1)).alias("n")).first()
        if not r["weight"]:
            break
        level = (total - float(r["capped"] or 0)) / float(r["weight"])
        full = F.col("source_size") * most < F.col("weight") * level
        if by_source.where(full).count() == r["n"]:
            break
    return by_source.select("source", "source_size",
                            F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)).alias("target"))


def uniform(doc_id: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) from the md5 of the id: 52 bits."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(2.0 ** 52)


def _fit_prefix(rows: DataFrame) -> DataFrame:
    """``rows`` (source, size, rank in (0, 1), left, ...) with ``chosen``: the longest run of smallest
    ranks of each source whose sizes add up to no more than ``left``."""
    cell = F.floor(F.col("rank") * CELLS).cast("int")
    fine = F.floor((F.col("rank") * CELLS - cell) * CELLS).cast("int")
    rows = rows.withColumn("cell", cell).withColumn("fine", fine)
    keys = [F.col("l.source").eqNullSafe(F.col("r.source"))]

    def border(part: DataFrame, by: str) -> DataFrame:
        """Per source: the cell in which the budget ends and the words before it."""
        sums = part.groupBy("source", by).agg(F.sum("size").alias("words"), F.max("budget").alias("budget"))
        run = Window.partitionBy("source").orderBy(by)
        sums = sums.withColumn("upto", F.sum("words").over(run)).where("upto > budget")
        first = sums.groupBy("source").agg(F.min(by).alias("edge"), F.min(F.col("upto")).alias("upto"))
        return first.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")) & (F.col("edge") == F.col(by))).select(
            "source", "edge", (first["upto"] - F.col("words")).alias("before"))

    rows = rows.withColumn("budget", F.col("left"))
    one = stored(border(rows, "cell"), "mix-border")
    rows = rows.alias("l").join(one.select("source", F.col("edge").alias("e1"), F.col("before").alias("b1")).alias("r"), keys, "left").drop(F.col("r.source"))
    two = stored(border(rows.where("cell = e1").withColumn("budget", F.col("left") - F.col("b1")), "fine"), "mix-border")
    rows = rows.alias("l").join(two.select("source", F.col("edge").alias("e2"), F.col("before").alias("b2")).alias("r"), keys, "left").drop(F.col("r.source"))
    inside = (F.col("cell") == F.col("e1")) & (F.col("fine") == F.col("e2"))
    order = Window.partitionBy("source", "fine").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rest = rows.where(inside).withColumn("run", F.sum("size").over(order)).withColumn(
        "chosen", F.col("run") + F.col("b1") + F.col("b2") <= F.col("left")).drop("run")
    before = F.col("e1").isNull() | (F.col("cell") < F.col("e1")) | ((F.col("cell") == F.col("e1")) & (F.col("e2").isNull() | (F.col("fine") < F.col("e2"))))
    sure = rows.where(~F.coalesce(inside, F.lit(False))).withColumn("chosen", before)
    return sure.unionByName(rest).drop("cell", "fine", "budget", "e1", "b1", "e2", "b2")


def _fill(rows: DataFrame) -> DataFrame:
    """``rows`` (source, size, rank, left, target, whole, chosen, ...), with more of them chosen: those that fit
    into what is left of a source, in rank order, until none does or the gap is at most ``GAP`` of the target."""
    while True:
        used = rows.groupBy("source").agg(F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0)).alias("used"))
        used = stored(used, "mix-used").withColumnRenamed("source", "s_")
        rest = rows.join(used, F.col("source").eqNullSafe(F.col("s_"))).drop("s_").withColumn("gap", F.col("left") - F.col("used"))
        fits = ~F.col("chosen") & (F.col("most") > F.col("whole")) & F.col("size").between(F.lit(1), F.col("gap")) & (F.col("gap") > GAP * F.col("target"))
        more = rest.where(fits).withColumn("all_", F.col("left")).withColumn("left", F.col("gap")).drop("chosen", "used", "gap")
        if more.isEmpty():
            return rows
        more = _fit_prefix(more).withColumn("left", F.col("all_"))
        rows = stored(rest.where(~fits).select(*rows.columns).unionByName(more.select(*rows.columns)), "mix-chosen")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix", top_up: int = 2) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row of ``docs`` (doc_id, text, source)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))
    base = stored(base, "mix-sizes")
    goal = targets(base, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", F.least(whole, F.lit(most).cast("long"))).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = stored(goal, "mix-targets")
    rows = base.alias("l").join(goal.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).drop(F.col("r.source"))
    u = uniform(F.col("doc_id"), seed)
    q = u / (1 - u) * F.sqrt(F.greatest(F.col("size"), F.lit(1)).cast("double"))
    rows = _fit_prefix(rows.withColumn("rank", q / (1 + q)))
    rows = stored(rows.withColumn("chosen", F.col("chosen") & (F.col("whole") < most)), "mix-chosen")
    rows = _fill(rows.withColumn("most", F.lit(most))).drop("most")
    for _ in range(top_up):
        used = rows.groupBy("source").agg(F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0)).alias("used"))
        spare = rows.alias("l").join(used.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).drop(F.col("r.source")).where(
            ~F.col("chosen") & (F.col("size") > 0) & (F.col("whole") < most) & (F.col("size") <= F.col("left") - F.col("used")))
        pick = spare.groupBy("source").agg(F.max(F.struct("size", -F.col("rank"), -F.col("doc_id"))).alias("p")).select(
            F.col("source").alias("ps"), F.col("p.size").alias("psize"), (-F.col("p.col2")).alias("prank"))
        picked = F.col("ps").eqNullSafe(F.col("source")) & (F.col("psize") == F.col("size")) & (F.col("prank") == F.col("rank")) & ~F.col("chosen")
        # a repeated row is picked with its twins only if it stands alone; else the gap stays
        pick = stored(pick, "mix-pick")
        alone = rows.join(pick, picked).groupBy("ps", "psize", "prank").agg(F.count("*").alias("n")).where("n = 1").drop("n")
        alone = stored(alone, "mix-pick")
        rows = stored(rows.join(alone, picked, "left").withColumn("chosen", F.col("chosen") | F.col("psize").isNotNull()).drop(
            "ps", "psize", "prank"), "mix-chosen")
    copies = F.col("whole") + F.col("chosen").cast("long")
    return rows.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
                       (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: rows of ``docs`` as often as the plan says, all columns kept.

    The plan is joined back by id and source; rows that share an id get as many copies each as the
    plan gives them on average, rounded down and the rest to the first in hash order of the text.
    """
    p = plan(docs, weights, most, seed).groupBy("doc_id", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    p = p.where("copies > 0")
    c, n, i = (unused(docs, x) for x in ("mix_copies", "mix_rows", "mix_twin"))
    j, s = unused(docs, "mix_id"), unused(docs, "mix_source")
    p = p.select(F.col("doc_id").alias(j), F.col("source").alias(s), F.col("copies").alias(c), F.col("rows").alias(n))
    got = docs.join(p, F.col("doc_id").cast("long").eqNullSafe(F.col(j)) & F.col("source").eqNullSafe(F.col(s)))
    twin = F.when(F.col(n) > 1, F.row_number().over(Window.partitionBy(j, s, n).orderBy(F.xxhash64("text")))).otherwise(1)
    single = got.where(F.col(n) == 1).withColumn(i, F.col(c))
    many = got.where(F.col(n) > 1).withColumn(i, twin).withColumn(
        i, F.floor(F.col(c) / F.col(n)) + (F.col(i) <= F.col(c) % F.col(n)).cast("long"))
    return single.unionByName(many).withColumn(i, F.explode(F.array_repeat(F.lit(1), F.col(i).cast("int")))).select(*docs.columns)
