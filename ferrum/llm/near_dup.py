"""MinHash near-dedup with SuperMinHash signatures.

Signatures: for element e and step j = 0, 1, ... a random permutation of the m slots (Fisher-Yates,
seeded by e) gives the slot that gets rank j + u(e, j); a slot keeps its smallest rank. The ranks of
one element are a permutation over the slots, so they are correlated and the signature estimates
Jaccard with less variance than independent hashes. No later step can change a slot below the current
step, so a text stops as soon as its largest rank is under j + 1: a long text takes one or two steps
instead of m. All texts of a slice advance together.

Grouping:

1. equal shingle sets (128-bit fingerprint) become one representative;
2. signatures are cut in ``bands``; buckets are (band, values). At Jaccard 0.85 a pair misses all 20
   bands of 4 with probability 4e-7;
3. stars: each representative is checked on full sets against a hub of a bucket it is in, and the
   links go into distributed union-find. Two star rounds use different hubs, the smallest id and a
   random one;
4. representatives that still share a bucket with another component are joined exactly: shingles are
   ordered by rarity, and only pairs of different components that share a shingle within the prefix a
   link needs, at places that leave room for enough common shingles, are checked. A large group is one
   component by then and makes no pairs among itself; many texts that are alike but not enough differ
   in their rare shingles and make hardly any.

The check is exact on the sets of 64-bit shingle hashes: 100 * intersection >= percent * union.

Defined results: null and empty texts have no shingles and link to nothing; a text with fewer words
than ``width`` is one shingle; repeated rows are copies of each other; rows that share an id are one
node; rows without an id stay alone (component_id null, kept); extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.llm import text as tx
from ferrum.llm.base import RARITY_BITS, connected_components, possible, rarity, stored

_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)
BANDS, ROWS = 20, 4
_STEP = tx.mix(np.arange(1, 257, dtype=_U))


def signatures(elements: np.ndarray, offs: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash of each text's elements: step in the top 8 bits, fraction below. m < 256."""
    texts = len(offs) - 1
    sig = np.full(texts * m, _NONE, dtype=_U)
    owner = np.repeat(np.arange(texts), np.diff(offs))
    e, perm = elements, None
    for j in range(m):
        if not len(e):
            break
        draw = tx.mix(e + _STEP[j])
        pick = j + (draw % _U(m - j)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            row = np.arange(len(e))
            slot = perm[row, pick].astype(np.int64)
            perm[row, pick] = perm[row, j]
            perm[row, j] = slot
        rank = (_U(j) << _U(56)) | (tx.mix(draw ^ _U(0xA0761D6478BD642F)) >> _U(8))
        np.minimum.at(sig, owner * m + slot, rank)
        open_ = sig.reshape(texts, m).max(axis=1) >= (_U(j + 1) << _U(56)) if j < 255 else np.zeros(texts, bool)
        stay = open_[owner]
        if perm is None:
            e, owner, slot = e[stay], owner[stay], slot[stay]
            perm = np.tile(np.arange(m, dtype=np.uint8), (len(e), 1))
            row = np.arange(len(e))
            perm[row, slot] = 0
            perm[row, 0] = slot
        elif not stay.all():
            e, owner, perm = e[stay], owner[stay], perm[stay]
    return sig.reshape(texts, m)


def _sets(t: tx.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their offsets."""
    t = tx.lower(t)
    w = tx.words(t)
    h, offs = tx.shingles(tx.word_hashes(t, w), w.offs, width)
    parts = []
    for a, b in zip(offs[:-1], offs[1:], strict=True):
        x = np.sort(h[a:b])
        parts.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x)
    n = np.array([len(x) for x in parts], dtype=np.int64)
    return (np.concatenate(parts) if parts else h), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _fold(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def sketch(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, fingerprint (a, b) and the bucket of every band."""
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                e, offs = _sets(t, width)
                sig = signatures(e, offs, m).reshape(len(t), bands, rows)
                key = np.tile(np.arange(1, bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15), (len(t), 1))
                for k in range(rows):
                    key = tx.mix(key * _U(3) + sig[:, :, k])
                n = np.diff(offs)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(t.first, len(t)), pa.array(n),
                    pa.array(tx.signed(_fold(tx.mix(e + _U(11)), offs))),
                    pa.array(tx.signed(_fold(tx.mix(e ^ _U(0x5851F42D4C957F2D)), offs))),
                    pa.ListArray.from_arrays(np.arange(0, (len(t) + 1) * bands, bands, dtype=np.int32),
                                             pa.array(tx.signed(key.ravel()))),
                ], names=["doc_id", "n_shingles", "a", "b", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, a long, b long, buckets array<long>")


def _full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """node, set of the texts that ``ids`` names (one per node), as sorted arrays of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                e, offs = _sets(t, width)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(t.first, len(t)),
                     pa.ListArray.from_arrays(offs.astype(np.int32), pa.array(tx.signed(e)))],
                    names=["node", "items"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = possible(texts.where("doc_id IS NOT NULL"), ids.select(F.col("node").alias("doc_id")), "doc_id")
    texts = texts.join(ids.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    return texts.mapInArrow(run, "node long, items array<long>")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough. The check is symmetric."""
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("y"))
    near = "100 * least(size(x), size(y)) >= {p} * greatest(size(x), size(y))".format(p=percent)
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(right, "v").join(left, "u").where(near).where(
        100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("u", "v")


def _open(spots: DataFrame, parts: DataFrame) -> DataFrame:
    """bucket, node, component and pick (hash of one node) of the buckets that hold several components."""
    here = spots.select("bucket", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = here.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1"),
                                       F.min(F.xxhash64("node")).alias("pick")).where("c0 < c1")
    return stored(here.join(mixed, "bucket").drop("c0", "c1"), "near-open")


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of nodes of different components whose sets may reach ``percent``; none is missed.

    ``sets``: node, component, items. Of n items ordered by rarity, a partner must share one of the
    first ``n - ceil(percent * n / 100) + 1``; from a shared place on, enough items must be left.
    """
    sets = stored(sets, "near-rest")
    counts = sets.sparkSession.sparkContext.broadcast(rarity(sets.select(F.explode("items").alias("item")), "item"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = b.column("items")
            cut, flat = np.asarray(items.offsets), np.asarray(items.values)
            found: list[list[np.ndarray]] = [[], [], [], []]
            for i in range(len(b)):
                x = flat[cut[i]: cut[i + 1]]
                often = counts.value[x & ((1 << RARITY_BITS) - 1)]
                need = len(x) - -(-percent * len(x) // 100) + 1
                first = np.lexsort((x, often))[:need]
                place = np.flatnonzero(often[first] > 1)
                for to, v in zip(found, (x[first][place], np.full(len(place), i), np.full(len(place), len(x)), place), strict=True):
                    to.append(v)
            item, who, size, place = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in found)
            who = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), b.column("node").take(who), b.column("component").take(who),
                 pa.array(size.astype(np.int32)), pa.array(place.astype(np.int32))],
                names=["item", "node", "component", "n", "at"])

    spots = stored(sets.select("node", "component", "items").mapInArrow(
        run, "item long, node long, component long, n int, at int"), "near-prefix")
    mixed = spots.groupBy("item").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("item")
    spots = stored(spots.join(mixed, "item", "left_semi"), "near-prefix")
    a, b = (spots.select("item", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "n", "at")]) for s in "ab")
    room = "(100 + {p}) * (least(n_a - at_a, n_b - at_b)) >= {p} * (n_a + n_b)"
    near = "100 * least(n_a, n_b) >= {p} * greatest(n_a, n_b)"
    return a.join(b, "item").where(f"component_a < component_b AND {near} AND {room}".format(p=percent)).select(
        F.col("node_a").alias("u"), F.col("node_b").alias("v")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    marks = stored(sketch(docs, width, bands, rows), "near-marks")
    # Equal sets have equal buckets, so any of them speaks for the class.
    classes = marks.where("n_shingles > 0").groupBy("a", "b").agg(F.min("doc_id").alias("node"), F.first("buckets").alias("buckets"))
    classes = stored(classes.where("node IS NOT NULL"), "near-classes")
    spots = classes.select("node", F.explode("buckets").alias("bucket"))
    shared = spots.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    spots = stored(spots.join(shared.select("bucket", "low"), "bucket"), "near-spots")
    sets = stored(_full_sets(docs, spots, width), "near-sets")

    stars = spots.where("node <> low").groupBy("node").agg(F.min("low").alias("v")).withColumnRenamed("node", "u")
    links = stored(_links(stars, sets, percent), "near-links")
    parts = stored(connected_components(links), "near-parts")
    here = _open(spots, parts)
    if not here.isEmpty():
        hub = here.where(F.xxhash64("node") == F.col("pick")).select(
            "bucket", F.col("node").alias("v"), F.col("component").alias("other"))
        stars = here.select("bucket", F.col("node").alias("u"), "component").join(hub, "bucket").where(
            "component <> other").groupBy("u").agg(F.min("v").alias("v"))
        more = stored(_links(stars, sets, percent), "near-links")
        if not more.isEmpty():
            links = stored(links.unionByName(more), "near-links")
            parts = stored(connected_components(links), "near-parts")
            here = _open(spots, parts)
        rest = here.groupBy("node").agg(F.min("component").alias("component"))
        more = stored(_links(_prefix_pairs(sets.join(rest, "node"), percent), sets, percent), "near-links")
        if not more.isEmpty():
            parts = stored(connected_components(links.unionByName(more)), "near-parts")

    marked = marks.select("doc_id", "n_shingles", "a", "b").join(classes.drop("buckets"), ["a", "b"], "left").join(parts, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node", "doc_id")).otherwise(F.col("doc_id"))
    return marked.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: one of each component, one of repeated rows."""
    marks = stored(near_duplicates(docs, width, percent).select("doc_id", "kept"), "near-result")
    gone = marks.where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    twins = marks.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("twin_id")).agg(F.count("*").alias("n")).where(
        "n > 1").select("twin_id")
    key = F.col("doc_id").cast("long")
    left = docs.join(gone, key == F.col("gone_id"), "left_anti")
    twice = left.join(twins, key == F.col("twin_id"), "left_semi").dropDuplicates(["doc_id"])
    return left.join(twins, key == F.col("twin_id"), "left_anti").unionByName(twice)
