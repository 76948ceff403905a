"""Quality rules: an isolation forest over rule statistics, calibrated from labelled rows.

``statistics`` counts, over the whole text, what the rules look at. ``verdicts`` turns the counts into
rates and fits an isolation forest: each tree splits ``psi`` rows by random features at random values
until they stand alone or the height ``limit`` is reached; rows that few splits isolate are anomalous.
The trees' rows (``trees * psi`` at most, a documented bound of the fit) are drawn in hash order of the
id from labelled rows, nearly all of them clean, and the trees are grown on the driver; they are then
broadcast (``trees * 2 ** limit`` nodes at most). The score of a row is ``2 ** (-mean path / c(psi))``.

The threshold comes from all labelled rows: their scores are counted in ``BINS`` bins by label, and the
threshold is the one with the largest (junk rejected - clean rejected) among those that reject at most
``clean_loss`` of the clean rows. Without labels nothing is called an anomaly.

The base rule rejects texts with fewer than 50 words, or with more than half of their words inside
3-word windows that the text has twice or more.

Defined results: a null text has no words (base_failed); a repeated row gets the same answer as its
twin; a row without an id is judged and never fitted on; several labels for one id count as junk if
any is 0; null labels are left out; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.llm import text as tx
from ferrum.llm.base import stored

_U = np.uint64
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!\"'()+,-./:;=?@[\\]^_`{}~")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_letters", "n_marks", "n_digits", "n_distinct"]
BINS = 2000


def _twins(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: how often its text has it, and whether it is the first of them."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    _, first, inverse, count = np.unique(tx.mix(h ^ tx.mix(owner.astype(_U) + _U(1))), return_index=True,
                                         return_inverse=True, return_counts=True)
    lead = np.zeros(len(h), dtype=bool)
    lead[first] = True
    return count[inverse], lead


def count_rules(t: tx.Texts) -> np.ndarray:
    """COUNTS and MORE of each text, one row each."""
    w = tx.words(t)
    owner, n_words = w.owner(), w.counts()
    sums = tx.prefix_sums(t.buf)
    h = tx.range_hash(sums, w.starts, w.ends)
    outside = np.zeros(len(t.buf) + 1, dtype=np.int64)
    np.cumsum((t.buf & 0xC0) != 0x80, out=outside[1:])
    chars = tx.per_text_sum(outside[w.ends] - outside[w.starts], w.offs)
    cut = np.flatnonzero(t.buf == 10)
    lo = np.sort(np.concatenate([t.offs[:-1], cut + 1]))
    line_owner = np.clip(np.searchsorted(t.offs, lo, side="right") - 1, 0, len(t) - 1)
    # a text that ends in \n has an empty last line; it counts nowhere
    hi = np.minimum(np.append(lo[1:], len(t.buf)), t.offs[line_owner + 1])
    hi = hi - ((hi > lo) & (hi > 0) & (t.buf[np.maximum(hi - 1, 0)] == 10) if len(t.buf) else 0)
    full = np.searchsorted(w.starts, hi) > np.searchsorted(w.starts, lo)
    lo, hi, line_owner = lo[full], hi[full], line_owner[full]
    _, lead = _twins(line_owner, tx.range_hash(sums, lo, hi))
    dup = np.bincount(line_owner[~lead], minlength=len(t))
    repeat = np.zeros(len(t), dtype=np.int64)
    if len(h) > 2:
        inside = owner[2:] == owner[:-2]
        win = tx.mix(tx.mix(h[:-2] * _U(3) + h[1:-1]) * _U(3) + h[2:])
        times = np.zeros(len(win), dtype=np.int64)
        times[inside] = _twins(owner[:-2][inside], win[inside])[0]
        hit = np.zeros(len(h), dtype=bool)
        at = np.flatnonzero(times > 1)
        for k in range(3):
            hit[at + k] = True
        repeat = np.bincount(owner[hit], minlength=len(t))
    _, lead = _twins(owner, h)
    of = lambda table: tx.per_text_sum(table[t.buf], t.offs)
    return np.stack([n_words, chars, of(_SYMBOL), dup, repeat, np.bincount(line_owner, minlength=len(t)), of(_UPPER),
                     of(_LETTER), of(_MARK), of(_DIGIT), np.bincount(owner[lead], minlength=len(t))], axis=1)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row of ``docs`` (doc_id, text)."""
    names = [*COUNTS, *MORE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                got = count_rules(t).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(t.first, len(t)), *(pa.array(x) for x in got.T)], names=["doc_id", *names])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def rates(s: pd.DataFrame) -> np.ndarray:
    """What the forest sees: rates, so that a text's length alone is no anomaly. Rates that are near 0 in
    clean text are bent (r / (r + bend)), so that random splits find the small ones too."""
    bent = lambda r, bend: r / (r + bend)
    x = {c: s[c].to_numpy(dtype=np.float64) for c in [*COUNTS, *MORE]}
    words, chars = np.maximum(x["n_words"], 1), np.maximum(x["word_chars"], 1)
    return np.stack([
        bent(x["n_symbols"] / words, 0.05), x["word_chars"] / words, x["n_dup_lines"] / np.maximum(x["n_lines"], 1),
        bent(x["n_repeat_words"] / words, 0.2), bent(x["n_upper"] / np.maximum(x["n_letters"], 1), 0.1),
        bent(x["n_marks"] / words, 0.5), x["n_digits"] / chars, x["n_distinct"] / words,
    ], axis=1)


def _mean_path(n: float) -> float:
    """Average path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Trees as arrays: feature (-1 at a leaf), split value, left child (right is next), path length.

    A node's split value is drawn over the node's box, which starts as the range of all of ``rows``;
    so a region that a tree's own rows leave empty is cut off after few splits.
    """

    def __init__(self, rows: np.ndarray, trees: int, psi: int, limit: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.psi = psi
        self.nodes: list[tuple[np.ndarray, ...]] = []
        for k in range(trees):
            part = rows[k::trees]
            if len(part):
                self.nodes.append(self._grow(part[:psi], rows.min(axis=0), rows.max(axis=0), rng, limit))

    @staticmethod
    def _grow(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[np.ndarray, ...]:
        feature, value, left, path = [-1], [0.0], [0], [0.0]
        todo = [(0, rows, lo, hi, 0)]
        while todo:
            at, x, lo, hi, depth = todo.pop()
            live = np.flatnonzero(hi > lo)
            if len(x) < 2 or depth >= limit or not len(live):
                path[at] = depth + _mean_path(len(x))
                continue
            f = int(rng.choice(live))
            v = float(rng.uniform(lo[f], hi[f]))
            feature[at], value[at], left[at] = f, v, len(feature)
            under, over = hi.copy(), lo.copy()
            under[f], over[f] = v, v
            for side, a, b in ((x[x[:, f] < v], lo, under), (x[x[:, f] >= v], over, hi)):
                todo.append((len(feature), side, a, b, depth + 1))
                feature.append(-1), value.append(0.0), left.append(0), path.append(0.0)
        return np.array(feature), np.array(value), np.array(left), np.array(path)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, value, left, path in self.nodes:
            at, live = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
            while len(live):
                f = feature[at[live]]
                live, f = live[f >= 0], f[f >= 0]
                at[live] = left[at[live]] + (rows[live, f] >= value[at[live]])
            total += path[at]
        depth = _mean_path(max(min(self.psi, 1 << 30), 3))
        return 2 ** (-total / max(len(self.nodes), 1) / depth) if self.nodes else np.zeros(len(rows))


def verdicts(docs: DataFrame, labels: DataFrame, trees: int = 100, psi: int = 64, limit: int = 12,
             clean_loss: float = 0.02, junk_share: float = 0.02) -> DataFrame:
    """doc_id, counts, base_failed, anomaly score and kept of every row of ``docs`` (doc_id, text).

    ``junk_share`` is the share of the trees' rows that is drawn from junk; anomalies must be few.
    """
    stats = stored(statistics(docs), "quality-stats")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    marks = marks.where("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.min("good").alias("good"))
    known = stored(stats.join(marks, "doc_id").where("n_words >= 50"), "quality-known")
    size = trees * psi  # drawn for the trees
    pool = [known.where(cond).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).toPandas()
            for cond, n in (("good = 1", size - int(size * junk_share)), ("good = 0", int(size * junk_share)))]
    share = len(pool[0]) * junk_share / (1 - junk_share)
    pool = pd.concat([pool[0], pool[1].head(int(share))], ignore_index=True)
    pool = pool.iloc[np.argsort(tx.mix(pool["doc_id"].to_numpy().astype(np.int64).view(_U)), kind="stable")]
    shared = stats.sparkSession.sparkContext.broadcast(Forest(rates(pool), trees, psi, limit))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(anomaly=shared.value.scores(rates(b)))

    def scored(df: DataFrame) -> DataFrame:
        kinds = ", ".join(f"`{c}` {k}" for c, k in df.dtypes)
        return df.mapInPandas(run, f"{kinds}, anomaly double")

    bins = scored(known).groupBy(F.floor(F.col("anomaly") * BINS).alias("bin")).agg(
        F.sum(F.col("good")).alias("clean"), F.sum(1 - F.col("good")).alias("junk")).toPandas()
    clean, junk = (np.bincount(bins["bin"].to_numpy(dtype=np.int64), bins[c].to_numpy(dtype=np.float64), BINS + 2) for c in ("clean", "junk"))
    above = lambda x: np.cumsum(x[::-1])[::-1] / max(x.sum(), 1)
    gain = np.where(above(clean) <= clean_loss, above(junk) - above(clean), -1.0)
    bar = float(np.argmax(gain)) / BINS if len(bins) else 2.0
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored(stats).select("doc_id", *COUNTS, failed.alias("base_failed"),
                                (~failed & (F.col("anomaly") < bar)).alias("kept"), "anomaly",
                                F.lit(bar).alias("anomaly_limit"))
