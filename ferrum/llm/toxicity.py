"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, as a set: each lower-cased word, its first 4, 5 and 6 bytes (inflected and
compound words share a stem), each pair of neighbouring words, and each pair with one word between.
They are hashed into ``2**bits`` coordinates; coordinate 0 is the bias.

Training: the labelled rows that ``label_rows`` gets, at most ``max_rows`` of them in hash order of
their id (a documented bound of the classifier's sample). They are dealt into ``shards``; in each
round every shard runs FTRL-proximal over its rows in its own task, starting from the averaged state,
and the driver averages the states (``shards * 2**bits`` numbers at most, whatever the corpus).
The log odds of the toxic share are a fixed part of the bias, so a model that has seen few rows scores
near that share. Per-coordinate learning rates and the L1 term leave few weights that are not zero; only those are
sent to the scoring tasks.

Defined results: null or empty texts get the bias alone; texts are read whole, whatever their length;
rows with the same id are scored one by one; rows without an id are scored and never trained on;
several labels for one id count as toxic if any is; null labels are left out; without any training
row the weights are zero and every score is 0.5. ``label``, ``lang``, ``source`` and the id are never
inputs of a score. All columns of the input are kept; where it has a ``score`` or ``predicted`` of its
own, the new column's name gets an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrum.llm import text as tx
from ferrum.llm.base import stored, unused

_U = np.uint64


def features(t: tx.Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, coordinate) of every feature occurrence; coordinates are 1 .. 2**bits - 1."""
    t = tx.lower(t)
    w = tx.words(t)
    sums = tx.prefix_sums(t.buf)
    h = tx.range_hash(sums, w.starts, w.ends)
    owner = w.owner()
    kinds = [(owner, h)]
    for k, n in enumerate((4, 5, 6), start=1):
        longer = w.ends - w.starts > n
        s = w.starts[longer]
        kinds.append((owner[longer], tx.mix(tx.range_hash(sums, s, s + n) + _U(k))))
    for k, gap in enumerate((1, 2), start=7):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            kinds.append((owner[:-gap][same], tx.mix(h[:-gap] * _U(5) + h[gap:] + _U(k))[same]))
    at = np.concatenate([x for x, _ in kinds])
    coord = np.concatenate([x for _, x in kinds]) % _U((1 << bits) - 1) + _U(1)
    return at, coord.astype(np.int64)


def _sets(t: tx.Texts, bits: int) -> list[np.ndarray]:
    """The coordinates of each text, with the bias, each once."""
    at, coord = features(t, bits)
    size = np.int64(1 << bits)
    key = np.unique(np.concatenate([at * size + coord, np.arange(len(t)) * size]))
    return np.split(key & (size - 1), np.searchsorted(key >> bits, np.arange(1, len(t))))


@dataclass
class Model:
    bits: int
    coords: np.ndarray  # sorted, without the bias
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        dense = np.zeros(1 << self.bits)
        dense[self.coords] = self.weights
        out = []
        for t in tx.slices(column):
            at, coord = features(t, self.bits)
            live = dense[coord] != 0
            once = np.unique(at[live] * np.int64(1 << self.bits) + coord[live])
            total = np.bincount(once >> self.bits, dense[once & ((1 << self.bits) - 1)], minlength=len(t))
            out.append(1 / (1 + np.exp(-np.clip(total + self.bias, -60, 60))))
        return np.concatenate(out) if out else np.zeros(0)


def _weights(z, n, alpha, beta, l1, l2):
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def train(rows: DataFrame, text: str = "text", label: str = "label", bits: int = 18, shards: int = 6,
          rounds: int = 3, alpha: float = 0.2, beta: float = 1.0, l1: float = 1.5, l2: float = 1.0,
          order: str = "order") -> Model:
    """Fit on ``rows``: text, label 0/1 and a long that fixes the order within a shard."""
    spark = rows.sparkSession

    data = rows.select(F.col(order).cast("long").alias("order"), F.col(label).cast("double").alias("label"),
                       F.col(text).cast("string").alias("text"))
    data = stored(data.withColumn("shard", F.pmod("order", F.lit(shards)).cast("int")), "toxic-train")
    share = data.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    offset = float(np.log((share["toxic"] or 0) + 1) - np.log(share["n"] - (share["toxic"] or 0) + 1))
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    for _ in range(rounds):
        start = spark.sparkContext.broadcast((z, n))

        def one_shard(part: pd.DataFrame) -> pd.DataFrame:
            z, n = (x.copy() for x in start.value)  # noqa: B023 - used before the next round begins
            part = part.sort_values("order", kind="stable")
            labels, at = part["label"].to_numpy(), 0
            for t in tx.slices(pa.array(part["text"], pa.string())):
                for c in _sets(t, bits):
                    zc, nc = z[c], n[c]
                    w = _weights(zc, nc, alpha, beta, l1, l2)
                    g = 1 / (1 + np.exp(-np.clip(offset + w.sum(), -60, 60))) - labels[at]
                    z[c] = zc + g - (np.sqrt(nc + g * g) - np.sqrt(nc)) / alpha * w
                    n[c] = nc + g * g
                    at += 1
            return pd.DataFrame({"z": [z.tobytes()], "n": [n.tobytes()]})

        # One task per shard: a shuffle by hash would put several into one.
        dealt = data.repartitionByRange(shards, "shard")
        got = dealt.groupBy("shard").applyInPandas(one_shard, "z binary, n binary").toLocalIterator()
        zs, ns, k = np.zeros(1 << bits), np.zeros(1 << bits), 0
        for r in got:
            zs, ns, k = zs + np.frombuffer(r["z"]), ns + np.frombuffer(r["n"]), k + 1
        if not k:
            break
        z, n = zs / k, ns / k
        start.destroy()
    w = _weights(z, n, alpha, beta, l1, l2)
    bias, w[0] = float(w[0]) + offset, 0.0
    coords = np.flatnonzero(w)
    return Model(bits, coords, w[coords], bias)


def label_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic", where: Column | None = None, max_rows: int = 12_000) -> DataFrame:
    """Labelled texts to train on: at most ``max_rows``, the first in hash order of (id, text) among the first ``max_rows``
    ids in hash order. Both are broadcast: they are bounded. Rows that repeat id and text count once."""
    ids = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    if where is not None:
        ids = ids.where(where)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("order"))
    few = rows.select("doc_id", "order").join(F.broadcast(ids), "doc_id").distinct().orderBy("order", "doc_id").limit(max_rows)
    few = stored(few, "toxic-rows")
    return rows.join(F.broadcast(few), ["doc_id", "order"]).dropDuplicates(["doc_id", "order"])


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (double) and ``predicted`` (1 where score >= threshold)."""
    new = [unused(docs, "score"), unused(docs, "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = shared.value.scores(b.column(keep.index(text)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=[*keep, *new])

    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.DoubleType()),
                           T.StructField(new[1], T.IntegerType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are kept for the test: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> Model:
    """Model from the labelled rows that are not held out."""
    return train(label_rows(docs, labels, where=~held_out(F.col("doc_id")), max_rows=max_rows))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns kept."""
    flag = unused(docs, "predicted")
    out = score(docs.withColumn("text", F.col("text").cast("string")), fit_on_labels(docs, labels), threshold=threshold)
    return out.where(F.col(flag) == 0).select(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit_on_labels(docs, labels)
    out = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, threshold=threshold)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
