"""Source divergence audit: how far each source's use of terms is from the other sources and from its language.

Terms are counted under 64-bit digests; text is joined back late, for the few rows that show it.

1. A scan of the texts emits (lang, digest, documents), combined per batch of rows; the sums tell which
   digests reach ``least_docs`` documents of a language. Two terms under one digest only add up, so no
   kept term is missed.
2. A second scan keeps the words whose digest may be kept (a bit filter of 2**FILTER_BITS cells, whatever
   the corpus) and writes (lang, source, digest, documents, occurrences, term), combined per batch.
3. Counting shuffles digests only. Of each digest the smallest and the largest term are taken (combined
   before their shuffle): where they differ, terms have collided, and that digest's rows are counted
   again under the terms themselves (column ``part``, which is empty everywhere else).
4. Shares, divergences and ranks are made from these counts; the term's text is joined to at most the
   best ``top`` rows (and their ties) of a group and block.

The sum of a pair of sources runs over all kept terms, most of which neither may have. A task gets a block of
terms for two tiles of sources (``TILE`` sources each), so it holds a small dense matrix however many
sources and terms there are; a term that neither source has adds the constant of its two zero shares,
which is added for all terms at the end.

Defined results: a null text, lang or source counts as empty; every row is a document, repeated rows and
rows that share a doc_id too; a group without any kept term has shares too (of count 0), and value 0 where
its language keeps no term; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrum.llm.base import discard, stored
from ferrum.llm.text import Texts, signed, slices, word_hashes, words

FILTER_BITS = 23
SLICE = 2 << 20
ROWS = 1 << 17
#: Rows of slices that are held until they are added up, however long a batch's texts are.
HELD = 1 << 19
TILE = 32
BLOCK_TERMS = 4096
BLOCKS = 64
SCALE = 1_000_000_000

# Bytes of terms: A-Z as a-z, a-z, and all bytes of characters beyond ASCII; the others part terms.
_TERM = np.full(256, 0x20, dtype=np.uint8)
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


def _groups(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, pa.Table]:
    """The group of each row by its values of ``names``, and those values per group."""
    frame = pd.DataFrame({n: batch.column(n).to_pandas() for n in names})
    code = frame.groupby(names, sort=False).ngroup().to_numpy()
    first = np.unique(code, return_index=True)[1]
    return code, pa.Table.from_pandas(frame.iloc[first], preserve_index=False)


def _texts_of(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte ranges of a buffer as strings."""
    size = ends - starts
    offs = np.concatenate([[0], np.cumsum(size)])
    kind = np.int32 if len(lower) < 1 << 31 else np.int64
    at = np.arange(offs[-1], dtype=kind) - np.repeat((offs[:-1] - starts).astype(kind), size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(lower[at]))


def _counter(names: list[str], bits: int, shared=None):
    """Arrow batches of documents -> per batch, group of ``names`` and digest: documents, and with ``shared``
    (words of the bit filter) occurrences and the term, for the digests that pass the filter. Counts are made by
    slice, then added up over the batch's slices."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, values = _groups(batch, names)
            parts: list[list] = []  # by slice: digest, group, documents, occurrences, place of its term; and the terms
            terms: list[pa.Array] = []
            for raw in slices(batch.column("text"), SLICE):
                t = Texts(raw.first, _TERM[raw.buf], raw.offs)
                w = words(t)
                digest, owner = word_hashes(t, w) & mask, w.owner()
                here = np.arange(len(digest))
                if shared is not None:
                    cell = digest & np.uint64((1 << FILTER_BITS) - 1)
                    hit = (shared.value[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1)
                    here = np.flatnonzero(hit)
                if not len(here):
                    continue
                digest, owner = digest[here], owner[here]
                group = code[t.first: t.first + len(t)]
                found = pa.array(digest).dictionary_encode()
                word = found.indices.to_numpy().astype(np.int64)
                if shared is not None:  # a digest of several terms: one row for each of them
                    text = _texts_of(t.buf, w.starts[here], w.ends[here])
                    if len(text.dictionary_encode().dictionary) > len(found.dictionary):
                        yield from _by_text(text, digest, owner, group[owner], values, names)
                        continue
                # One number for a digest and a document, documents in the order of their groups.
                by_group = np.argsort(group, kind="stable")
                place = np.empty(len(t), dtype=np.int64)
                place[by_group] = np.arange(len(t))
                key = word * len(t) + place[owner]
                key.sort()
                new = np.ones(len(key), dtype=bool)
                new[1:] = key[1:] != key[:-1]
                doc = np.flatnonzero(new)
                term, place = np.divmod(key[doc], len(t))
                group = group[by_group[place]]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1])
                at = np.flatnonzero(new)
                term = term[at]
                parts.append([found.dictionary.to_numpy()[term], group[at], np.diff(np.append(at, len(doc))), np.diff(np.append(doc[at], len(key)))])
                if shared is not None:
                    first = np.empty(len(found.dictionary), dtype=np.int64)
                    first[word] = np.arange(len(word))  # any word of the digest
                    terms.append(text.take(pa.array(first[term])))
                del t, w, digest, owner, here, word, place, key, new, doc, found
                if sum(len(x[0]) for x in parts) >= HELD:
                    yield from _added(parts, terms, values, names)
            yield from _added(parts, terms, values, names)

    return run


def _added(parts: list[list], terms: list[pa.Array], values: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The counts of a batch's slices by digest and group; slice by slice where two of them show different terms of a digest."""
    if not parts:
        return
    digest, group, docs, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    text = pa.concat_arrays(terms) if terms else None
    terms.clear()
    found = pa.array(digest).dictionary_encode()
    at = np.arange(len(digest))
    if text is None or len(text.dictionary_encode().dictionary) == len(found.dictionary):
        key = found.indices.to_numpy().astype(np.int64) * len(values) + group
        order = np.argsort(key)
        start = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        at = order[start]
        docs, n = np.add.reduceat(docs[order], start), np.add.reduceat(n[order], start)
    for a in range(0, len(at), ROWS):
        here = pa.array(at[a: a + ROWS])
        columns = [c.combine_chunks() for c in values.take(pa.array(group[at[a: a + ROWS]])).itercolumns()]
        columns += [pa.array(signed(digest[at[a: a + ROWS]])), pa.array(docs[a: a + ROWS])]
        if text is not None:
            columns += [pa.array(n[a: a + ROWS]), text.take(here)]
        yield pa.RecordBatch.from_arrays(columns, [*names, "digest", "docs", "n", "term"][: len(columns)])


def _by_text(text, digest, owner, group, values: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The counts of one slice in which digests have several terms, by term."""
    frame = pd.DataFrame({"digest": signed(digest), "term": text.to_pandas(), "g": group, "owner": owner})
    got = frame.groupby(["g", "digest", "term"], sort=False).agg(docs=("owner", "nunique"), n=("owner", "size")).reset_index()
    columns = [c.combine_chunks() for c in values.take(pa.array(got["g"].to_numpy())).itercolumns()]
    columns += [pa.array(got[c].to_numpy()) for c in ("digest", "docs", "n")]
    columns.append(pa.array(got["term"], type=pa.string()))
    yield pa.RecordBatch.from_arrays(columns, [*names, "digest", "docs", "n", "term"])


def _filter_words(kept: DataFrame) -> np.ndarray:
    """The digests as a bit filter: 2**FILTER_BITS bits in 64-bit words, at most 2**(FILTER_BITS - 6) rows."""
    cell = F.col("digest").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    found = kept.select(F.shiftright(cell, 6).cast("int").alias("i"), cell.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    found = found.groupBy("i").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("w")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[found.column("i").to_numpy()] = found.column("w").to_numpy().view(np.uint64)
    return out


def term_counts(docs: DataFrame, least_docs: int = 10, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(counts, strings). counts: lang, source, digest, part, n, total (of the lang), first (one row per lang
    and term) of the kept terms that a group has; strings: digest, part, term of all digests in sight."""
    spark = docs.sparkSession
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    seen = d.select("lang", "text").mapInArrow(_counter(["lang"], bits), "lang string, digest long, docs long")
    kept = seen.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    shared = spark.sparkContext.broadcast(_filter_words(kept.select("digest")))
    rows = stored(d.mapInArrow(_counter(["lang", "source"], bits, shared),
                               "lang string, source string, digest long, docs long, n long, term string"), "divergence-rows")
    shared.destroy()
    ends = stored(rows.groupBy("digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi")), "divergence-terms")
    split = ends.where("lo <> hi").select("digest")
    strings = ends.where("lo = hi").select("digest", F.lit("").alias("part"), F.col("lo").alias("term"))
    slim = rows.select("lang", "source", "digest", F.lit("").alias("part"), "docs", "n")
    if not split.isEmpty():
        again = rows.join(split, "digest", "left_semi")
        slim = slim.join(split, "digest", "left_anti").unionByName(
            again.select("lang", "source", "digest", F.col("term").alias("part"), "docs", "n"))
        strings = stored(strings.unionByName(again.select("digest", F.col("term").alias("part"), "term").distinct()), "divergence-terms")
    counts = slim.groupBy("lang", "source", "digest", "part").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "digest", "part")
    counts = counts.withColumns({"all_docs": F.sum("docs").over(term), "total": F.sum("n").over(term),
                                 "first": F.row_number().over(term.orderBy("source")) == 1})
    counts = counts.where(F.col("all_docs") >= least_docs).drop("docs", "all_docs")
    counts = stored(counts, "divergence-counts")
    discard(rows)
    return counts, strings


def _share(n: Column, total: str) -> Column:
    """1 + floor(10**9 (n + 2) / (total + 2 V)), exact; 1 where the language keeps no term."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * wide(n + 2)
    part = F.floor(F.call_function("div", top, wide(F.col(total) + 2 * F.col("v"))))
    return F.when(F.col("v") > 0, 1 + part).otherwise(F.lit(1)).cast("long")


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of terms for the sources of one or two tiles: for each pair the sum, over the terms seen here, of
    its divergence less that of two zero shares."""
    zero = pdf[pdf["digest"].isna()].drop_duplicates("source").sort_values("source")
    have = pdf[pdf["digest"].notna()]
    at = pd.Series(np.arange(len(zero)), index=zero["source"])
    term = have.groupby(["digest", "part"], sort=False).ngroup().to_numpy()
    p0 = zero["p"].to_numpy(dtype=np.int64)
    p = np.repeat(p0[:, None], term.max() + 1 if len(term) else 0, axis=1)
    p[at[have["source"]].to_numpy(), term] = have["p"].to_numpy(dtype=np.int64)
    tile, names = zero["tile"].to_numpy(), zero["source"].to_numpy()
    ta, tb = pdf["ta"].iloc[0], pdf["tb"].iloc[0]
    out = []
    for i in np.flatnonzero(tile == ta):
        other = np.flatnonzero(tile == tb)
        other = other[other > i] if ta == tb else other
        if len(other):
            none = (p0[other] - p0[i]) ** 2 // (p0[other] + p0[i])
            f = (p[other] - p[i]) ** 2 // (p[other] + p[i])
            out.append(pd.DataFrame({"a": names[i], "b": names[other], "p_a": p0[i], "p_b": p0[other],
                                     "delta": f.sum(axis=1) - none * p.shape[1]}))
    found = pd.concat(out) if out else pd.DataFrame({c: [] for c in ("a", "b", "p_a", "p_b", "delta")})
    return found.assign(lang=pdf["lang"].iloc[0], v=pdf["v"].iloc[0])[["lang", "a", "b", "p_a", "p_b", "v", "delta"]]


def divergence(docs: DataFrame, least_docs: int = 10, top: int = 10, bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank (module docstring): part ``pair`` holds each other source of the lang by
    the divergence over all kept terms, part ``term`` the ``top`` terms that the source uses more than its lang."""
    counts, strings = term_counts(docs, least_docs, bits)
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    per_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum(F.col("first").cast("long")).alias("v"))
    per_lang = per_group.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.sum("v").alias("v"))
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(per_lang, "lang", "left").fillna(0, ["lang_size", "v"])
    groups = groups.join(per_group.drop("v"), ["lang", "source"], "left").fillna(0, ["size"]).join(per_lang, "lang")
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    blocks = F.greatest(F.ceil(F.col("v") / BLOCK_TERMS), F.lit(1)).cast("int")
    groups = groups.withColumns({"tiles": tiles, "blocks": blocks, "tile": F.pmod(F.xxhash64("source"), tiles).cast("int")})
    groups = stored(groups, "divergence-groups")

    rows = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), "size"))
    zero = groups.withColumn("p", _share(F.lit(0), "size")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    same = ["lang", "source", "digest", "part", "p", "v", "tile", "tiles", "block"]
    cells = rows.withColumn("block", F.pmod("digest", "blocks").cast("int")).select(*same).unionByName(
        zero.withColumns({"digest": F.lit(None).cast("long"), "part": F.lit("")}).select(*same))
    cells = cells.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cells = cells.withColumns({"ta": F.least("tile", "u"), "tb": F.greatest("tile", "u")}).drop("u", "tiles")
    sums = cells.groupBy("lang", "block", "ta", "tb").applyInPandas(
        _pair_sums, "lang string, a string, b string, p_a long, p_b long, v long, delta long")
    sums = sums.groupBy("lang", "a", "b", "p_a", "p_b", "v").agg(F.sum("delta").alias("delta"))
    value = F.col("v") * _divergence(F.col("p_a"), F.col("p_b")) + F.col("delta")
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.explode(both).alias("e"), value.alias("value")).select("lang", "e.source", "e.item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    over = rows.withColumn("q", _share(F.col("total"), "lang_size")).where("p > q")
    over = over.withColumns({"value": _divergence(F.col("p"), F.col("q")), "block": F.pmod("digest", F.lit(BLOCKS))})
    place = Window.partitionBy("lang", "source", "block")
    over = over.withColumn("r", F.rank().over(place.orderBy(F.desc("value")))).where(F.col("r") <= top)
    over = over.select("lang", "source", "digest", "part", "value", "block").join(strings, ["digest", "part"])
    over = over.withColumnRenamed("term", "item").withColumn("r", F.row_number().over(place.orderBy(F.desc("value"), "item")))
    over = over.where(F.col("r") <= top).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.unionByName(over.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 10),
l AS (SELECT lang, count(*) AS v, sum(total) AS size FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY m.lang, source) + 2 * v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (total + 2)) // (size + 2 * v)::HUGEINT AS q FROM m JOIN l USING (lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
z AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM y
      UNION ALL
      SELECT lang, source, 'term', term, f, row_number() OVER (PARTITION BY lang, source ORDER BY f DESC, term) AS rank
      FROM (SELECT *, ((p - q) * (p - q)) // (p + q) AS f FROM s WHERE n > 0 AND p > q) QUALIFY rank <= 10)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM z
"""
