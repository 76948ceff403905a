"""Suffix-array dedup: repeated strings from merged Burrows-Wheeler transforms.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller doc_id, or the
same document and an earlier start) is removed. Steps:

1. Anchors: each window of ``length`` bytes is keyed by its rarest-hash ``GRAM``-byte string (leftmost
   minimum). Equal windows have the same key at the same place, so only windows under one key can be
   equal. Consecutive windows with one anchor are one run, and its bytes one fragment. Keys seen once
   in the corpus hold nothing repeated; this cuts the work to what may repeat and loses nothing.
2. Equal fragments under a key are one class; its first copy stands for it, every window of the other
   copies starts earlier elsewhere.
3. Classes that share a key are dealt to tasks by key. A task deals its fragments into shards, builds
   the Burrows-Wheeler transform of each shard, and merges the transforms: the interleave of the
   shards starts from their first columns and is refined pass by pass through the maps that the
   transforms give, by counting passes, until it is ordered by the first ``length`` symbols. The blocks of a pass
   share that many symbols of common prefix; blocks left at the end are the repeated intervals. Suffixes
   that stand alone take no part any more. The earliest member of each interval stays, the others are
   repeats.
4. A key with more than ``most`` classes (a short string all over the corpus) is not put into one
   task: its windows are grouped by their 128-bit hashes instead, which is exact too and is combined
   before the shuffle.
5. Runs of repeated windows become byte spans per document, which are cut out of the text.

Defined results: null texts are empty; texts under ``length`` bytes stay whole; bytes are cut without
regard to characters, so a kept text need not be valid UTF-8; repeated rows (same id, same text) are
one document and get the same answer; rows with one id (or none) and different texts are told apart and ordered by a
64-bit hash of the text; rows without an id come first in the order; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrum.llm import text as tx
from ferrum.llm.base import discard, possible, stored

_U = np.uint64
GRAM = 20
#: A place is one long: start (47 bits), number of windows (8 bits), and where its anchor is from the start (8 bits).
_RUN, _AT = 16, 8
#: Bytes of text whose windows are keyed at a time: about 200 bytes of arrays each.
RUN_SLICE = 1 << 18


def _place(start: np.ndarray, n: np.ndarray, anchor: np.ndarray | int = 0) -> np.ndarray:
    return (start << _RUN) | (n << _AT) | anchor


def _tagged(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text: a document is a doc_id (which may be null) and a 64-bit hash of its text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("tag", F.xxhash64("text"))


def _same(other: str = "id_", tag: str = "tag_") -> Column:
    return F.col("doc_id").eqNullSafe(F.col(other)) & (F.col("tag") == F.col(tag))


def _runs(t: tx.Texts, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: text index, key, fragment hash and place."""
    sums = tx.prefix_sums(t.buf)
    n = len(t.buf)
    if n < length:
        return {}
    at = np.arange(n - GRAM + 1)
    gram = tx.range_hash(sums, at, at + GRAM)
    best = (gram & _U(0xFFFFFFFF00000000)) | at.astype(_U)
    span, width = 1, length - GRAM + 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: len(best) - (width - span)], best[width - span:])
    anchor = (best & _U(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(t.offs)
    count = np.maximum(size - length + 1, 0)
    owner = np.repeat(np.arange(len(t)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    where = start + t.offs[owner]
    anchor = anchor[where]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
    runs = np.diff(np.append(first, len(anchor)))
    lo = where[first]
    return {"owner": owner[first], "key": gram[anchor[first]],
            "frag": tx.range_hash(sums, lo, lo + runs + length - 1) ^ tx.mix((anchor[first] - lo).astype(_U)),
            "place": _place(start[first], runs, anchor[first] - lo)}


def runs(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, tag, key, frag, place of every run of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tags = b.column("doc_id"), b.column("tag")
            for t in tx.slices(b.column("text"), RUN_SLICE):
                r = _runs(t, length)
                if r:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(r["owner"] + t.first)), tags.take(pa.array(r["owner"] + t.first)),
                         pa.array(tx.signed(r["key"])), pa.array(tx.signed(r["frag"])), pa.array(r["place"])],
                        names=["doc_id", "tag", "key", "frag", "place"])

    return docs.mapInArrow(run, "doc_id long, tag long, key long, frag long, place long")


def _fragments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """key, doc_id, tag, place, bytes of the wanted runs (key, doc_id, tag, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, wants = b.column("text"), b.column("wanted")
            for i in range(len(b)):  # one text at a time: a batch of long texts has very many fragments
                body = memoryview(texts[i].as_buffer())
                runs_ = wants[i].values
                keys, places = runs_.field("key"), runs_.field("place")
                p = places.to_numpy()
                lo, n = p >> _RUN, (p >> _AT) & 0xFF
                parts = pa.array([bytes(body[x: x + y + length - 1]) for x, y in zip(lo.tolist(), n.tolist(), strict=True)], pa.binary())
                k = len(parts)
                yield pa.RecordBatch.from_arrays([keys, b.column("doc_id").take(pa.array(np.full(k, i))), b.column("tag").take(pa.array(np.full(k, i))),
                                                  places, parts], names=["key", "doc_id", "tag", "place", "bytes"])

    doc = F.struct("doc_id", "tag").alias("doc")  # equal where both ids are null, too
    by_doc = wanted.groupBy(doc).agg(F.collect_set(F.struct("key", "place")).alias("wanted"))
    # Repeated rows are one document: one of them is read.
    one = possible(docs, wanted, "tag").groupBy(doc).agg(F.first("text").alias("text"))
    texts = one.join(by_doc, "doc").select("doc.doc_id", "doc.tag", "text", "wanted")
    return texts.mapInArrow(run, "key long, doc_id long, tag long, place long, bytes binary")


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of one shard: (symbols, positions of the sorted suffixes).

    Symbols are bytes; 255, which UTF-8 never uses, ends each string. String ends come first, in their
    own order, so no two suffixes are equal.
    """
    text = np.frombuffer(b"".join(s + b"\xff" for s in strings), dtype=np.uint8)
    ends = np.flatnonzero(text == 255)
    after = np.arange(1, len(text) + 1)
    after[ends] = -1
    order, _ = _refined(text, after, int(np.diff(np.append(-1, ends)).max()))
    before = text[order - 1]
    before[np.isin(order, np.append(0, ends[:-1] + 1))] = 255
    return before, order


def _successors(symbols: np.ndarray) -> np.ndarray:
    """From a transform alone: for each sorted suffix, the place of the suffix without its first symbol
    (-1 for string ends). The transform sorted stably by symbol is the first column, string ends first."""
    k = int((symbols == 255).sum())
    out = np.full(len(symbols), -1, dtype=np.int64)
    out[k:] = np.argsort(symbols, kind="stable")[: len(symbols) - k]
    return out


def merge(shards: list[tuple[np.ndarray, np.ndarray]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged order and block ids of the shards' suffixes, from their transforms.

    The interleave begins with the first columns, in which suffixes of one symbol stand shard by shard in their shard's
    order, and is refined by counting passes (``_refined``) through the maps that the transforms give: a pass deals the
    suffixes, in the interleaved order of what follows them, into their blocks. Suffixes of one shard never
    change their order, so this merges the sorted shards; nothing is sorted again. Each pass doubles the symbols
    that a block's members have in common, the last one ends at ``length`` exactly; blocks of several members are then the
    repeated intervals. Suffixes that stand alone, as all do that reach a string end, are left out of later passes.

    Returns (item, block): ``item`` indexes the concatenation of the shards' sorted suffixes, ``block``
    is equal for neighbours whose first ``length`` symbols agree.
    """
    base = np.cumsum([0, *(len(s) for s, _ in shards)])
    after = np.concatenate([np.where(x < 0, -1, x + o) for x, o in ((_successors(s), o) for (s, _), o in zip(shards, base, strict=False))])
    order, block = _refined(_first_column(shards), after, length)
    return order, block[order]


def _dealt(block: np.ndarray, blocks: int) -> np.ndarray:
    """A stable counting pass: the items in order of their block (numbers under ``blocks``), 16 bits at a time."""
    turn = np.argsort(block.astype(np.uint16), kind="stable")
    if blocks > 1 << 16:
        turn = turn[np.argsort((block[turn] >> 16).astype(np.uint16), kind="stable")]
    return turn


def _refined(first: np.ndarray, after: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by ``length`` symbols, and the block of each (the place of its first member).

    ``first`` is the first symbol of each suffix and ``after`` the suffix without it, -1 for string ends;
    these come first in the order, each a block of its own. The order begins with counting passes over the first four
    symbols. Suffixes of one block keep the order in which they are given
    until a pass parts them. Nothing is compared: a pass goes through the suffixes in the order of what follows them
    and deals each to the next free place of its block (a counting pass); a block is cut where what follows is in
    different blocks. What follows is as many symbols later as the order has reached.
    """
    total = len(first)
    after = after.astype(np.int32)
    hopped = lambda hop, by: np.where(hop >= 0, by[np.maximum(hop, 0)], np.int32(-1))
    # The first four symbols at once; 0 is a string's end and what would follow it.
    word = np.where(after < 0, 0, first.astype(np.uint32) + 1)
    two = hopped(after, after)
    word = (word << 8) | np.where(after >= 0, word[np.maximum(after, 0)], 0)
    word = (word << 16) | np.where(two >= 0, word[np.maximum(two, 0)], 0)
    reached = min(4, length)
    word = word.astype(np.uint32) >> np.uint32(8 * (4 - reached))
    order = np.argsort(word.astype(np.uint16), kind="stable")
    order = order[np.argsort((word[order] >> 16).astype(np.uint16), kind="stable")].astype(np.int32)
    word = word[order]
    edge = np.ones(total, dtype=bool)
    edge[1:] = (word[1:] != word[:-1]) | (word[1:] & 0xFF == 0)  # string ends are all different
    place, block = np.empty(total, dtype=np.int32), np.empty(total, dtype=np.int32)
    spots = np.arange(total, dtype=np.int32)
    place[order] = spots
    block[order] = np.maximum.accumulate(np.where(edge, spots, 0))
    back, number, mark = np.empty(total, dtype=np.int32), np.empty(total, dtype=np.int32), np.zeros(total, dtype=bool)
    hop, open_ = hopped(two, two), spots
    last = length - (1 << (length.bit_length() - 1))  # the step of the pass that ends at ``length`` exactly
    kept = {k: m for k, m in ((1, after), (2, two)) if last & k}
    while reached < length:
        if last & reached:
            kept[reached] = hop
        to = hop if reached <= length - reached else _compose(kept)
        at = block[order[open_]]
        twin = at[1:] == at[:-1]  # places whose neighbour is in the same block
        open_ = open_[np.append(twin, False) | np.append(False, twin)] if len(open_) else open_
        if not len(open_):
            break
        at = block[order[open_]]
        fresh = np.append(True, at[1:] != at[:-1])
        number[at[fresh]] = np.arange(int(fresh.sum()), dtype=np.int32)
        mine = order[open_]
        next_ = place[to[mine]]
        back[next_] = mine
        mark[next_] = True
        next_ = np.flatnonzero(mark)
        mark[next_] = False
        mine = back[next_]  # in the order of what follows them
        turn = _dealt(number[block[mine]], int(fresh.sum()))
        mine = mine[turn]
        own, then = block[mine], block[to[mine]]
        new = np.append(True, (own[1:] != own[:-1]) | (then[1:] != then[:-1]))
        order[open_], place[mine] = mine, open_
        block[mine] = np.maximum.accumulate(np.where(new, open_, 0))
        reached += min(reached, length - reached)
        if reached < length:
            hop = hopped(hop, hop)
    return order, block


def _compose(steps: dict[int, np.ndarray]) -> np.ndarray:
    """The map to the suffix as many symbols later as all ``steps`` together."""
    out = None
    for hop in steps.values():
        out = hop if out is None else np.where(out >= 0, hop[np.maximum(out, 0)], np.int32(-1))
    return out


def _first_column(shards: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """First symbols of the shards' sorted suffixes: each transform's symbols in order, string ends first."""
    out = []
    for s, _ in shards:
        k = int((s == 255).sum())
        out.append(np.concatenate([np.full(k, 255, dtype=np.uint8), np.sort(s, kind="stable")[: len(s) - k]]))
    return np.concatenate(out)


def repeated_windows(strings: list[bytes], length: int, shards: int = 4) -> list[np.ndarray]:
    """Groups of (string index, offset) whose next ``length`` bytes are equal, two or more each."""
    cut = [x for x in np.array_split(np.arange(len(strings)), min(shards, len(strings))) if len(x)]
    base = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    parts = [transform([strings[i] for i in x]) for x in cut]
    suffix = np.concatenate([order + base[x[0]] for (_, order), x in zip(parts, cut, strict=True)])
    item, block = merge(parts, length)
    size = np.bincount(block)
    live = size[block] > 1
    at = suffix[item[live]]
    which = np.searchsorted(base, at, side="right") - 1
    pairs = np.stack([which, at - base[which]], axis=1)
    return np.split(pairs, np.flatnonzero(np.diff(block[live])) + 1) if len(pairs) else []


def _meeting(part: pd.DataFrame, length: int) -> pd.DataFrame:
    """The fragments that may share a window with another one of their key.

    Equal windows have their anchor at one place, so they agree on what stands around it: of the ``length - GRAM`` other
    bytes half at least are on one side of the anchor. Fragments that agree with no other one on that many bytes left or right
    of the anchor share nothing.
    """
    half = -(-(length - GRAM) // 2)
    buf = np.frombuffer(b"".join(part["bytes"]), dtype=np.uint8)
    size = part["bytes"].str.len().to_numpy()
    hi = np.cumsum(size)
    lo = hi - size
    at = lo + (part["place"].to_numpy(dtype=np.int64) & 0xFF)
    sums, found = tx.prefix_sums(buf), np.zeros(len(part), dtype=bool)
    for a, b in ((at - half, at), (at + GRAM, at + GRAM + half)):
        has = np.flatnonzero((a >= lo) & (b <= hi))
        side = pd.DataFrame({"key": part["key"].to_numpy()[has], "side": tx.range_hash(sums, a[has], b[has])})
        found[has[side.duplicated(keep=False).to_numpy()]] = True
    return part[found].reset_index(drop=True)


def _later(part: pd.DataFrame, length: int) -> pa.RecordBatch:
    """Places (windows that start earlier elsewhere) among the fragments of some whole keys."""
    part = _meeting(part, length)
    known = part["doc_id"].notna().to_numpy()
    ids, tag = part["doc_id"].fillna(0).to_numpy(dtype=np.int64), part["tag"].to_numpy(dtype=np.int64)
    start = part["place"].to_numpy(dtype=np.int64) >> _RUN
    found = []
    for g in repeated_windows(part["bytes"].tolist(), length):
        who, at = g[:, 0], start[g[:, 0]] + g[:, 1]
        lead = np.lexsort((at, tag[who], ids[who], known[who]))[0]
        one = who[lead]
        same = (known[who] == known[one]) & (ids[who] == ids[one]) & (tag[who] == tag[one]) & (at == at[lead])
        found.append(g[~same])
    got = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    edge = np.flatnonzero(np.append(True, (np.diff(got[:, 0]) != 0) | (np.diff(got[:, 1]) != 1))[: len(got)])
    n = np.diff(np.append(edge, len(got)))
    who, off = got[edge, 0], got[edge, 1]
    return pa.RecordBatch.from_arrays([pa.array(ids[who], mask=~known[who]), pa.array(tag[who]), pa.array(_place(start[who] + off, n))],
                                      ["doc_id", "tag", "place"])


def _merged(frags: DataFrame, length: int, most_bytes: int = 1 << 19) -> DataFrame:
    """Repeats among fragments, key by key: whole keys are put together to about ``most_bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for b in batches:
            whole = b.to_pandas(integer_object_nulls=False, types_mapper=lambda t: pd.Int64Dtype() if t == pa.int64() else None)
            used = whole["bytes"].str.len().cumsum().to_numpy()
            for lo, hi in _cuts(used, most_bytes):
                part = whole.iloc[lo:hi]
                if held and size >= most_bytes and part["key"].iloc[0] != held[-1]["key"].iloc[-1]:
                    yield _later(pd.concat(held, ignore_index=True), length)
                    held, size = [], 0
                held.append(part)
                size += int(part["bytes"].str.len().sum())
                if size >= most_bytes:
                    all_ = pd.concat(held, ignore_index=True)
                    open_ = (all_["key"] == all_["key"].iloc[-1]).to_numpy()
                    if not open_.all():
                        yield _later(all_[~open_].reset_index(drop=True), length)
                        held = [all_[open_]]
                        size = int(held[0]["bytes"].str.len().sum())
                    else:
                        held = [all_]
        if held:
            yield _later(pd.concat(held, ignore_index=True), length)

    rows = frags.select("key", "doc_id", "tag", "place", "bytes").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "doc_id long, tag long, place long")


def _cuts(used: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows of a batch in turns of about ``most`` bytes, from the running sum of their bytes."""
    lo = 0
    while lo < len(used):
        hi = max(lo + 1, int(np.searchsorted(used, (used[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def _by_window(frags: DataFrame, length: int) -> DataFrame:
    """Repeats among the fragments of very frequent keys: windows grouped by their 128-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tags, place = b.column("doc_id"), b.column("tag"), b.column("place").to_numpy()
            for t in tx.slices(b.column("bytes").cast(pa.large_binary()).cast(pa.large_string(), safe=False)):
                n = np.diff(t.offs) - length + 1
                who = np.repeat(np.arange(len(t)), n)
                off = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
                lo = t.offs[who] + off
                sums, other = tx.prefix_sums(t.buf), tx.prefix_sums(t.buf ^ np.uint8(0x55))
                p, row = place[t.first + who], pa.array(t.first + who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(tx.range_hash(sums, lo, lo + length))), pa.array(tx.signed(tx.range_hash(other, lo, lo + length))),
                     ids.take(row), tags.take(row), pa.array(_place((p >> _RUN) + off, np.ones(len(p), np.int64)))],
                    names=["a", "b", "doc_id", "tag", "place"])

    w = frags.select("doc_id", "tag", "place", "bytes").mapInArrow(run, "a long, b long, doc_id long, tag long, place long")
    w = stored(w, "bwt-windows")
    first = w.groupBy("a", "b").agg(F.min(F.struct("doc_id", "tag", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return w.join(first, ["a", "b"]).where(~(_same("first.doc_id", "first.tag") & (F.col("place") == F.col("first.place")))).select("doc_id", "tag", "place")


def repeats(docs: DataFrame, length: int = 100, most: int = 4096) -> DataFrame:
    """(doc_id, tag, place) of runs of windows of ``docs`` (doc_id, tag, text) that start earlier elsewhere, written."""
    all_runs = stored(runs(docs, length), "bwt-runs")
    # written first, so that the join has exchanges of its own and a hot key can be split
    again = stored(all_runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "bwt-keys")
    keys, again = again, stored(all_runs.join(again, "key", "left_semi"), "bwt-again")
    discard(all_runs)  # the largest intermediate; what follows needs the repeated keys only
    discard(keys)
    place = F.struct("doc_id", "tag", "place")
    classes = stored(again.groupBy("key", "frag").agg(F.min(place).alias("first"), F.count("*").alias("n")), "bwt-classes")
    copies = again.join(classes.where("n > 1").select("key", "frag", "first"), ["key", "frag"]).where(
        ~(_same("first.doc_id", "first.tag") & (F.col("place") == F.col("first.place")))).select("doc_id", "tag", "place")
    copies = stored(copies, "bwt-copies")
    discard(again)
    shared = classes.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1")
    firsts = stored(classes.join(shared, "key").select("key", "first.doc_id", "first.tag", "first.place", "classes"), "bwt-firsts")
    discard(classes)
    frags = _fragments(docs, firsts, length)
    often = firsts.where(F.col("classes") > most).select("key").distinct()
    frags = stored(frags.join(often.withColumn("often", F.lit(True)), "key", "left"), "bwt-fragments")
    discard(firsts)
    found = stored(_merged(frags.where("often IS NULL"), length).unionByName(_by_window(frags.where("often"), length)), "bwt-found")
    discard(frags)
    return copies.unionByName(found)


def _cut(body: bytes, places: list[int], length: int) -> tuple[int, int, bytes]:
    """(bytes removed, maximal spans, what is left) of one text."""
    spans: list[list[int]] = []
    for lo, hi in sorted({(p >> _RUN, (p >> _RUN) + ((p >> _AT) & 0xFF) + length - 1) for p in places}):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    left, at = [], 0
    for lo, hi in spans:
        left.append(body[at:lo])
        at = hi
    return sum(hi - lo for lo, hi in spans), len(spans), b"".join([*left, body[at:]])


def dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row of ``docs`` (doc_id, text)."""
    docs = _tagged(docs)
    spans = repeats(docs, length).groupBy("doc_id", "tag").agg(F.collect_set("place").alias("places"))
    spans = stored(spans.withColumnsRenamed({"doc_id": "id_", "tag": "tag_"}), "bwt-spans")
    hit = spans.select(F.col("tag_").alias("tag"))
    joined = possible(docs, hit, "tag").join(spans, _same(), "left").select("doc_id", "text", "places")
    rest = possible(docs, hit, "tag", others=True)
    joined = joined.unionByName(rest.select("doc_id", "text", F.lit(None).cast("array<long>").alias("places")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                got = [_cut(t.buf[t.offs[i]: t.offs[i + 1]].tobytes(), b.column("places")[t.first + i].as_py() or [], length) for i in range(len(t))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(t.first, len(t)), pa.array(np.diff(t.offs)),
                     pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64()),
                     pa.array([x[2] for x in got], pa.binary()),
                     pa.array([hashlib.sha256(x[2]).hexdigest() for x in got])],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
