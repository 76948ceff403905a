"""Line dedup by an exact set-similarity join.

A line is a \\n-split part of a text; its set is its distinct words with A-Z in lower case. Two lines
match at Jaccard >= ``percent`` / 100. Of every matching pair the later line (greater doc_id, or the
same document and a later line) is removed; pairs are judged on the input, not on what is left.

1. Words are counted over all lines in a fixed number of counters (a word's count is at least its true
   one); (count, hash) is one rarity order for all lines.
2. Lines with equal sets are one class (128-bit fingerprint); its first line stands for it, the others
   are later matches.
3. Prefix filter: a line's words in rarity order are posted as far as a match must reach: the first
   ``n - ceil(p n / 100) + 1`` words for the longer line of a pair, ``n - ceil(2 p n / (100 + p)) + 1``
   for the shorter one. A word that occurs once is not posted. Classes meet on a word if their sizes
   allow the similarity (length filter) and enough words are left from there on (positional filter).
   A word of very many classes is dealt to parts, of which every two meet. A pair whose 128-bit maps of words differ in
   more bits than the similarity leaves words to differ is not made.
4. Classes are numbered in the order of the smallest hash in their sets, so similar ones are mostly neighbours; ``BLOCK``
   neighbours are a block. What the words show is written as pairs of blocks, each once, with a bit for each class that
   stands in a pair, so a large group of similar lines gives a row for up to ``BLOCK``**2 pairs.
5. The classes of two blocks are verified on full sets, read back from the texts, and counted; pairs are not written.

Defined results: lines without a word are never matched or removed; a null text has no lines; a
repeated row counts as the same document and gets the same answer as its twin; rows with one id and
different texts are told apart by a hash of the text and ordered by it; rows without an id come first;
extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.llm import text as tx
from ferrum.llm.base import RARITY_BITS, counters, discard, possible, stored

_U = np.uint64
_MASK = _U((1 << RARITY_BITS) - 1)
#: Lines that one sort key tells apart: 64 bits less 19 of the counter and 24 of the hash.
KEY_LINES = 1 << 21
#: Cells of the bit filter of ``_read_sets``, a power of two, whatever the corpus: 512 KB.
CLASS_BITS = 22
#: Classes of one block; a bit of a long each.
BLOCK = 64
#: Postings of one part of a word, so a group of postings that meet has twice as many at most.
PART = 1 << 14
#: Postings that meet in one bucket of words, besides those of a part, and pairs or words that a task compares at once.
HELD = 1 << 17
#: Postings that a task holds before they go to their buckets.
SENT = 1 << 20


def _places(t: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tx.Words]:
    """First byte, end and text of each line, and the line of each word, with the words."""
    w = tx.words(t)
    brk = np.flatnonzero(t.buf == 10)
    lo = np.sort(np.concatenate([t.offs[:-1], brk + 1]))
    text_of = np.repeat(np.arange(len(t)), np.diff(np.searchsorted(brk, t.offs)) + 1)
    hi = np.append(lo[1:], len(t.buf))
    last = np.append(text_of[1:] != text_of[:-1], True)
    hi = np.where(last, t.offs[text_of + 1], hi - 1)
    line = np.searchsorted(lo, w.starts, side="right") - 1
    return lo, hi, text_of, line, w


def _lines(t: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text of each line, and (line, hash) of each word in line order."""
    lo, hi, text_of, line, w = _places(t)
    return lo, hi, text_of, line, tx.word_hashes(t, w, lowered=True)


def _sorted_sets(line: np.ndarray, h: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, hash and counter value of the distinct words of each line, rarest first. ``line`` ascends; the
    key has room for ``KEY_LINES`` of them, so more lines are sorted in runs, which no set crosses."""
    if len(line) and line[-1] - line[0] >= KEY_LINES:
        cut = np.searchsorted(line, np.append(np.arange(line[0], line[-1] + 1, KEY_LINES), line[-1] + 1)).tolist()
        runs = [_sorted_sets(line[a:b], h[a:b], often) for a, b in zip(cut, cut[1:], strict=False)]
        return tuple(np.concatenate(x) for x in zip(*runs, strict=True))
    n = often[(h & _MASK).astype(np.int64)]
    rank = np.minimum(n, (1 << 19) - 1).astype(_U)
    key = ((line - line[:1]).astype(_U) << _U(43)) | (rank << _U(24)) | (h >> _U(40))
    order = np.argsort(key)
    k, l, x, n = key[order], line[order], h[order], n[order]
    tie = np.flatnonzero((k[1:] == k[:-1]) & (x[1:] != x[:-1]))
    if len(tie):  # different words with one key: order them by the whole hash
        order = np.lexsort((x, k))
        l, x, n = l[order], x[order], n[order]
    new = np.ones(len(l), dtype=bool)
    new[1:] = (l[1:] != l[:-1]) | (x[1:] != x[:-1])
    return l[new], x[new], n[new]


def _packed(bucket: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """A row for each bucket, with what it has of the columns as arrays."""
    by = np.argsort(bucket, kind="stable")
    start = np.flatnonzero(np.append(np.ones(min(len(by), 1), bool), np.diff(bucket[by]) != 0))
    cut = pa.array(np.append(start, len(by)).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(bucket[by][start].astype(np.int32)), *(pa.ListArray.from_arrays(cut, pa.array(c[by])) for c in columns)],
                                      names=["bucket", *names])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of each bucket of ``_packed`` rows that are in the order of the buckets."""
    held, now = [], None
    for b in batches:
        bucket = b.column("bucket").to_numpy()
        cut = (np.flatnonzero(np.diff(bucket)) + 1).tolist()
        for lo, hi in zip([0, *cut], [*cut, len(b)], strict=True):
            if lo == hi:
                continue
            if held and bucket[lo] != now:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            now = bucket[lo]
            held.append([c.slice(lo, hi - lo).flatten().to_numpy() for c in b.columns[1:]])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _summed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Each value of the first column once, with the sums of the others."""
    one, where = np.unique(columns[0], return_inverse=True)
    return [one, *(np.bincount(where, weights=c, minlength=len(one)).astype(np.int64) for c in columns[1:])]


def _sums(packed: DataFrame, schema: str) -> DataFrame:
    """Each key of ``_packed`` rows (bucket, array of keys, arrays of numbers below 2**53) once, with its sums."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(c)], names=names)

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words over all texts, in 2**RARITY_BITS counters."""
    size = 1 << RARITY_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            for t in tx.slices(b.column("text")):
                total += np.bincount((tx.word_hashes(t, tx.words(t), lowered=True) & _MASK).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        yield _packed(at >> 12, [at, total[at]], ["i", "n"])

    counts = _sums(docs.select("text").mapInArrow(run, "bucket int, i array<long>, n array<long>"), "i long, n long")
    return np.minimum(counters(counts, size), 2**31 - 1).astype(np.int32)


PLACE = "struct<doc_id:long,tag:long,line:int>"


def _posted(docs: DataFrame, often: np.ndarray, percent: int) -> DataFrame:
    """The classes of each slice of texts: smallest hash m, fingerprint (a, b), print of a line with its repeated words (raw), map of
    words (p, q), n, the posted words (items), the first of them at ``at`` of the set's order, and the places of the lines."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                lo, _, text_of, line, h = _lines(t)
                if not len(h):
                    continue
                l, x, n = _sorted_sets(line, h, shared.value)
                start = np.flatnonzero(np.concatenate([[True], l[1:] != l[:-1]]))
                size = np.diff(np.append(start, len(l)))
                here = l[start]
                prints = [c.to_numpy() for c in _prints(x, start)]
                by = np.lexsort(prints[::-1])
                new = np.append(True, (np.diff(prints[0][by]) != 0) | (np.diff(prints[1][by]) != 0))
                one = by[new]  # a line of each class
                raw = pa.StructArray.from_arrays([c.take(pa.array(one)) for c in _prints(h, np.flatnonzero(np.append(True, line[1:] != line[:-1])))], names=["a", "b"])
                alone = np.add.reduceat(n == 1, start)[one]  # words that occur once come first
                posted = np.maximum(size[one] + (-percent * size[one] // 100) + 1 - alone, 0)
                cut = np.concatenate([[0], np.cumsum(posted)])
                at = np.arange(cut[-1]) + np.repeat(start[one] + alone - cut[:-1], posted)
                owner = pa.array(text_of[here][by] + t.first)
                first_line = np.searchsorted(text_of, text_of[here])
                places = pa.StructArray.from_arrays([b.column("doc_id").take(owner), b.column("tag").take(owner), pa.array((here - first_line)[by].astype(np.int32))],
                                                    names=["doc_id", "tag", "line"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tx.signed(np.minimum.reduceat(tx.mix(x + _U(9)), start)[one])), *(pa.array(c[one]) for c in prints), raw, *(c.take(pa.array(one)) for c in _maps(x, start)),
                     pa.array(size[one].astype(np.int32)), pa.array(alone.astype(np.int32)), pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(tx.signed(x[at]))),
                     pa.ListArray.from_arrays(np.append(np.flatnonzero(new), len(by)).astype(np.int32), places)],
                    names=["m", "a", "b", "raw", "p", "q", "n", "at", "items", "places"])

    return docs.mapInArrow(run, f"m long, a long, b long, raw struct<a:long,b:long>, p long, q long, n int, at int, items array<long>, places array<{PLACE}>")


def _parts(classes: DataFrame, often: np.ndarray) -> tuple[np.ndarray, int]:
    """Into how many parts the postings of a counter's words are dealt, ``PART`` postings a part, and the number of buckets for all."""
    size = 1 << RARITY_BITS
    shared = classes.sparkSession.sparkContext.broadcast(often > PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, dtype=np.int64)
        for b in batches:
            cell = (b.column("items").flatten().to_numpy().view(_U) & _MASK).astype(np.int64)
            total[:size] += np.bincount(cell[shared.value[cell]], minlength=size)
            total[size] += len(cell)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "n"])

    counts = classes.select("items").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).where(f"n > {PART} OR i = {size}")
    counts = counters(counts, size + 1)
    return np.maximum(-(-counts[:size] // PART), 1).astype(np.int32), max(1, -(-int(counts[size]) // HELD))


def _postings(classes: DataFrame, parts: np.ndarray, buckets: int) -> DataFrame:
    """Arrays key, side, cls, n, at, p, q with an entry for each posted word of a class, by bucket of keys. A key is a word, or two
    parts of it; in that of two different parts only classes of different sides meet."""
    shared = classes.sparkSession.sparkContext.broadcast(parts)

    def dealt(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        post = [np.concatenate(c) for c in zip(*held, strict=True)]
        bucket = (post[0] >> _U(32)) % _U(buckets)
        post[0] = tx.signed(post[0])
        return _packed(bucket, post, ["key", "side", "cls", "n", "at", "p", "q"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for b in batches:
            words = b.column("items").flatten().to_numpy().view(_U)
            k = pc.list_value_length(b.column("items")).to_numpy()
            owner = np.repeat(np.arange(len(b)), k)
            cls, n, at, p, q = (b.column(c).to_numpy() for c in ("id", "n", "at", "p", "q"))
            at = at[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k)
            of = shared.value[(words & _MASK).astype(np.int64)]
            post = np.repeat(np.arange(len(words)), of)
            other = np.arange(len(post)) - np.repeat(np.cumsum(of) - of, of)
            own = (tx.mix(cls.view(_U))[owner[post]] % of[post].astype(_U)).astype(np.int64)
            both = (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(_U)
            key = np.where(of[post] > 1, tx.mix(words[post] ^ tx.mix(both + _U(1))), words[post])
            owner = owner[post]
            held.append([key, np.sign(own - other).astype(np.int8), cls[owner], n[owner], at[post].astype(np.int32), p[owner], q[owner]])
            many += len(post)
            if many >= SENT:
                yield dealt(held)
                held, many = [], 0
        if many:
            yield dealt(held)

    return classes.select("id", "n", "at", "p", "q", "items").mapInArrow(
        run, "bucket int, key array<long>, side array<byte>, cls array<long>, n array<int>, at array<int>, p array<long>, q array<long>")


def _once(x: np.ndarray, y: np.ndarray, mx: np.ndarray, my: np.ndarray) -> list[np.ndarray]:
    """Each pair of blocks (x, y) once, with the classes of either that some row has."""
    by = np.lexsort((y, x))
    x, y = x[by], y[by]
    start = np.flatnonzero(np.append(np.ones(min(len(x), 1), bool), (np.diff(x) != 0) | (np.diff(y) != 0)))
    if not len(start):
        return [x, y, mx, my]
    return [x[start], y[start], np.bitwise_or.reduceat(mx[by], start), np.bitwise_or.reduceat(my[by], start)]


def _blocked(c: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """(x, y, mx, my) of pairs of classes: each pair of blocks x <= y once, and the classes of either that stand in a pair."""
    lo, hi = np.minimum(c, d), np.maximum(c, d)
    x, y, mx, my = lo // BLOCK, hi // BLOCK, np.int64(1) << lo % BLOCK, np.int64(1) << hi % BLOCK
    return _once(x, y, np.where(x == y, mx | my, mx), np.where(x == y, mx | my, my))


def _alike(p: np.ndarray, q: np.ndarray, n: np.ndarray, c: np.ndarray, d: np.ndarray, percent: int) -> np.ndarray:
    """Whether the maps of words of the sets at c and d leave them the similarity: a bit in which they differ is a word that one has alone."""
    differ = np.bitwise_count((p[c] ^ p[d]).view(_U)).astype(np.int64) + np.bitwise_count((q[c] ^ q[d]).view(_U))
    return (100 + percent) * (n[c] + n[d] - differ) >= 2 * percent * (n[c] + n[d])


def _meet(post: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of classes that meet on a key and pass length filter, positional filter and that of the maps of words."""
    key, side, cls, n, at, p, q = post
    by = np.lexsort((n, key))
    key, side, cls, n, at, p, q = (c[by] for c in (key, side, cls, n.astype(np.int64), at.astype(np.int64), p, q))
    start = np.flatnonzero(np.append(True, np.diff(key) != 0))
    end = np.repeat(np.append(start[1:], len(key)), np.diff(np.append(start, len(key))))
    y = np.flatnonzero(at < n + (-2 * percent * n // (100 + percent)) + 1)  # the shorter line of a pair, or either of two
    step = 0
    while len(y):
        step += 1
        y = y[y + step < end[y]]
        y = y[100 * n[y] >= percent * n[y + step]]
        x = y + step
        room = (100 + percent) * np.minimum(n[x] - at[x], n[y] - at[y]) >= percent * (n[x] + n[y])
        c, d = x[room], y[room]
        alike = _alike(p, q, n, c, d, percent) & ((side[c] != side[d]) | (side[c] == 0))
        yield cls[c[alike]], cls[d[alike]]


def _candidates(classes: DataFrame, parts: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """x, y, mx, my: pairs of blocks with the classes that pass prefix, length and positional filter and that of the maps of words."""
    names = ["x", "y", "mx", "my"]

    def sent(got: list[list[np.ndarray]]) -> pa.RecordBatch:
        pairs = _once(*(np.concatenate(c) for c in zip(*got, strict=True)))
        return _packed((tx.mix(pairs[0].view(_U) ^ tx.mix(pairs[1].view(_U))) % _U(buckets)).astype(np.int64), pairs, names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, many = [], 0
        for post in _unpacked(batches):
            for c, d in _meet(post, percent):
                got.append(_blocked(c, d))
                many += len(got[-1][0])
                if many > SENT:
                    yield sent(got)
                    got, many = [], 0
        if many:
            yield sent(got)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in _unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _once(*pairs)], names=names)

    post = _postings(classes, parts, buckets).repartition("bucket").sortWithinPartitions("bucket")
    met = post.mapInArrow(meet, "bucket int, " + ", ".join(f"{c} array<long>" for c in names)).repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(once, ", ".join(f"{c} long" for c in names))


def _read_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """a, b, items: full word sets read in a scan of the texts: those of the wanted lines (id, a, b), and a few others. The prints
    (a, b) are of lines with their repeated words, so only the lines that are kept are made sets.

    A bit filter of 2**CLASS_BITS cells keeps most other lines from the shuffle; it is made from the classes that stand in
    a pair. Lines of one print have one set, so one of each slice and then one of all is kept.
    """
    cells = 1 << CLASS_BITS
    cell = wanted.select(F.pmod("a", F.lit(cells)).alias("cell"))
    words = cell.groupBy(F.shiftright("cell", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 AS int))")).alias("n"))
    shared = docs.sparkSession.sparkContext.broadcast(counters(words, cells >> 6))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.zeros(1 << RARITY_BITS, dtype=np.int32)
        for b in batches:
            for t in tx.slices(b.column("text")):
                _, _, _, line, h = _lines(t)
                if not len(h):
                    continue
                start = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
                a, other = (p.to_numpy() for p in _prints(h, start))
                c = a % cells
                hit = np.flatnonzero(shared.value[c >> 6] >> (c & 63) & 1 > 0)
                if not len(hit):
                    continue
                by = hit[np.lexsort((other[hit], a[hit]))]
                one = np.sort(by[np.append(True, (np.diff(a[by]) != 0) | (np.diff(other[by]) != 0))])  # one line of each print
                k = np.diff(np.append(start, len(h)))[one]
                at = np.arange(k.sum()) + np.repeat(start[one] - (np.cumsum(k) - k), k)
                l, x, _ = _sorted_sets(line[at], h[at], flat)
                cut = np.append(np.flatnonzero(np.append(True, l[1:] != l[:-1])), len(l)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(a[one]), pa.array(other[one]), pa.ListArray.from_arrays(cut, pa.array(tx.signed(x)))],
                                                 names=["a", "b", "items"])

    return docs.select("text").mapInArrow(run, "a long, b long, items array<long>")


def _class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """items: the full word sets of the wanted classes (id, a, b), and what else ``wanted`` has of them."""
    sets = _read_sets(docs, wanted)
    return sets.join(wanted, ["a", "b"]).dropDuplicates(["a", "b"]).drop("a", "b")


def _before(i: np.ndarray, j: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Whether row i stands before row j in the order of the keys."""
    less, same = np.zeros(len(i), dtype=bool), np.ones(len(i), dtype=bool)
    for k in keys:
        less |= same & (k[i] < k[j])
        same &= k[i] == k[j]
    return less


def _verified(blocks: DataFrame, buckets: int, percent: int) -> DataFrame:
    """id, links, later: of pairs of blocks with their classes xs and ys (none where both are one block), how many others each
    class matches among them, and how many of these stand earlier."""

    def pairs(row: np.ndarray, x: np.ndarray, n: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j) in the members of the pairs to compare, ``HELD`` words at a time; members of a row stand together, those of xs first."""
        some, ys = np.bincount(row, minlength=rows), np.bincount(row[~x], minlength=rows)
        end = np.cumsum(some)
        at = np.arange(len(row))
        first = np.where(ys[row] > 0, (end - ys)[row], at + 1)
        many = np.where(x, end[row] - first, 0)
        words = np.cumsum(many * n)
        cut = np.searchsorted(words, np.arange(HELD, (words[-1] if len(words) else 0) + HELD, HELD), side="right")
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(row)], strict=True):
            if a < b:
                i = np.repeat(at[a:b], many[a:b])
                yield i, np.arange(len(i)) + np.repeat(first[a:b] - (np.cumsum(many[a:b]) - many[a:b]), many[a:b])

    def compared(part: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
        k = [pc.list_value_length(part.column(c)).to_numpy() for c in ("xs", "ys")]
        row = np.concatenate([np.repeat(np.arange(len(part)), c) for c in k])
        x = np.arange(len(row)) < k[0].sum()
        by = np.argsort(row, kind="stable")  # members of xs, then of ys, row by row
        member = pa.concat_arrays([part.column(c).flatten() for c in ("xs", "ys")]).take(pa.array(by))
        row, x = row[by], x[by]
        ids = member.field("id").to_numpy()
        n = pc.list_value_length(member.field("items")).to_numpy().astype(np.int64)
        words, code = np.unique(member.field("items").flatten().to_numpy(), return_inverse=True)
        begin = np.cumsum(n) - n
        p, q = (m.to_numpy() for m in _maps(words[code].view(_U), begin))
        table = np.sort(np.repeat(np.arange(len(n)), n) * len(words) + code)
        place = member.field("first")
        doc = place.field("doc_id")
        keys = [pc.is_valid(doc).to_numpy(zero_copy_only=False), pc.fill_null(doc, 0).to_numpy(), place.field("tag").to_numpy(), place.field("line").to_numpy()]
        for i, j in pairs(row, x, n, len(part)):
            fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[fits], j[fits]
            alike = _alike(p, q, n, i, j, percent)
            i, j = i[alike], j[alike]
            size = n[i]
            pair = np.repeat(np.arange(len(i)), size)
            word = code[np.arange(len(pair)) + np.repeat(begin[i] - (np.cumsum(size) - size), size)]
            want = j[pair] * len(words) + word
            spot = np.minimum(np.searchsorted(table, want), max(len(table) - 1, 0))
            shared = np.bincount(pair[table[spot] == want], minlength=len(i))
            good = 100 * shared >= percent * (n[i] + n[j] - shared)
            i, j = i[good], j[good]
            earlier = _before(i, j, keys)
            yield _summed([np.concatenate([ids[i], ids[j]]), np.ones(2 * len(i), np.int64), np.concatenate([~earlier, earlier])])

    def sent(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        got = _summed([np.concatenate(c) for c in zip(*found, strict=True)])
        return _packed((tx.mix(got[0].view(_U)) % _U(buckets)).astype(np.int64), got, ["id", "links", "later"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, many = [], 0
        for b in batches:
            step = max(1, len(b) * 2 * HELD * 8 // max(1, b.nbytes))  # rows of about 2 * HELD words
            for a in range(0, len(b), step):
                for got in compared(pa.RecordBatch.from_arrays([c.take(pa.array(np.arange(a, min(a + step, len(b))))) for c in b.columns], names=b.schema.names)):
                    found.append(got)
                    many += len(got[0])
                    if many > SENT:
                        yield sent(found)
                        found, many = [], 0
        if many:
            yield sent(found)

    return _sums(blocks.mapInArrow(run, "bucket int, id array<long>, links array<long>, later array<long>"), "id long, links long, later long")


def _prints(x: np.ndarray, start: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128-bit prints of word sets, given as consecutive words and where each set begins."""
    return (pa.array(tx.signed(np.add.reduceat(tx.mix(x + _U(5)), start))),
            pa.array(tx.signed(np.add.reduceat(tx.mix(x ^ _U(0x5851F42D4C957F2D)), start))))


def _maps(x: np.ndarray, start: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128-bit maps of word sets: a word sets the bit that its hash names."""
    bit = x >> _U(57)
    one = _U(1) << (bit & _U(63))
    return tuple(pa.array(tx.signed(np.bitwise_or.reduceat(np.where(half, one, _U(0)), start))) for half in (bit < 64, bit >= 64))


def later_lines(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(removed, links) of ``docs`` (doc_id, tag, text): (doc_id, tag, line) of later matches, and (doc_id, tag, line, links) of
    the first lines of classes with the number of other classes they match."""
    often = word_counts(docs)
    lines = stored(_posted(docs, often, percent), "line-posted")
    # All lines of a class have one set and so one posting: any of them speaks for it.
    firsts = lines.repartition("m").groupBy("m", "a", "b").agg(
        F.min(F.array_min("places")).alias("first"), F.sum(F.size("places")).alias("copies"), *[F.first(c).alias(c) for c in ("raw", "p", "q", "n", "at", "items")])
    firsts = stored(firsts.sortWithinPartitions("m", "a", "b").withColumn("id", F.monotonically_increasing_id()), "line-classes")
    again = lines.select("a", "b", "places").join(firsts.where("copies > 1").select("a", "b", "first"), ["a", "b"]).select(
        F.explode("places").alias("at"), "first").where("NOT (at.doc_id <=> first.doc_id AND at.tag = first.tag AND at.line = first.line)")
    again = stored(again.select("at.doc_id", "at.tag", "at.line"), "line-again")
    discard(lines)
    parts, buckets = _parts(firsts, often)
    pairs = stored(_candidates(firsts, parts, buckets, percent), "line-pairs")
    block = F.expr(f"id div {BLOCK}")
    inside = f"shiftright({{}}, cast({{}} % {BLOCK} AS int)) & 1 = 1"
    alive = pairs.selectExpr("x AS block", "mx AS mask").union(pairs.select("y", "my")).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    ends = firsts.select("id", "raw.a", "raw.b", "first", block.alias("block")).join(alive, "block").where(inside.format("mask", "id"))
    ends = stored(ends.select("id", "a", "b", "first"), "line-ends")
    discard(firsts)
    sets = _class_sets(docs, ends).groupBy(block.alias("block")).agg(F.collect_list(F.struct("id", "first", "items")).alias("own"))
    sets = stored(sets, "line-sets")
    some = lambda mask: F.expr(f"filter(own, m -> {inside.format(mask, 'm.id')})")
    met = pairs.join(sets.withColumnRenamed("block", "y"), "y").select(
        "x", "mx", F.when(F.col("x") < F.col("y"), some("my")).otherwise(F.slice("own", 1, 0)).alias("ys"))
    met = met.join(sets.withColumnRenamed("block", "x"), "x").select(some("mx").alias("xs"), "ys")
    found = _verified(met, buckets, percent).join(ends.select("id", F.col("first").alias("f")), "id")
    found = stored(found.select("f", "links", "later"), "line-found")
    for df in (pairs, sets, ends):
        discard(df)
    removed = stored(again.union(found.where("later > 0").select("f.doc_id", "f.tag", "f.line")), "line-removed")
    discard(again)
    return removed, found.select("f.doc_id", "f.tag", "f.line", "links")


def dedup(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_lines, n_removed, n_links, kept text and its sha256 of every row of ``docs`` (doc_id, text).

    ``n_lines`` counts lines with a word; ``n_links`` the matches between the document's first lines of
    classes and other classes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("tag", F.xxhash64(F.coalesce("text", F.lit(""))))
    removed, links = later_lines(docs, percent)
    marks = removed.select("doc_id", "tag", F.struct("line", F.lit(0).cast("long").alias("links"), F.lit(True).alias("cut")).alias("m")).union(
        links.select("doc_id", "tag", F.struct("line", "links", F.lit(False).alias("cut")).alias("m")))
    marks = marks.groupBy("doc_id", "tag").agg(F.collect_set("m").alias("marks"))
    marks = stored(marks.withColumnsRenamed({"doc_id": "id_", "tag": "tag_"}), "line-marks")
    # Texts without a mark stay out of the shuffle; they are told and finished in one Python worker.
    hit = marks.select(F.col("tag_").alias("tag"))
    joined = possible(docs, hit, "tag").join(
        marks, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("tag") == F.col("tag_")), "left").select("doc_id", "text", "marks")
    none = F.lit(None).cast(joined.schema["marks"].dataType).alias("marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tx.slices(b.column("text")):
                lo, hi, text_of, line, _ = _places(t)
                full = np.bincount(line, minlength=len(lo)) > 0
                base = np.searchsorted(text_of, np.arange(len(t) + 1))
                out = []
                for i in range(len(t)):
                    own = b.column("marks")[t.first + i].as_py() or []
                    cut = {m["line"] for m in own if m["cut"]}
                    rows = range(base[i], base[i + 1])
                    kept = b"\n".join(t.buf[lo[k]: hi[k]].tobytes() for k in rows if k - base[i] not in cut) if cut else (
                        t.buf[t.offs[i]: t.offs[i + 1]].tobytes())
                    out.append((int(full[base[i]: base[i + 1]].sum()), len(cut), sum(m["links"] for m in own), kept,
                                hashlib.sha256(kept).hexdigest()))
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(t.first, len(t)), *(pa.array(x, pa.int64()) for x in c[:3]), pa.array(c[3], pa.binary()).cast(pa.string()),
                     pa.array(c[4])], names=["doc_id", "n_lines", "n_removed", "n_links", "kept", "kept_sha256"])

    schema = "doc_id long, n_lines long, n_removed long, n_links long, kept string, kept_sha256 string"
    return joined.mapInArrow(run, schema).union(
        possible(docs.select("doc_id", "text", "tag", none), hit, "tag", others=True, then=run, schema=schema))
