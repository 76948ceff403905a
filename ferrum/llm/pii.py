"""Personal data: patterns, and a skip-chain conditional random field that finds their other mentions.

Patterns find e-mail addresses, IP addresses, card and phone numbers (``base_spans``). The other mentions of the same
things in a document have no such form: a phone number without its prefix, a card number with a wrong digit, a masked
IP address, the local part of an address. Words with a digit or an ``@`` are the variables of a random field
with the labels none, email, ip, card, phone; words that a pattern covers are observed. Factors:

* a word's shape (runs of digits by length, letters, marks), hashed to ``SHAPES`` values;
* chain: a word and the next one, where one space parts them, have the same label (none is not favoured);
* skip: words of the document that are equal (digits, or the lower-cased word), or similar (last seven or first eight
  digits, first three parts of an IP address, local part of an address), have the same label. Each such group
  is a star around a hub variable, so its factors grow with its words and not with their pairs.

The weights are trained piecewise, each kind of factor for itself, from the patterns' labels in all documents: log odds
with pseudo-counts, summed by Spark. A word without a pattern is unlabelled rather than none, so skip weights come from pairs
of which both have a label; neighbours count in any case. Shape and neighbours alone never outweigh
``none`` (``ALONE``), so a document in which the patterns find nothing stays as it is. Labels are the largest marginals of loopy message passing (damped sums and
products, ``ROUNDS`` rounds) over all documents of a batch at once; words of one label that one space parts are one span.

The texts are scanned once; spans, words and links of each document are written, and both the weights and the
messages read them there. Nothing is shuffled but the counts.

Defined results: offsets are code points, ends exclusive; spans are ordered by start, then kind, then end; pattern spans of
different kinds may overlap, an added span overlaps none of them; a null text counts as empty and has no spans; rows
are documents whatever their doc_id; a word of any length is one variable; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.llm.base import stored

KINDS = ("email", "ip", "card", "phone")
SHAPES = 1024
ROUNDS, DAMPING = 12, 0.3
#: Bounds of the log odds of a label by shape, against none; bounds of the weights of equal labels by kind of factor.
#: A shape and its neighbours together stay below none, so a word is labelled only with a link to others.
ALONE, NEVER = -1.0, -2.5
LEAST, MOST = np.array([0.1, 0.5, 0.5]), np.array([0.45, 4.0, 4.0])
#: Pseudo-counts of pairs that agree and that differ, by kind of factor: chain, equal words, similar words.
AGREE = ((2.0, 1.0), (60.0, 1.0), (60.0, 1.0))

# The patterns. Possessive forms match the same texts in one pass.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ACTIVE = re.compile(r"[0-9@]")
_EDGE = ".,;:!?()[]{}<>\"'*#$%&|=/\\"
_NOT_DIGIT = re.compile(r"[^0-9]+")
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(c) - 9 * (c > "4") for c in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in order of start, then kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            out.append((start, 0, last))
        at = text.find("@", max(at + 1, last))
    for m in ADDRESS.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _shape(word: str) -> int:
    parts = _RUN.sub(lambda m: f"9{min(m.end() - m.start(), 20)}" if m.group()[0].isdigit() else "a", word[:64])
    return zlib.crc32(f"{parts[:24]}:{min(len(word), 64)}".encode()) % SHAPES


def _keys(word: str) -> list[tuple[str, bool]]:
    """(key, exact) by which a word is equal or similar to others."""
    low, out = word.lower(), []
    if len(word) >= 5:
        out.append(("w" + low, True))
    if "@" in word:
        out.append(("l" + low.split("@")[0], False))
        return [k for k in out if len(k[0]) > 5]
    if word.count(".") >= 2:
        out.append(("n" + ".".join(low.split(".")[:3]), False))
        return [k for k in out if len(k[0]) > 5]
    digits = _NOT_DIGIT.sub("", word)
    if len(digits) >= 7 and len(digits) * 2 > len(word):
        out += [("d" + digits, True), ("s" + digits[-7:], False)]
        if len(digits) > 8:
            out.append(("p" + digits[:8], False))
    elif len(word) >= 5:
        out.append(("l" + low, False))
    return out


def words_of(text: str, base: list[tuple[int, int, int]]) -> dict[str, list]:
    """The variables and factors of one text: start, end, label (0 none, else kind + 1), shape and next (whether
    the following variable is the next word) of each word; hubs as (word, hub, exact)."""
    got: dict[str, list] = {c: [] for c in ("start", "end", "label", "shape", "next", "w", "hub", "exact")}
    members: dict[tuple[str, bool], list[int]] = defaultdict(list)
    k = 0  # the first pattern span that may still touch a word; spans are in order of start
    for m in WORD.finditer(text):
        word = m.group()
        if not _ACTIVE.search(word):
            continue
        core = word.strip(_EDGE)
        if not core:
            continue
        start = m.start() + word.index(core)
        end = start + len(core)
        while k < len(base) and base[k][2] <= start:
            k += 1
        label, j = 0, k
        while j < len(base) and base[j][0] < end:
            if base[j][2] > start:
                label = min(label or 9, base[j][1] + 1)
            j += 1
        i = len(got["start"])
        if i and got["end"][-1] <= m.start() and text[got["end"][-1]: start].strip(_EDGE) == " ":
            got["next"][-1] = 1
        for name, value in (("start", start), ("end", end), ("label", label), ("shape", _shape(core)), ("next", 0)):
            got[name].append(value)
        for key in _keys(core):
            members[key].append(i)
    hubs: dict[tuple[int, ...], bool] = {}
    for (_, exact), found in members.items():
        if len(found) > 1:
            hubs[tuple(found)] = hubs.get(tuple(found), False) or exact
    for h, (found, exact) in enumerate(hubs.items()):
        got["w"] += found
        got["hub"] += [h] * len(found)
        got["exact"] += [int(exact)] * len(found)
    return got


_LISTS = ("start", "end", "label", "shape", "next", "w", "hub", "exact")
SCANNED = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<s:int,k:int,e:int>>, " + \
    ", ".join(f"{c}_ array<int>" for c in _LISTS)
_SPAN = pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())])
_NOTHING = hashlib.sha256(b"").hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = pc.fill_null(b.column("text"), "")
        active = pc.match_substring_regex(texts, "[0-9@]").to_numpy(zero_copy_only=False)
        n, prints, spans = np.zeros((4, len(b)), dtype=np.int64), [_NOTHING] * len(b), [[] for _ in range(len(b))]
        lists: dict[str, list] = {c: [[]] * len(b) for c in _LISTS}
        for i in np.flatnonzero(active):
            text = texts[i].as_py()
            base = base_spans(text)
            for name, value in words_of(text, base).items():
                lists[name][i] = value
            for _, k, _ in base:
                n[k, i] += 1
            prints[i] = hashlib.sha256(spelled(base).encode()).hexdigest()
            spans[i] = [{"s": s, "k": k, "e": e} for s, k, e in base]
        columns = [b.column("doc_id"), *[pa.array(x) for x in n], pa.array(prints), pa.array(spans, pa.list_(_SPAN))]
        columns += [pa.array(lists[c], pa.list_(pa.int32())) for c in _LISTS]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCANNED.split(", ")])


def _flat(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and where each row's begin (one entry more)."""
    column = b.column(name + "_")
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def _field(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """labels, shapes, chain edges (first word of each), and star edges (word, hub, exact), over all rows of a batch."""
    label, at = _flat(b, "label")
    shape, follows = _flat(b, "shape")[0], _flat(b, "next")[0]
    word, stars = _flat(b, "w")
    hub, exact = _flat(b, "hub")[0], _flat(b, "exact")[0]
    row = np.repeat(np.arange(len(b)), np.diff(stars))
    # Hubs are numbered within a row; give each a number of its own.
    ends = np.zeros(len(b), dtype=np.int64)
    np.maximum.at(ends, row, hub + 1)
    return label, shape, np.flatnonzero(follows), word + at[row], hub + (np.cumsum(ends) - ends)[row], exact


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels by shape (i = 5 shape + label) and, from 5 SHAPES on, pairs (kind of factor, agree or differ) with a label."""
    total = np.zeros(5 * SHAPES + 6, dtype=np.int64)
    for b in batches:
        label, shape, chain, word, hub, exact = _field(b)
        np.add.at(total, 5 * shape + label, 1)
        for factor, x, y in _linked(label, chain, word, hub, exact):
            some = (x > 0) | (y > 0) if factor == 0 else (x > 0) & (y > 0)
            np.add.at(total, 5 * SHAPES + 2 * factor + (x != y)[some], 1)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["i", "n"])


def _linked(label, chain, word, hub, exact):
    """Labels of linked words by kind of factor: neighbours, and each hub's words in order (a path through the star)."""
    yield 0, label[chain], label[chain + 1]
    order = np.lexsort((word, hub))
    a, b = order[:-1], order[1:]
    same = hub[a] == hub[b]
    for factor, kind in ((1, 1), (2, 0)):
        take = same & (exact[a] == kind)
        yield factor, label[word[a[take]]], label[word[b[take]]]


def weights(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log odds by shape and label, weights of chain, equal and similar words) from the counts of ``_count``."""
    n = counts[: 5 * SHAPES].reshape(SHAPES, 5) + np.array([4.0, 0.25, 0.25, 0.25, 0.25])
    odds = np.clip(np.log(n / n[:, :1]), NEVER, ALONE)
    odds[:, 0] = 0.0
    pairs = counts[5 * SHAPES:].reshape(3, 2) + np.array(AGREE)
    return odds, np.clip(np.log(pairs[:, 0] / pairs[:, 1]), LEAST, MOST)


def marginals(unary: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of a field with log potentials ``unary`` (variables x labels) and factors (a, b) that add ``weight``
    (by factor, or by factor and label) to equal labels: exact on trees after as many rounds as they are deep, loopy otherwise."""
    ends = np.stack([a, b])
    gain = np.expm1(weight if weight.ndim == 2 else weight[:, None])[None]
    sent = np.zeros((2, len(a), unary.shape[1]))  # sent[0]: from a to b
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, b, sent[0])
        np.add.at(total, a, sent[1])
        own = total[ends] - sent[::-1]
        own = np.exp(own - own.max(axis=2, keepdims=True))
        new = np.log(own.sum(axis=2, keepdims=True) + gain * own)
        new -= new.max(axis=2, keepdims=True)
        sent = DAMPING * sent + (1 - DAMPING) * new
    total = unary.copy()
    np.add.at(total, b, sent[0])
    np.add.at(total, a, sent[1])
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True)


def labelled(b: pa.RecordBatch, odds: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """The label of each word of a batch; words under a pattern keep theirs."""
    label, shape, chain, word, hub, exact = _field(b)
    unary = np.where(label[:, None] > 0, np.where(np.arange(5) == label[:, None], 0.0, -50.0), odds[shape])
    unary = np.concatenate([unary, np.zeros((hub.max() + 1 if len(hub) else 0, 5))])
    a, c = np.concatenate([chain, word]), np.concatenate([chain + 1, len(label) + hub])
    weight = np.concatenate([np.full(len(chain), strength[0]), strength[np.where(exact > 0, 1, 2)]])[:, None].repeat(5, axis=1)
    weight[: len(chain), 0] = 0.0
    if not len(label):
        return label
    p = marginals(unary, a, c, weight)[: len(label)]
    best = p.argmax(axis=1)
    return np.where(label > 0, label, np.where(p.max(axis=1) > 0.5, best, 0))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _found(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            odds, strength = shared.value
            best, known = labelled(b, odds, strength), _flat(b, "label")[0]
            (start, at), end, follows = _flat(b, "start"), _flat(b, "end")[0], _flat(b, "next")[0]
            spans, n_added = [], np.zeros(len(b), dtype=np.int64)
            fresh = (best > 0) & (known == 0)
            has = np.add.reduceat(np.append(fresh, 0), at[:-1]) * (np.diff(at) > 0) if len(b) else []
            for i, base in enumerate(b.column("base").to_pylist()):
                out = [(x["s"], x["k"], x["e"]) for x in base]
                if has[i]:
                    last = -2
                    for w in np.flatnonzero(fresh[at[i]: at[i + 1]]) + at[i]:
                        k = int(best[w]) - 1
                        if last == w - 1 and follows[last] and best[last] == best[w]:
                            out[-1] = (out[-1][0], k, int(end[w]))
                        else:
                            out.append((int(start[w]), k, int(end[w])))
                            n_added[i] += 1
                        last = w
                spans.append(spelled(sorted(out)))
            columns = [b.column(c) for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.string()), pa.array(n_added)], [c.split()[0] for c in FOUND.split(", ")])

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts and hash of the pattern spans, all spans, and how many the field added (module docstring)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = stored(d.mapInArrow(_scan, SCANNED), "pii-scanned")
    lists = [f"{c}_" for c in _LISTS]
    counts = scanned.where(F.size("label_") > 0).select(*lists).mapInArrow(_count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
    got = counts.toArrow()  # at most 5 SHAPES + 6 rows
    total = np.zeros(5 * SHAPES + 6, dtype=np.int64)
    total[got.column("i").to_numpy()] = got.column("n").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(weights(total))
    return scanned.mapInArrow(_found(shared), FOUND)
