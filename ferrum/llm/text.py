"""Whole-batch text helpers on Arrow batches: words, hashes and shingles as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. These bytes never occur inside a
multi-byte UTF-8 character, so words are found on the UTF-8 bytes of a whole batch at once. Nulls
count as empty texts. Batches are handled in slices of about ``SLICE_BYTES``; a longer text is a
slice of its own and is always read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = _U(0x9E3779B97F4A7C15)
_ODD_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _ODD)
_LOWER_BYTE = _BYTE[_LOWER]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for slices of the usual size."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        size = max(n, SLICE_BYTES + 1)
        got = np.full(size, base, dtype=_U)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= 4 * SLICE_BYTES:
            _powers[int(base)] = got
    return got[:n]


@dataclass
class Texts:
    """Some texts as one byte buffer. ``offs`` has one entry more than there are texts."""

    first: int
    buf: np.ndarray
    offs: np.ndarray

    def __len__(self) -> int:
        return len(self.offs) - 1


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """Consecutive texts of a string column, about ``most`` bytes at a time."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a, n = 0, len(column)
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, side="right")) - 1)
        b = min(b, n)
        yield Texts(a, data[offs[a]: offs[b]], offs[a: b + 1] - offs[a])
        a = b


@dataclass
class Words:
    """Words of some texts: byte ranges, and where each text's words begin (one entry more)."""

    starts: np.ndarray
    ends: np.ndarray
    offs: np.ndarray

    def owner(self) -> np.ndarray:
        """The index of the text that holds each word."""
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))

    def counts(self) -> np.ndarray:
        return np.diff(self.offs)


def words(t: Texts) -> Words:
    inside = ~_SPACE[t.buf]
    n = len(inside)
    begin, end = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = t.offs[(t.offs > 0) & (t.offs < n)]
        begin[cuts] |= inside[cuts]
        end[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, t.offs))


def lower(t: Texts) -> Texts:
    """A-Z in lower case, other characters as they are."""
    return Texts(t.first, _LOWER[t.buf], t.offs)


def prefix_sums(buf: np.ndarray, lowered: bool = False) -> np.ndarray:
    """Running sums from which ``range_hash`` makes the hash of any byte range in two look-ups; ``lowered``: as if A-Z were in lower case."""
    out = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((_LOWER_BYTE if lowered else _BYTE)[buf] * _power_table(_ODD, len(buf)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes have equal hashes wherever they stand."""
    inv = _power_table(_ODD_INV, len(sums))
    return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(_U))


def word_hashes(t: Texts, w: Words, lowered: bool = False) -> np.ndarray:
    return range_hash(prefix_sums(t.buf, lowered), w.starts, w.ends)


def shingles(h: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words and the offsets by text. A text with fewer words, but
    at least one, has its whole sequence as one shingle."""
    counts = np.diff(offs)
    total = len(h)
    acc = np.zeros(total, dtype=_U)
    owner_end = np.repeat(offs[1:], counts)
    pos = np.arange(total)
    for k in range(width):
        at = np.minimum(pos + k, max(total - 1, 0))
        acc = mix(acc * _U(3) + np.where(pos + k < owner_end, h[at] if total else h, _U(k + 1)))
    keep = pos + width <= owner_end
    keep[offs[:-1][(counts > 0) & (counts < width)]] = True
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    return acc[keep], np.concatenate([[0], np.cumsum(n)])


def per_text_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of consecutive values for each text (0 where a text has none)."""
    sums = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as the longs that Spark has."""
    return np.ascontiguousarray(x, dtype=_U).view(np.int64)
