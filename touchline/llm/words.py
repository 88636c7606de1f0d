"""Words of whole texts as numpy arrays: where they start, which document holds them, and their fingerprints.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. In UTF-8
none of these bytes occurs inside another character, so the words are those of `[^\\x20\\x09-\\x0D]+`.

Fingerprints are 64 bits: a polynomial over the bytes of a word, mixed; sequences of words are a polynomial over the
words' fingerprints, mixed. `lane` picks one of several independent fingerprints; two of them make 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    x = np.asarray(x, U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _odd(lane: int, which: int) -> int:
    return int(mix(np.array([1000 * lane + which + 1], U64))[0]) | 1


_TABLES = [mix(np.arange(256, dtype=U64) + U64(257 * (lane + 1))) for lane in range(2)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


@dataclass
class Words:
    """Words in document order. `first[d]` is the place of document d's first word, `first[-1]` the number of words."""

    bytes_: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.bytes_[self.start[i] : self.end[i]].tobytes()

    def fingerprints(self, lane: int = 0) -> np.ndarray:
        return fingerprints_between(self.bytes_, self.start, self.end, lane)


def fingerprints_between(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Fingerprints of the bytes from each start to its end."""
    base, n = _odd(lane, 0), len(data)
    total = np.zeros(n + 1, U64)
    np.cumsum(_TABLES[lane][data] * _powers(base, n), out=total[1:])
    out = (total[end] - total[start]) * _powers(_inverse(base), n + 1)[start]
    return mix(out ^ (end - start).astype(U64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the bounds of each (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    raw = data.buffers()[2]
    if raw is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(data) + 1, np.int64)
    return np.frombuffer(raw, np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, bounds = buffers(texts)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = bounds[:-1]
    before[edges[edges < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    lasts = bounds[1:] - 1
    after[lasts[lasts >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def windows(word: np.ndarray, first: np.ndarray, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all runs of `size` words inside a document, and the place of each one's first word."""
    n = len(word)
    if n < size:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    base = _odd(lane, 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(word * _powers(base, n), out=total[1:])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    at = np.flatnonzero(left >= size)
    return mix((total[at + size] - total[at]) * _powers(_inverse(base), n)[at]), at


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece take about `limit` bytes; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    _, bounds = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Join small batches and cut large ones so that each holds about `limit` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch, column, limit):
            if size and size + piece.nbytes > limit:
                yield _joined(held)
                held, size = [], 0
            held.append(piece)
            size += piece.nbytes
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
