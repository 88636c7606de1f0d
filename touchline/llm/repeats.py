"""Substring deduplication: words of passages that also begin earlier in the corpus go.

Method: prefix-partitioned suffix trees. A suffix begins at each word; what counts of it are its first `length` words,
coded as two symbols, the fingerprints of its two halves. Suffixes are partitioned by prefixes of that code; a group
that is still larger than SUBTREE leaves is split by longer prefixes, so prefixes vary in length and subtrees fit in
memory. A subtree is held as its sorted leaves and the depth at which neighbours part; internal nodes as deep as
`length` words are the repeats, and every leaf of such a node but its earliest begins a repeated passage. Longer repeats
are runs of such leaves.

Before the trees are built, suffixes that can't repeat are left out: equal passages share their least half-length run of
words (their anchor), so only suffixes whose anchor occurs twice in the corpus go on. Within a block of documents equal
suffixes are folded into their earliest, so that frequent passages cost one leaf a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchline.llm import blocks as B
from touchline.llm.words import U64, windows, words_of

#: Leaves of a subtree; larger groups are split by longer prefixes.
SUBTREE = 1 << 20


def sliding(values: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """The least (or greatest) of each `width` neighbours; the result is shorter by width - 1."""
    fold = np.minimum if least else np.maximum
    out, span = values, 1
    while 2 * span <= width:
        out = fold(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return fold(out[: len(out) - rest], out[rest:]) if rest else out


class Suffixes:
    """The suffixes of a block with at least `length` words: where each begins, its two symbols, its anchor."""

    def __init__(self, block: B.Block, length: int):
        half = length // 2
        words = words_of(block.texts)
        self.first, self.length = words.first, length
        n = len(words.start)
        code = np.full(n, np.iinfo(np.uint64).max, U64)
        found, at = windows(words.fingerprints(), words.first, half)
        code[at] = found
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(n)
        self.at = np.flatnonzero(left >= length)
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[self.at]
        self.id, self.start = block.ids[doc], (self.at - self.first[doc]).astype(np.int64)
        self.one, self.two = code[self.at], code[self.at + half]
        if len(self.at):
            self.anchor = sliding(code, half + 1)[self.at]
            # a run is an anchor where a suffix that holds it has no smaller one
            top = np.zeros(n, U64)
            top[self.at] = self.anchor
            highest = sliding(np.concatenate([np.zeros(half, U64), top]), half + 1, least=False)
            self.anchors = code[np.flatnonzero((highest == code) & (highest > 0))]
        else:
            self.anchor = self.anchors = self.one

    def distinct_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending, and whether each occurs more than once here."""
        values, counts = np.unique(self.anchors, return_counts=True)
        return values, counts > 1

    def folded(self, anchor_replies: list[bytes] | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes that may repeat: their places, the fold of each, and the place of each fold's earliest.

        Folds come in ascending order of the symbols.
        """
        values, _ = self.distinct_anchors()
        if not len(values):
            none = np.zeros(0, np.int64)
            return none, none, none
        again = np.zeros(len(values), bool)
        for (_, a, b), bitmap in zip(B.cuts(values, bits), anchor_replies, strict=True):
            again[a:b] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a)
        may = np.flatnonzero(again[np.searchsorted(values, self.anchor)])
        order = may[np.lexsort((self.start[may], self.id[may], self.two[may], self.one[may]))]
        one, two = self.one[order], self.two[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return order, np.cumsum(new) - 1, order[new]


def later_leaves(one: np.ndarray, two: np.ndarray, ids: np.ndarray, starts: np.ndarray, shift: int = 8) -> np.ndarray:
    """Which leaves are below a deep node and not its earliest. Splits by longer prefixes until a subtree fits."""
    out = np.zeros(len(one), bool)
    if len(one) > SUBTREE and shift <= 64:
        prefix = one >> U64(64 - shift) if shift < 64 else one
        order = np.argsort(prefix, kind="stable")
        edges = np.flatnonzero(np.diff(prefix[order])) + 1
        if len(edges) or shift < 64:
            for part in np.split(order, edges):
                out[part] = later_leaves(one[part], two[part], ids[part], starts[part], shift + 8)
            return out
    leaves = np.lexsort((starts, ids, two, one))
    a, b, i, s = one[leaves], two[leaves], ids[leaves], starts[leaves]
    deep = np.zeros(len(leaves), bool)  # parts from the leaf before only below both symbols
    deep[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    node = np.cumsum(~deep) - 1
    earliest = np.flatnonzero(~deep)[node]
    out[leaves] = (i != i[earliest]) | (s != s[earliest])
    return out


def drop_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 20) -> DataFrame:
    """One row per document: id_column, `n_words`, `n_removed` and `kept` (the words that stay, joined by one space).

    A word goes if it is covered by `length` consecutive words of its document that also begin earlier: in a document
    with a smaller id, or earlier in the same one. Passages are judged on the input. Rows with one id count as one
    document, so of passages at the same place in them none is earlier; a null id comes after all others. A null or
    empty text has no words; an empty table gives no row; other columns don't matter. length must be even.
    """
    if length < 2 or length % 2:
        raise ValueError("length must be an even number of words")
    packed = B.pack(docs, id_column, text_column)
    bits = B.group_bits(packed)

    def anchors(block: B.Block) -> Iterator[tuple]:
        values, twice = Suffixes(block, length).distinct_anchors()
        for group, a, b in B.cuts(values, bits):
            yield group, values[a:b].tobytes(), np.packbits(twice[a:b]).tobytes()

    def repeated(keys: list[bytes], twice: list[bytes]) -> list[bytes]:
        arrays = [np.frombuffer(k, U64) for k in keys]
        _, of, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        many = counts[of] > 1
        ends = np.cumsum([len(a) for a in arrays]).tolist()
        return [np.packbits(many[e - len(a) : e] | np.unpackbits(np.frombuffer(t, np.uint8), count=len(a)).astype(bool)).tobytes() for a, e, t in zip(arrays, ends, twice, strict=True)]

    asked = B.answer(B.ask(packed, anchors, ("keys", "twice")), repeated, ("keys", "twice"))
    known = B.back(packed, asked, "anchors")

    def leaves(block: B.Block, replies: list[bytes] | None) -> Iterator[tuple]:
        s = Suffixes(block, length)
        _, _, first = s.folded(replies, bits)
        for group, a, b in B.cuts(s.one[first], bits):
            part = np.sort(first[a:b])  # by place, which makes ids and starts small to send
            yield group, s.one[part].tobytes() + s.two[part].tobytes(), B.packed(np.diff(s.id[part], prepend=0)), B.packed(np.diff(s.start[part], prepend=0))

    def later(symbols: list[bytes], ids: list[bytes], starts: list[bytes]) -> list[bytes]:
        both = [np.frombuffer(x, U64) for x in symbols]
        sizes = [len(x) // 2 for x in both]
        found = later_leaves(
            np.concatenate([x[:n] for x, n in zip(both, sizes, strict=True)]),
            np.concatenate([x[n:] for x, n in zip(both, sizes, strict=True)]),
            np.concatenate([np.cumsum(B.unpacked(i, np.int64)) for i in ids]),
            np.concatenate([np.cumsum(B.unpacked(s, np.int64)) for s in starts]),
        )
        ends = np.cumsum(sizes).tolist()
        return [np.packbits(found[e - n : e]).tobytes() for n, e in zip(sizes, ends, strict=True)]

    trees = B.answer(B.ask(known, leaves, ("symbols", "ids", "starts"), ("anchors",)), later, ("symbols", "ids", "starts"))
    judged = B.back(B.back(packed, asked, "anchors"), trees, "later")
    made = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchor_replies, tree_replies in B.read(batches, "anchors", "later"):
            s = Suffixes(block, length)
            order, fold, first = s.folded(anchor_replies, bits)
            elsewhere = np.zeros(len(s.at), bool)
            for (_, a, b), bitmap in zip(B.cuts(s.one[first], bits), tree_replies or [], strict=True):
                part = np.sort(first[a:b])
                elsewhere[part] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a)
            head = first[fold]
            gone = order[elsewhere[head] | (s.id[order] != s.id[head]) | (s.start[order] != s.start[head])]
            cover = np.zeros(int(s.first[-1]) + length + 1, np.int64)
            np.add.at(cover, s.at[gone], 1)
            np.add.at(cover, s.at[gone] + length, -1)
            stays = np.cumsum(cover)[: int(s.first[-1])] == 0
            total = np.concatenate([[0], np.cumsum(~stays)])
            removed = total[s.first[1:]] - total[s.first[:-1]]
            texts = []
            for d, text in enumerate(block.texts.to_pylist()):
                words = text.split()
                texts.append(b" ".join(compress(words, stays[s.first[d] : s.first[d + 1]].tolist()) if removed[d] else words))
            ids = pa.array(block.ids, mask=block.ids == B.NO_ID)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(s.first)), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string())], names=made.names)

    return judged.select("block", "ids", "bounds", "data", "anchors", "later").mapInArrow(kept, made).withColumnRenamed("id", id_column)
