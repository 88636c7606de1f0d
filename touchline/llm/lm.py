"""Scoring texts with a word language model that is learnt from the same corpus.

Method: a weighted backoff automaton. Its states are the empty context and every word (and the start of a text); a word's
state has an arc for each word that followed it in training, weighted with the smoothed probability, and a failure arc
to the empty context, weighted with what smoothing leaves for all other words. Each text is traversed once from left to
right, carrying the state and adding up log10 probabilities.

Bigrams are smoothed by a Dirichlet prior around the unigrams: p(v|u) = (c(uv) + prior * p(v)) / (c(u) + prior), so the
failure arc weighs prior / (c(u) + prior); unigrams by one more of each: p(v) = (c(v) + 1) / (N + V + 1), which leaves
the last share to unknown words. The automaton is never in one place: a block of documents asks for just the arcs that
its own texts run through, and counts come back from the groups that add them up over the whole corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm import blocks as B
from touchline.llm.words import U64, mix, words_of
from touchline.session import stage

END, START = U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03)
#: Strength of the Dirichlet prior in counts.
PRIOR = 500.0


def held_out(ids: np.ndarray, parts: int = 7, part: int = 2) -> np.ndarray:
    """Whether the CRC-32 of the id as text leaves the remainder `part`; the text of a null id is empty."""
    return np.array([zlib.crc32(b"" if i == B.NO_ID else str(i).encode()) % parts == part for i in ids.tolist()], bool)


class Tokens:
    """The tokens of a block (words, A-Z lowered, then one end for each text) with the keys of their arcs."""

    def __init__(self, block: B.Block):
        words = words_of(block.texts, lower=True)
        n = np.diff(words.first) + 1
        self.bounds = np.concatenate([[0], np.cumsum(n)])
        token = np.full(int(self.bounds[-1]), END, U64)
        is_word = np.ones(len(token), bool)
        is_word[self.bounds[1:] - 1] = False
        token[is_word] = words.fingerprints()
        before = np.roll(token, 1)
        before[self.bounds[:-1]] = START
        self.doc = np.repeat(np.arange(len(n)), n)
        self.single, self.double = mix(token), mix(before * U64(0x2545F4914F6CDD1D) + token ^ START)
        singles, self.of_single = np.unique(self.single, return_inverse=True)
        doubles, self.of_double = np.unique(self.double, return_inverse=True)
        both = np.concatenate([singles, doubles])
        self.order = np.argsort(both, kind="stable")
        self.keys, self.n_singles = both[self.order], len(singles)

    def counts(self, train: np.ndarray) -> np.ndarray:
        """How often each key occurs in training texts, in the order of keys."""
        weight = train[self.doc]
        return np.concatenate([np.bincount(self.of_single[weight], minlength=self.n_singles), np.bincount(self.of_double[weight], minlength=len(self.keys) - self.n_singles)])[self.order]


def traverse(tokens: Tokens, counts: np.ndarray, total: int, known: int, ends: int, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens known, unigram score and automaton score of each text, from the corpus counts of the block's keys."""
    by_key = np.empty(len(counts), np.int64)
    by_key[tokens.order] = counts
    one = by_key[: tokens.n_singles][tokens.of_single]
    pair = by_key[tokens.n_singles :][tokens.of_double]
    state = np.roll(one, 1)  # the state is the word before, and how often it was left in training
    state[tokens.bounds[:-1]] = ends
    root = np.log10((one + 1) / (total + known + 1))
    arc = np.log10((pair + prior * 10**root) / (state + prior))
    failure = np.log10(prior / (state + prior)) + root
    step = np.where(pair > 0, arc, failure)
    add = lambda x: np.add.reduceat(x, tokens.bounds[:-1])
    return add((one > 0).astype(np.int64)), add(root), add(step)


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prior: float = PRIOR) -> DataFrame:
    """One row per text: id_column, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Texts with held_out are not learnt from, all are scored. n_known: tokens that occur in training; train_tokens: all
    of them; base_score: log10 probability by unigrams; score: by the automaton. A null or empty text is one end. Repeated
    rows are each learnt from and scored. An empty table gives no row; other columns don't matter.
    """
    packed = B.pack(docs, id_column, text_column)
    bits = B.group_bits(packed)

    def arcs(block: B.Block) -> Iterator[tuple]:
        tokens = Tokens(block)
        counts, is_single = tokens.counts(~held_out(block.ids)), tokens.order < tokens.n_singles
        for group, a, b in B.cuts(tokens.keys, bits):
            yield group, tokens.keys[a:b].tobytes(), B.packed(counts[a:b].astype(np.uint32)), np.packbits(is_single[a:b]).tobytes()

    def add_up(keys: list[bytes], counts: list[bytes], singles: list[bytes]) -> tuple[list[bytes], tuple[int, int, int]]:
        arrays = [np.frombuffer(k, U64) for k in keys]
        distinct, first, of = np.unique(np.concatenate(arrays), return_index=True, return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, of, np.concatenate([B.unpacked(c, np.uint32) for c in counts]))
        single = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(a)) for s, a in zip(singles, arrays, strict=True)]).astype(bool)[first]
        ends = np.cumsum([len(a) for a in arrays]).tolist()
        replies = [B.packed(totals[of[e - len(a) : e]]) for a, e in zip(arrays, ends, strict=True)]
        end = int(totals[distinct == mix(np.array([END], U64))].sum())
        return replies, (int((totals[single] > 0).sum()), int(totals[single].sum()), end)

    replies = stage(B.answer(B.ask(packed, arcs, ("keys", "counts", "singles")), add_up, ("keys", "counts", "singles"), ("known", "total", "ends")), "counts")
    whole = replies.agg(F.sum("known").alias("known"), F.sum("total").alias("total"), F.sum("ends").alias("ends")).first()
    known, total, ends = (whole[c] or 0 for c in ("known", "total", "ends"))
    kinds = {"id": T.LongType(), "held_out": T.BooleanType(), "n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}
    made = T.StructType([T.StructField(*k) for k in kinds.items()])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, counts in B.read(batches, "counts"):
            tokens = Tokens(block)
            n_known, base, model = traverse(tokens, np.concatenate([B.unpacked(c, np.int64) for c in counts]), total, known, ends, prior)
            ids = pa.array(block.ids, mask=block.ids == B.NO_ID)
            yield pa.RecordBatch.from_arrays([ids, pa.array(held_out(block.ids)), pa.array(np.diff(tokens.bounds)), pa.array(n_known), pa.array(np.full(len(ids), total)), pa.array(base), pa.array(model)], names=list(kinds))

    return B.back(packed, replies, "counts").select("block", "ids", "bounds", "data", "counts").mapInArrow(scored, made).withColumnRenamed("id", id_column)
