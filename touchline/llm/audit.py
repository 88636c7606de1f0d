"""Filter interaction audit: what each filter removes in every order of the filters, and what it adds to the others.

Method: existential self-join. The copies (filter E) are the documents that a left-semi join on the hash, the exact text
and a smaller doc_id marks. The join reads only texts whose hash occurs twice, and from its right side one row a text,
so a group of copies costs its rows, not its pairs; both sides are spread over SALTS keys a hash. The marked ids are
united with the documents' other failures (a copy leaves the combination of its other failures and enters the one with
E), and the combinations of bits are counted for each part. All orders of the filters are read from those counts.

Defined results: null text is empty, a null part the empty string. A row without doc_id is neither a copy nor has any,
and is counted. Repeated rows count each; rows with one id are no copies of each other. Without labels a document is
neither good nor toxic; of several labels any counts. A text longer than SLICE bytes is read in slices. An empty table
gives no rows. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import SPACE, buffers, gathered, words_of
from touchline.session import stage

SLICE = 2 << 20
SALTS = 16
LETTERS = "ABCDE"
COPY = 16

# The conditions under which a document fails the filters A to D.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


class Counts:
    """Words, distinct words, capitals, code points and symbols of each text."""

    def __init__(self, texts: pa.Array):
        words = words_of(texts)
        data, bounds = words.bytes_, words.bounds
        self.words = np.diff(words.first)
        sizes = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int64)
        inside = np.ascontiguousarray(data[~SPACE[data]])
        self.word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(sizes), pa.py_buffer(inside)]).dictionary_encode()
        number = self.word.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.unique(words.doc * max(1, len(self.word.dictionary)) + number)
        self.distinct = np.bincount(pairs // max(1, len(self.word.dictionary)), minlength=len(self.words))
        self.capitals = self._held((data >= ord("A")) & (data <= ord("Z")), bounds)
        self.points = self._held((data & 0xC0) != 0x80, bounds)
        self.symbols = self._held(_SYMBOL[data], bounds)

    @staticmethod
    def _held(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def _slices(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cut a text behind white space, so that no word is divided."""
    at = 0
    while len(data) - at > limit:
        to = at + limit
        while to < len(data):
            blank = np.flatnonzero(SPACE[data[to : to + limit]])
            if len(blank):
                to += int(blank[0]) + 1
                break
            to += limit
        yield data[at : min(to, len(data))]
        at = min(to, len(data))
    if at < len(data):
        yield data[at:]


def _mask(words, distinct, capitals, points, symbols):
    return (
        (words < LEAST_WORDS) * 1
        + (100 * distinct < DISTINCT_PERCENT * words) * 2
        + (100 * capitals > CAPITALS_PERCENT * points) * 4
        + (symbols > 0) * 8
    )


def masks(texts: pa.Array, limit: int) -> np.ndarray:
    """The failures A to D of each text as bits; a single text longer than `limit` bytes is read in slices."""
    data, bounds = buffers(texts)
    if len(bounds) == 2 and len(data) > limit:
        total, seen = np.zeros(4, np.int64), set()
        for part in _slices(data, limit):
            c = Counts(pa.array([part.tobytes()], pa.large_binary()))
            total += [c.words[0], c.capitals[0], c.points[0], c.symbols[0]]
            seen.update(c.word.dictionary.to_pylist())
        return np.array([_mask(total[0], len(seen), *total[1:])])
    c = Counts(texts)
    return _mask(c.words, c.distinct, c.capitals, c.points, c.symbols)


def _judged(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", limit):
            if batch.num_rows:
                mask = pa.array(masks(batch.column("text"), limit).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), mask], names=["doc_id", "part", "mask"])

    return run


def failures(docs: DataFrame) -> DataFrame:
    """The failures A to D of each row of (doc_id, part, text): doc_id, part, mask."""
    return docs.select("doc_id", "part", "text").mapInArrow(_judged(SLICE), "doc_id long, part string, mask int")


def copies(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, part, text) whose text a row with a smaller doc_id has as well."""
    rows = docs.where("doc_id is not null").withColumn("_hash", F.xxhash64("text"))
    again = rows.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS).cast("long")))
    suspects = stage(salted.join(again.select("_hash", salts), ["_hash", "_salt"], "left_semi"), "suspects")
    first = suspects.groupBy("_hash", "text").agg(F.min("doc_id").alias("_first")).select("_hash", "text", "_first", salts)
    mine, other = suspects.alias("mine"), first.alias("other")
    same = [F.col(f"mine.{c}") == F.col(f"other.{c}") for c in ("_hash", "_salt", "text")]
    return mine.join(other, [*same, F.col("other._first") < F.col("mine.doc_id")], "left_semi").select("doc_id", "part", "text")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of each part by the filters that they fail: part, mask, docs, good, toxic."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    copied = stage(failures(copies(docs)), "copies")
    marks = failures(docs).withColumn("n", F.lit(1)).unionByName(copied.withColumn("n", F.lit(-1)))
    marks = marks.unionByName(copied.select("doc_id", "part", (F.col("mask") + COPY).alias("mask"), F.lit(1).alias("n")))
    by_id = marks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).where("n != 0")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    held = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return by_id.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("docs"), held("good").alias("good"), held("toxic").alias("toxic"))


def _steps(letters: str) -> str:
    """Every step of every order: the order, the step, its filter as a bit and the bits of the filters before it."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    steps = [
        {"filter_order": "".join(order), "step": k + 1, "own": bit[c], "before": sum(bit[b] for b in order[:k])}
        for order in permutations(letters) for k, c in enumerate(order)
    ]
    return json.dumps(steps)


def report(combined: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Each step of every order, from counts of combinations: see `audit` for the columns."""
    steps = F.from_json(F.lit(_steps(letters)), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    rows = combined.select("*", F.inline(steps))
    own, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda cond, of="docs": F.sum(F.when(cond, F.col(of)).otherwise(0)).cast("long")
    # of the orders, the share in which a filter comes first among those that a document fails is one over their number
    orders = len(list(permutations(letters)))
    first = F.col("docs") * (F.lit(orders) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~earlier & ~own).alias("kept"),
        total(own & ~earlier).alias("removed"),
        total(own & earlier).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(own & ~earlier, "good").alias("good_lost"),
        total(own & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(F.when(own, first).otherwise(0)).cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over (doc_id, lang, text) and labels (doc_id, quality, toxic).

    One row for each part, order of the filters and step: how many documents are kept after the step, removed at it,
    would have been removed but went earlier (redundant), fail its filter alone (unique_fails); of the removed, the good
    and the toxic ones; and what its filter removes summed over all orders (shapley).
    """
    return report(stage(combinations(docs, labels), "combinations"))
