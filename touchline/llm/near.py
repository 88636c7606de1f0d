"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Method: each permutation of the shingles gives two signature values, the smallest and the largest shingle, so half the
hash evaluations of plain MinHash are needed; both are unbiased, and those of one permutation go to different bands.
Documents with one shingle set form a class, and only its first document goes on. Classes that agree in a band are
candidates; 42 bands of 6 values miss a pair of similarity 0.8 with a chance below 3 in a million.

A band's bucket is never paired out. Each member is tied to two pivots of the bucket, ties between signatures that
agree too little are let go, and what hangs together makes a loose cluster. Full sets go once to their cluster, where a
search confirms links and returns only edges of a spanning forest. A large cluster is dealt into blocks, and each pair
of blocks is searched by itself, so no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.graph import components
from touchline.llm.words import U64, mix, pieces, windows, words_of
from touchline.session import stage

ROWS, BANDS = 6, 42
PERMUTATIONS = ROWS * BANDS // 2
#: Share of equal signature bytes from which a tie to a pivot counts; far below any pair that could be linked.
LOOSE = 0.45
#: Shingles in a block of a large cluster (8 bytes each).
BLOCK_SHINGLES = 3_000_000
#: Candidate ids that may be broadcast (8 bytes each); beyond that the texts are joined by a shuffle.
BROADCAST_IDS = 500_000
_FACTORS = mix(np.arange(1, PERMUTATIONS + 1, dtype=U64)) | U64(1)
_TERMS = mix(np.arange(1, PERMUTATIONS + 1, dtype=U64) + U64(1 << 32))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of all texts, one after the other, and the bounds of each."""
    words = words_of(texts, lower=True)
    hashes, first = words.fingerprints(), words.first
    shingle, at = windows(hashes, first, size)
    count = np.maximum(np.diff(first) - size + 1, 0)
    ends = np.cumsum(count)
    sets = []
    for d, (end, n) in enumerate(zip(ends.tolist(), count.tolist(), strict=True)):
        if n:
            sets.append(np.unique(shingle[end - n : end]))
        elif first[d + 1] > first[d]:  # fewer words than a shingle: the whole sequence is one
            few = hashes[first[d] : first[d + 1]]
            sets.append(mix(windows(few, np.array([0, len(few)]), len(few))[0] + U64(len(few))))
        else:
            sets.append(hashes[:0])
    bounds = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else hashes[:0]), bounds


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row a set: the least values under all permutations, then the greatest. Sets must not be empty."""
    out = np.empty((len(bounds) - 1, 2 * PERMUTATIONS), U64)
    starts = bounds[:-1]
    for k in range(PERMUTATIONS if len(starts) else 0):
        moved = shingles * _FACTORS[k] + _TERMS[k]
        out[:, k] = np.minimum.reduceat(moved, starts)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(moved, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A key for each band, different between bands."""
    out = np.empty((len(signature), BANDS), U64)
    for b in range(BANDS):
        key = np.full(len(signature), b + 1, U64)
        for column in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key * U64(31) + signature[:, column])
        out[:, b] = key
    return out


def _features(docs: DataFrame, size: int) -> DataFrame:
    made = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                shingles, bounds = shingle_sets(part.column("text"), size)
                n = np.diff(bounds)
                full = n > 0
                signature = signatures(shingles, np.append(bounds[:-1][full], bounds[-1]))
                keys, low = bands(signature), (mix(signature) & U64(0xFF)).astype(np.uint8)
                at = np.cumsum(full) - 1
                digests = [hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest() for a, b in itertools.pairwise(bounds.tolist())]
                each = np.zeros(len(n) + 1, np.int32)
                np.cumsum(full * BANDS, out=each[1:])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(each), pa.array(keys.view(np.int64).ravel())), pa.array([low[at[i]].tobytes() if full[i] else None for i in range(len(n))], pa.binary())],
                    names=["id", "n", "digest", "keys", "signature"],
                )

    return docs.mapInArrow(run, made)


def _agreeing(ties: DataFrame) -> DataFrame:
    """Of rows a, b, of_a, of_b the ties whose signatures agree in a share LOOSE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("of_a", "of_b")]
                yield batch.filter(pa.array((of[0] == of[1]).mean(axis=1) >= LOOSE)).select(["a", "b"])

    return ties.mapInArrow(run, "a long, b long")


def spanning_links(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links 100 * intersection >= percent * union between the sets."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)
    root = np.arange(n)
    edges = []
    for pivot in range(n - 1):
        others = np.flatnonzero(root != root[pivot])
        others = others[(100 * np.minimum(sizes[others], sizes[pivot]) >= percent * np.maximum(sizes[others], sizes[pivot])) & (others > pivot)]
        if not len(others):
            continue
        own = places[bounds[pivot] : bounds[pivot + 1]]
        mark[own] = True
        if 4 * len(others) > n:
            shared = np.add.reduceat(mark[places], bounds[:-1])[others]
        else:
            shared = np.array([np.count_nonzero(mark[places[bounds[o] : bounds[o + 1]]]) for o in others])
        mark[own] = False
        for o in others[100 * shared >= percent * (sizes[others] + sizes[pivot] - shared)]:
            if root[o] != root[pivot]:
                edges.append((ids[pivot], ids[o]))
                root[root == root[o]] = root[pivot]
    return edges


def _confirmed(members: DataFrame, percent: int) -> DataFrame:
    """Spanning links a, b of rows cluster, i, j, id, set, which come sorted by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "id", "set")), strict=True)

        held: list[tuple[int, int]] = []
        for _, group in itertools.groupby(rows(), key=lambda r: r[:3]):
            found = {r[3]: r[4] for r in group}
            if len(found) > 1:
                held += spanning_links(list(found), [np.frombuffer(s, U64) for s in found.values()], percent)
            if len(held) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in held], pa.int64()) for k in (0, 1)], names=["a", "b"])
                held = []
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in held], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return members.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id_column, `n_shingles`, `component_id` (smallest id reachable by links), `kept`.

    A document's set is its distinct shingles of `size` words, A-Z lowered; with fewer words the whole sequence is one.
    Two documents are linked if 100 * intersection >= percent * union. A document without words, or without an id, is
    linked with nothing and kept. kept: the document is its component's smallest. Repeated rows are linked by their
    equal sets, and with the same id they share its fate. Empty tables give no rows; other columns don't matter.
    """
    source = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"))
    features = stage(_features(source, size), "features")
    sets = features.where("n > 0 and id is not null")
    classes = stage(sets.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    # copies is only there to see which documents stand alone in their class, which most do
    first = sets.join(classes.where("copies > 1").select("digest", "rep"), "digest", "left").where("rep is null or rep = id").select("id", "n", "keys", "signature").dropDuplicates(["id"])
    first = stage(first, "first")

    rows = first.select("id", F.explode("keys").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("id").alias("p"), F.max("id").alias("q")).where("p != q")
    tied = rows.join(buckets, "key").select("id", F.explode(F.array("p", "q")).alias("p")).where("id != p")
    ties = tied.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    signature = first.select(F.col("id").alias("of"), "signature")
    with_a = ties.join(signature.withColumnsRenamed({"of": "a", "signature": "of_a"}), "a")
    loose = components(_agreeing(with_a.join(signature.withColumnsRenamed({"of": "b", "signature": "of_b"}), "b").select("a", "b", "of_a", "of_b")))

    clusters = stage(loose.join(first.select(F.col("id").alias("node"), "n"), "node"), "clusters")
    blocks = clusters.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = clusters.select("node", "component").join(blocks, "component").select(F.col("node").alias("candidate"), F.col("component").alias("cluster"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    few = clusters.count() <= BROADCAST_IDS
    made = T.StructType([T.StructField("cluster", T.LongType()), T.StructField("blocks", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("set", T.BinaryType())])

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                shingles, bounds = shingle_sets(part.column("text"), size)
                full = pa.array([shingles[a:b].tobytes() for a, b in itertools.pairwise(bounds.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("cluster", "blocks", "block", "id")), full], names=made.names)

    candidates = source.join(F.broadcast(placed) if few else placed, F.col("id") == F.col("candidate")).select("cluster", "blocks", "block", "id", "text")
    held = candidates.mapInArrow(full_sets, made)
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    members = held.select("cluster", F.explode(meets).alias("at"), "id", "set").select("cluster", "at.i", "at.j", "id", "set")
    links = _confirmed(members.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id"), percent)
    linked = components(links)

    of_class = classes.where("copies > 1").select("digest", "rep")
    out = features.select("id", "n", "digest").join(of_class, (features["digest"] == of_class["digest"]) & (features["n"] > 0), "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep"))
    out = out.join(linked, F.col("rep") == F.col("node"), "left").withColumn("component_id", F.coalesce("component", "rep"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns."""
    gone = near_duplicates(docs, id_column, text_column, size, percent).where("not kept").select(F.col(id_column).alias("__gone")).distinct()
    return docs.join(gone, docs[id_column] == gone["__gone"], "left_anti")
