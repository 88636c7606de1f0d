"""Exact top-k search by inner product of whole-number vectors.

Method: Voronoi kNN join. Pivots cut the space into cells; queries and data belong to the cell of their nearest pivot. A
summary of a cell holds how far its members reach along its pivot and how far off that axis they lie, and for data also
the members with the greatest products with the pivot. From the summaries comes, for each cell of queries, a score that
each of its queries surely reaches k times. A vector is sent to a cell of queries only if its greatest possible score
there is not below that bound. Cells of queries travel in packs of at most QUERIES queries (a larger cell is split) and
data in blocks of about ROWS vectors, so a task solves one pack against one block, best bounds first, and returns k rows
a query. Where the bounds exclude nothing, as with nearly orthogonal vectors, the work is queries times vectors.

Defined results: a component x becomes floor(scale * x). Vectors that are null, or hold null or non-finite components
(also after scaling), and rows without id take no part. Missing components of a shorter vector count as 0; an empty
vector scores 0. A query's own row is every row with its id. Repeated rows are candidates as often as they occur; equal
queries are answered once, different vectors of one id each. Scores beyond 64 bits are held at the end of the range.
Ties go to the smaller id. Empty tables give no rows. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stage

#: Cells, and vectors that the pivots are fitted on (at most twice as many are read); results don't depend on them.
PIVOTS = 64
SAMPLE = 4096
#: Queries of a pack, vectors of a block, vectors scored at once.
QUERIES = 4096
ROWS = 8192
STEP = 1024
EXACT = float(1 << 53)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def vectors(df: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """Rows that take part: vec_id, and vector with whole numbers as doubles."""
    raw = F.col(embedding)
    kept = df.where(F.col(vec_id).isNotNull() & raw.isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(raw, lambda x: x.cast("double") * F.lit(float(scale))).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return kept.where(finite).mapInArrow(_floored, "vec_id long, vector array<double>")


def _floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("vector")
        floor = pa.array(np.floor(lists.flatten().to_numpy(zero_copy_only=False)) + 0.0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(offsets, floor)], names=["vec_id", "vector"])


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, with zeros behind those that are shorter."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _cut(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """Pieces whose matrix takes at most about 32 MB."""
    rows = max(1, (32 << 20) // (8 * max(1, width)))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


@dataclass
class Cells:
    """Pivots, and what is known of the queries' cells: reach along the axis, off it, and the score surely reached."""

    pivots: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    off: np.ndarray | None = None
    sure: np.ndarray | None = None

    def __post_init__(self):
        norms = np.linalg.norm(self.pivots, axis=1, keepdims=True)
        self.axes = np.divide(self.pivots, norms, out=np.zeros_like(self.pivots), where=norms > 0)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return np.argmin((self.pivots**2).sum(1)[None] - 2 * (x @ self.pivots.T), axis=1)

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector and cell: the length along the cell's axis, and the distance off it."""
        with np.errstate(over="ignore", invalid="ignore"):
            along = x @ self.axes.T
            off = np.sqrt(np.maximum((x * x).sum(1)[:, None] - along * along, 0))
        return along, off

    def at_most(self, x: np.ndarray) -> np.ndarray:
        """The greatest score that each vector can have with a query of each cell, rounding included."""
        along, off = self.reach(x)
        with np.errstate(over="ignore", invalid="ignore"):
            best = np.maximum(along * self.low, along * self.high) + off * self.off
            return best + 1e-9 * (np.abs(along) + off) * (np.maximum(np.abs(self.low), np.abs(self.high)) + self.off) + 1e-3

    def at_least(self, x: np.ndarray) -> np.ndarray:
        along, off = self.reach(x)
        with np.errstate(over="ignore", invalid="ignore"):
            worst = np.minimum(along * self.low, along * self.high) - off * self.off
            return worst - 1e-9 * (np.abs(along) + off) * (np.maximum(np.abs(self.low), np.abs(self.high)) + self.off) - 1e-3

    def wanted(self, x: np.ndarray) -> np.ndarray:
        """Which cells of queries need which vector; what can't be told is wanted."""
        return ~(self.at_most(x) < self.sure)


def fit_pivots(sample: np.ndarray, pivots: int, rounds: int = 5) -> np.ndarray:
    """Means of nearby sample vectors."""
    centres = np.unique(sample, axis=0)
    centres = centres[np.random.default_rng(7).permutation(len(centres))[:pivots]]
    for _ in range(rounds):
        cell = Cells(centres).nearest(sample)
        for c in range(len(centres)):
            members = sample[cell == c]
            if len(members):
                centres[c] = members.mean(0)
    return centres


def summaries(rows: DataFrame, cells: Cells, keep: int) -> DataFrame:
    """Of each cell: members, least and greatest length along the axis, greatest distance off it, and `keep` members with
    the greatest products with the pivot, one row each (without an id if none is kept)."""
    width = cells.pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(cells.pivots), np.int64)
        low, high, off = np.full(len(n), np.inf), np.full(len(n), -np.inf), np.zeros(len(n))
        best: list[list] = [[] for _ in n]
        for batch in batches:
            for piece in _cut(batch, width):
                x, ids = matrix(piece.column("vector"), width), piece.column("vec_id").to_numpy()
                cell = cells.nearest(x)
                along, far = cells.reach(x)
                own, beside = along[np.arange(len(x)), cell], far[np.arange(len(x)), cell]
                np.add.at(n, cell, 1)
                np.minimum.at(low, cell, own)
                np.maximum.at(high, cell, own)
                np.maximum.at(off, cell, beside)
                for c in np.unique(cell) if keep else ():
                    at = np.flatnonzero(cell == c)
                    at = at[np.argsort(-own[at], kind="stable")[:keep]]
                    best[c] = sorted([*best[c], *((-own[i], int(ids[i]), x[i].tolist()) for i in at)])[:keep]
        for c in np.flatnonzero(n):
            members = best[c] or [(None, None, None)]
            yield pa.RecordBatch.from_pylist(
                [
                    {"cell": int(c), "n": int(n[c]) if not i else 0, "low": low[c], "high": high[c], "off": off[c], "product": -p if p is not None else None, "vec_id": v, "vector": x}
                    for i, (p, v, x) in enumerate(members)
                ],
                schema=pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("off", pa.float64()), ("product", pa.float64()), ("vec_id", pa.int64()), ("vector", pa.list_(pa.float64()))]),
            )

    parts = rows.select("vec_id", "vector").mapInArrow(run, "cell long, n long, low double, high double, off double, product double, vec_id long, vector array<double>")
    nearest = F.row_number().over(Window.partitionBy("cell").orderBy(F.col("product").desc(), "vec_id", "vector"))
    whole = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("off").alias("off"))
    members = parts.where("vec_id is not null").withColumn("place", nearest).where(F.col("place") <= max(1, keep))
    return whole.join(members.select("cell", "vec_id", "vector"), "cell", "left")


def sure_scores(cells: Cells, ids: np.ndarray, members: np.ndarray, k: int) -> np.ndarray:
    """For each cell of queries a score that every query there reaches with k rows that are not its own."""
    _, one = np.unique(ids, return_index=True)
    least = cells.at_least(members[one]) if len(one) else np.zeros((0, len(cells.pivots)))
    if len(least) <= k:
        return np.full(len(cells.pivots), -np.inf)
    # one of the rows may be the query's own
    return np.nan_to_num(-np.sort(-least, axis=0)[k], nan=-np.inf)


def packs_of(cells: Cells, counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """First pack and number of packs of each cell of queries: near cells share one, a large cell is split."""
    first, parts, pack = np.full(len(counts), -1), np.ones(len(counts), np.int64), 0
    left = set(np.flatnonzero(counts).tolist())
    while left:
        seed = max(left, key=lambda c: (counts[c], -c))
        left.discard(seed)
        first[seed], held = pack, counts[seed]
        parts[seed] = max(1, math.ceil(counts[seed] / limit))
        gaps = ((cells.pivots - cells.pivots[seed]) ** 2).sum(1)
        for c in sorted(left, key=lambda c: (gaps[c], c)) if parts[seed] == 1 else ():
            if held + counts[c] <= limit:
                first[c], held = pack, held + counts[c]
                left.discard(c)
        pack += parts[seed]
    return first, parts


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can pass 53 bits, else in whole numbers, held at 64 bits."""
    with np.errstate(over="ignore"):
        fits = np.abs(q).sum(1).max(initial=0) * np.abs(x).max(initial=0) < EXACT
    if fits:
        return q @ x.T
    whole = lambda m: np.array([int(v) for v in m.ravel().tolist()], object).reshape(m.shape)
    return np.clip(whole(q) @ whole(x).T, _LOW, _HIGH).astype(np.int64)


class Best:
    """The k best of each query so far, in order: greatest score, then smallest id."""

    def __init__(self, queries: int, k: int):
        self.k, self.n = k, queries
        self.query, self.ids, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.kth, self.full = np.zeros(queries, np.int64), np.zeros(queries, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of all queries (rows) with some vectors; pairs that aren't allowed don't count."""
        may = allowed & ((score >= self.kth[:, None]) | ~self.full[:, None])
        if score.shape[1] > self.k:
            shown = np.where(allowed, score, -np.inf if score.dtype == float else _LOW)
            may &= shown >= np.partition(shown, -self.k, axis=1)[:, -self.k][:, None]
        row, col = np.nonzero(may)
        query, some = np.concatenate([self.query, row]), np.concatenate([self.ids, ids[col]])
        value = np.concatenate([self.score, score[row, col].astype(np.int64)])
        order = np.lexsort((some, ~value, query))
        order = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < self.k]
        self.query, self.ids, self.score = query[order], some[order], value[order]
        held = np.bincount(self.query, minlength=self.n)
        self.full = held >= self.k
        self.kth[self.full] = self.score[(np.cumsum(held) - 1)[self.full]]

    def settled(self, limit: float) -> bool:
        """Whether no vector of at most this score can be among the best."""
        return bool(self.full.all() and limit < self.kth.min(initial=_HIGH))


def _solve(cells: Cells, k: int, step: int):
    width = cells.pivots.shape[1]

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        q_all, q_ids = matrix(queries.column("vector"), width), queries.column("vec_id").to_numpy()
        keys, q_cell = queries.column("query").to_numpy(), queries.column("cell").to_numpy()
        x_all, x_ids = matrix(data.column("vector"), width), data.column("vec_id").to_numpy()
        limits = cells.at_most(x_all) if len(x_all) else np.zeros((0, len(cells.pivots)))
        for c in np.unique(q_cell) if len(x_all) else ():
            mine = np.flatnonzero(q_cell == c)
            may = np.flatnonzero(~(limits[:, c] < cells.sure[c]))
            may = may[np.argsort(-limits[may, c], kind="stable")]
            best = Best(len(mine), k)
            for a in range(0, len(may), step):
                part = may[a : a + step]
                if best.settled(limits[part[0], c]):
                    break
                best.add(_scores(q_all[mine], x_all[part]), x_ids[part], q_ids[mine][:, None] != x_ids[part][None])
            out["query"] += keys[mine][best.query].tolist()
            out["query_id"] += q_ids[mine][best.query].tolist()
            out["vec_id"] += best.ids.tolist()
            out["score"] += best.score.tolist()
        return pa.table(out, schema=pa.schema([(n, pa.int64()) for n in out]))

    return run


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: float = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k rows of `df` with the greatest inner products with each row under `is_query` (a condition on vec_id).

    Columns query_id, rank (from 1), vec_id, score.
    """
    spark = df.sparkSession
    rows = stage(vectors(df, vec_id, embedding, scale), "vectors")
    total, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    queries = rows.where(is_query).distinct().withColumn("query", F.xxhash64("vec_id", "vector"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total:
        return empty
    share = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 40).cast("long")) < F.lit(math.ceil(min(1.0, SAMPLE / total) * (1 << 40))).cast("long")
    sample = matrix(rows.where(share).select("vector").distinct().limit(2 * SAMPLE).toArrow().column("vector"), width or 0)
    cells = Cells(fit_pivots(sample, PIVOTS) if len(sample) else np.zeros((1, width)))

    m = len(cells.pivots)
    counts, cells.low, cells.high, cells.off = np.zeros(m, np.int64), np.zeros(m), np.zeros(m), np.zeros(m)
    for r in summaries(queries, cells, 0).collect():
        counts[r.cell], cells.low[r.cell], cells.high[r.cell], cells.off[r.cell] = r.n, r.low, r.high, r.off
    if not counts.any():
        return empty
    known = [(r.vec_id, r.vector) for r in summaries(rows, cells, k + 1).collect() if r.vec_id is not None]
    cells.sure = sure_scores(cells, np.array([v for v, _ in known]), np.array([x for _, x in known]).reshape(len(known), width), k)
    first, parts = packs_of(cells, counts, QUERIES)
    blocks = max(1, math.ceil(total / ROWS))

    def to_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _cut(batch, width):
                cell = cells.nearest(matrix(piece.column("vector"), width))
                pack = first[cell] + piece.column("query").to_numpy() % parts[cell]
                yield pa.RecordBatch.from_arrays([pa.array(pack), pa.array(cell.astype(np.int64)), *[piece.column(c) for c in ("query", "vec_id", "vector")]], names=["pack", "cell", "query", "vec_id", "vector"])

    of_cell = [np.arange(first[c], first[c] + parts[c]) if counts[c] else np.zeros(0, np.int64) for c in range(m)]
    n_packs = int((first + parts)[counts > 0].max())

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _cut(batch, width):
                wanted = cells.wanted(matrix(piece.column("vector"), width))
                for pack in range(n_packs):
                    here = [c for c in range(m) if pack in of_cell[c]]
                    at = np.flatnonzero(wanted[:, here].any(1))
                    if len(at):
                        kept = piece.take(pa.array(at))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), pack)), *[kept.column(c) for c in ("block", "vec_id", "vector")]], names=["pack", "block", "vec_id", "vector"])

    asked = queries.mapInArrow(to_packs, "pack long, cell long, query long, vec_id long, vector array<double>")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # rows are numbered over the blocks by where they are read, so that repeated rows spread as well
    block = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks).cast("long"))
    sent = rows.withColumn("block", block).mapInArrow(replicate, "pack long, block long, vec_id long, vector array<double>")
    pairs = asked.groupBy("pack", "block").cogroup(sent.groupBy("pack", "block"))
    near = pairs.applyInArrow(_solve(cells, k, STEP), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
