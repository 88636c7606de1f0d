"""Nearest-neighbour imputation by an exact search over an index of cells.

The donors of each pattern of missing columns are cut into cells at medians, as
in a k-d tree. An aggregate gives each cell its bounding box and its rows. A
probe first visits the cells that surely hold k donors nearest to it (its home);
the distance of the k-th one found there bounds the search, and then it visits
only the cells whose boxes are nearer than that. Cells that no probe visits are
never moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import stage

#: Probes that search a cell in one task, and donors of a cell where the index is not at its largest.
PROBE_ROWS = 4_000
CELL_ROWS = 1_000
#: Cells of the index (its boxes travel with the tasks); larger cells are searched in parts of PART_ROWS donors.
MOST_CELLS = 16_384
PART_ROWS = 50_000
#: Donors that the cuts are taken from (at most twice as many are read); results don't depend on them.
SAMPLE_ROWS = 65_536
AT_ONCE = 2_000_000


@dataclass
class Tree:
    """Cuts of one pattern: at each node the column and the value that divide it; a leaf has column -1."""

    column: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)

    def grow(self, rows: np.ndarray, least: int) -> int:
        node = len(self.column)
        self.column.append(-1), self.cut.append(0.0), self.left.append(-1), self.right.append(-1)
        spread = rows.max(0) - rows.min(0) if len(rows) else np.zeros(rows.shape[1])
        if len(rows) >= 2 * least and spread.max(initial=0) > 0:
            # the widest column, in units of its deviation over the table
            j = int(np.argmax(spread))
            cut = float(np.median(rows[:, j]))
            below = rows[:, j] <= cut
            if below.all():
                cut = float(rows[:, j][rows[:, j] < cut].max())
                below = rows[:, j] <= cut
            self.column[node], self.cut[node] = j, cut
            self.left[node] = self.grow(rows[below], least)
            self.right[node] = self.grow(rows[~below], least)
        return node

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        column, cut, left, right = (np.array(v) for v in (self.column, self.cut, self.left, self.right))
        while True:
            inner = np.flatnonzero(column[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = np.where(rows[inner, column[node]] <= cut[node], left[node], right[node])


@dataclass
class Boxes:
    """The cells: the pattern of known columns of each, its box, how many rows its donors stand for."""

    known: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of each probe from the donors of each cell; NaN where they share no column."""
        least, most, shared = (np.zeros((len(q), len(self.rows))) for _ in range(3))
        for j in range(q.shape[1]):
            both = ~np.isnan(q[:, j])[:, None] & self.known[:, j][None]
            below, above = self.low[:, j][None] - q[:, j, None], q[:, j, None] - self.high[:, j][None]
            least += np.where(both, np.maximum(np.maximum(below, above), 0) ** 2, 0)
            most += np.where(both, np.maximum(np.abs(below), np.abs(above)) ** 2, 0)
            shared += both
        with np.errstate(invalid="ignore", divide="ignore"):
            scale = np.where(shared > 0, q.shape[1] / shared, np.nan)
        return least * scale, most * scale

    def homes(self, q: np.ndarray, k: int) -> np.ndarray:
        """For each probe the cells that, nearest first, surely hold k rows for each of its missing columns."""
        _, most = self.distances(q)
        home = np.zeros(most.shape, bool)
        for t in range(q.shape[1]) if most.size else ():
            ask = np.flatnonzero(np.isnan(q[:, t]))
            usable = self.known[:, t][None] & ~np.isnan(most[ask])
            order = np.argsort(np.where(usable, most[ask], np.inf), axis=1, kind="stable")
            held = np.cumsum(np.take_along_axis(np.where(usable, self.rows, 0), order, 1), axis=1)
            # cells before which fewer than k rows are held
            first = np.concatenate([np.ones((len(ask), 1), bool), held[:, :-1] < k], axis=1)
            nearest = np.zeros(order.shape, bool)
            np.put_along_axis(nearest, order, first, 1)
            home[ask] |= nearest & usable
        return home

    def visits(self, q: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
        """The other cells that may hold a donor within the bound of a missing column."""
        least, _ = self.distances(q)
        near = np.zeros(least.shape, bool)
        for t in range(q.shape[1]):
            ask = np.isnan(q[:, t])
            limit = np.where(np.isnan(bounds[:, t]), np.inf, bounds[:, t]) * (1 + 1e-9)
            near |= ask[:, None] & self.known[:, t][None] & (least <= limit[:, None])
        return near & ~self.homes(q, k)


def _matrix(batch, cols: Sequence[str]) -> np.ndarray:
    """The columns side by side, NULL as NaN."""
    return np.stack([np.array(batch.column(c).cast(pa.float64()).fill_null(np.nan)) for c in cols], axis=1)


def _search(cols: Sequence[str], k: int):
    """Of a cell's donors the k nearest of each probe and missing column, as (distance, value, copies)."""
    names = [("_probe", pa.string()), ("_target", pa.string()), ("_dist", pa.float64()), ("_value", pa.float64()), ("_copies", pa.int64())]

    def run(probes: pa.Table, donors: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n, _ in names}
        if not probes.num_rows or not donors.num_rows:
            return pa.table(out, schema=pa.schema(names))
        q_all, d = _matrix(probes, cols), _matrix(donors, cols)
        keys, copies = probes.column("_probe").combine_chunks(), donors.column("_n").to_numpy().astype(np.int64)
        known = ~np.isnan(d[0])
        step = max(1, AT_ONCE // len(d))
        for a in range(0, len(q_all), step):
            q = q_all[a : a + step]
            both = ~np.isnan(q) & known
            gap = np.where(both[:, None, :], q[:, None, :] - d[None], 0.0)
            total = (gap * gap).sum(2)
            with np.errstate(invalid="ignore", divide="ignore"):
                dist = total * len(cols) / both.sum(1)[:, None]
            for t in np.flatnonzero(known):
                ask = np.flatnonzero(np.isnan(q[:, t]) & both.any(1))
                if not len(ask):
                    continue
                here = dist[ask]
                limit = np.partition(here, k - 1, axis=1)[:, k - 1] if here.shape[1] > k else np.full(len(ask), np.inf)
                row, col = np.nonzero(here <= limit[:, None])
                order = np.lexsort((d[col, t], here[row, col], row))
                row, col = row[order], col[order]
                # the nearest vectors that together make up at least k rows
                n = copies[col]
                before = np.cumsum(n) - n
                before -= before[np.searchsorted(row, row)]
                row, col = row[before < k], col[before < k]
                out["_probe"].append(keys.take(pa.array(a + ask[row])))
                out["_target"].append(pa.array([cols[t]] * len(row), pa.string()))
                out["_dist"].append(pa.array(here[row, col]))
                out["_value"].append(pa.array(d[col, t]))
                out["_copies"].append(pa.array(copies[col]))
        return pa.table({n: pa.chunked_array(v, kind) for (n, kind), v in zip(names, out.values(), strict=True)})

    return run


class Index:
    """Cells over the distinct vectors of a table, each with its number of copies (`_n`)."""

    def __init__(self, donors: DataFrame, cols: Sequence[str], cell_rows: int):
        self.cols = list(cols)
        total = donors.count()
        known = sum(F.when(F.col(c).isNotNull(), F.lit(1 << j)).otherwise(0) for j, c in enumerate(self.cols))
        donors = donors.withColumn("_known", known.cast("long"))
        share = F.pmod(F.xxhash64(*self.cols), F.lit(1 << 40)) < F.lit(math.ceil(min(1.0, SAMPLE_ROWS / max(1, total)) * (1 << 40)))
        sample = donors.where(share).select("_known", *self.cols).limit(2 * SAMPLE_ROWS).toArrow()
        masks, rows = sample.column("_known").to_numpy(), _matrix(sample, self.cols)
        # as many sample rows in a leaf as there are donors in a cell
        wanted = max(cell_rows, total / MOST_CELLS)
        least = max(1, math.ceil(wanted / 2 * len(rows) / max(1, total)))
        scale = np.nanstd(rows, axis=0) if len(rows) else np.ones(len(self.cols))
        self.scale = np.where(np.isfinite(scale) & (scale > 0), scale, 1.0)
        self.trees: dict[int, Tree] = {}
        for mask in np.unique(masks).tolist():
            tree = self.trees[mask] = Tree()
            tree.grow(np.nan_to_num(rows[masks == mask] / self.scale), least)
        ddl = T.StructType([*donors.schema.fields, T.StructField("_leaf", T.LongType())])
        leaves = stage(donors.mapInArrow(self._leaves(), ddl), "donors")
        found = leaves.groupBy("_known", "_leaf").agg(
            F.sum("_n").alias("rows"), F.count("*").alias("donors"),
            *[F.min(c).alias(f"low_{c}") for c in self.cols], *[F.max(c).alias(f"high_{c}") for c in self.cols],
        )
        table = found.orderBy("_known", "_leaf").toArrow()
        low, high = (np.nan_to_num(_matrix(table.rename_columns([n.removeprefix(side) for n in table.column_names]), self.cols)) for side in ("low_", "high_"))
        mask = table.column("_known").to_numpy()
        self.boxes = Boxes((mask[:, None] >> np.arange(len(self.cols))) & 1 > 0, low, high, table.column("rows").to_numpy())
        self.parts = np.maximum(1, -(-table.column("donors").to_numpy() // PART_ROWS))
        self.number = {(m, leaf): i for i, (m, leaf) in enumerate(zip(mask.tolist(), table.column("_leaf").to_pylist(), strict=True))}
        self.donors = leaves

    def _leaves(self):
        trees, cols, scale = self.trees, self.cols, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask, rows = batch.column("_known").to_numpy(), np.nan_to_num(_matrix(batch, cols) / scale)
                leaf = np.zeros(len(mask), np.int64)
                for m in np.unique(mask).tolist():
                    if m in trees:  # a pattern that the sample lacks is one cell
                        leaf[mask == m] = trees[m].leaf(rows[mask == m])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "_leaf"])

        return run

    def pairs(self, probes: DataFrame, k: int, bounded: bool) -> DataFrame:
        """Each probe with the cells that it visits (`_cell`): its home cells, or those that the bounds `_b_` leave."""
        boxes, cols = self.boxes, self.cols
        step = max(1, AT_ONCE // max(1, len(boxes.rows)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, step):
                    part = batch.slice(a, step)
                    q = _matrix(part, cols)
                    seen = boxes.visits(q, _matrix(part, [f"_b_{c}" for c in cols]), k) if bounded else boxes.homes(q, k)
                    row, cell = np.nonzero(seen)
                    kept = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(cell), *[kept.column(c) for c in ["_probe", *cols]]], names=["_cell", "_probe", *cols])

        return probes.mapInArrow(run, "_cell long, _probe string, " + ", ".join(f"`{c}` double" for c in cols))

    def search(self, pairs: DataFrame, k: int, probe_rows: int) -> DataFrame:
        """The nearest donors in the cells visited: _probe, _target, _dist, _value, _copies."""
        pairs = stage(pairs, "visits")
        counts = {r["_cell"]: r["n"] for r in pairs.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
        self.visited = counts
        # of each cell: parts of its donors, and groups of its probes; only the donors of visited cells move
        rows = [(*key, i, int(self.parts[i]), math.ceil(counts[i] / probe_rows)) for key, i in self.number.items() if i in counts]
        cells = pairs.sparkSession.createDataFrame(rows, "_known long, _leaf long, _cell long, _parts long, _groups long")
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        asked = pairs.join(cells.select("_cell", "_parts", "_groups"), "_cell").withColumn("_group", F.pmod(F.xxhash64("_probe"), F.col("_groups"))).withColumn("_part", each("_parts"))
        held = self.donors.join(cells, ["_known", "_leaf"]).withColumn("_part", F.pmod(F.xxhash64(*self.cols), F.col("_parts"))).withColumn("_group", each("_groups"))
        asked = asked.select("_cell", "_part", "_group", "_probe", *self.cols)
        held = held.select("_cell", "_part", "_group", "_n", *self.cols)
        keys = ["_cell", "_part", "_group"]
        return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
            _search(self.cols, k), "_probe string, _target string, _dist double, _value double, _copies long"
        )


def _keep_nearest(df: DataFrame, k: int) -> DataFrame:
    """Per probe and column the nearest values that together make up at least k rows; `_before`: rows before it."""
    groups = ["_probe", "_target"]
    same = df.groupBy(*groups, "_dist", "_value").agg(F.sum("_copies").alias("_copies"))
    upto = Window.partitionBy(*groups).orderBy("_dist", "_value").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_copies").over(upto), F.lit(0))
    return same.withColumn("_before", before).where(F.col("_before") < k)


def knn_impute(
    df: DataFrame,
    cols: Sequence[str],
    k: int = 5,
    probe_rows: int = PROBE_ROWS,
    cell_rows: int = CELL_ROWS,
    trace: dict | None = None,
) -> DataFrame:
    """Fill NULLs of ``cols`` with the mean of the k nearest rows that have the column.

    Nearness is the Euclidean distance over the columns both rows have, scaled up
    for the missing ones; equal distances are taken in order of the donor's value.
    A row with no neighbour at all gets the column mean.

    Incomplete and donor rows shrink to distinct vectors first. ``trace`` takes
    the number of cells, of probes, and of pairs of them that were visited.
    """
    cols = list(cols)
    vectors = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    any_null = " or ".join(f"{c} is null" for c in cols)
    some_value = " or ".join(f"{c} is not null" for c in cols)
    probes = stage(vectors.where(any_null).where(some_value).distinct().withColumn("_probe", _key(cols)), "probes")
    donors = stage(vectors.where(some_value).groupBy(*cols).agg(F.count("*").alias("_n")), "vectors")

    index = Index(donors, cols, cell_rows)
    at_home = stage(_keep_nearest(index.search(index.pairs(probes, k, False), k, probe_rows), k), "home")
    visited = sum(index.visited.values())
    of = lambda c: F.col("_target") == c
    # with fewer than k rows at home no cell is left out
    bounds = at_home.groupBy("_probe").agg(
        *[F.when(F.sum(F.when(of(c), F.col("_copies"))) >= k, F.max(F.when(of(c), F.col("_dist")))).alias(f"_b_{c}") for c in cols]
    )
    beyond = index.search(index.pairs(probes.join(bounds, "_probe", "left"), k, True), k, probe_rows)
    if trace is not None:
        trace.update(cells=len(index.boxes.rows), probes=probes.count(), visited=visited + sum(index.visited.values()))
    best = _keep_nearest(at_home.drop("_before").unionByName(beyond), k)
    used = F.least(F.col("_copies"), F.lit(k) - F.col("_before"))
    filled = best.groupBy("_probe").agg(
        *[(F.sum(F.when(of(c), F.col("_value") * used)) / F.sum(F.when(of(c), used))).alias(f"_f_{c}") for c in cols]
    )
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
    # only incomplete rows carry a key, so the complete ones do not crowd one join key
    keyed = df.withColumn("_probe", F.when(F.expr(any_null), _key(cols)))
    return keyed.join(filled, "_probe", "left").select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col(f"_f_{c}"), means[c]).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def _key(cols: Sequence[str]):
    """Text that identifies a vector, NULLs included."""
    parts = [F.coalesce(F.col(c).cast("double").cast("string"), F.lit("-")) for c in cols]
    return F.concat_ws("|", *parts)
