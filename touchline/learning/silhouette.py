"""Silhouette of points with free coordinates, to a stated tolerance, below the work of all pairs.

The distinct points of each cluster are cut into cells at medians, the widest and
fullest first. The mean distance from a point to a cell lies between that of the
cell's mean and the root of the mean squared distance; far away it follows closer
from the cell's mean and covariance, by the second-order expansion of the distance,
whose rest is bounded by the cell's size and the gap. As long as the bounds of a
cluster's cells add up to less than the tolerance, a point takes them by their
moments; else it meets the members of the worst cells exactly. So the number of cells
follows the tolerance, not the points, and is chosen by the work on a sample. The
bounds add up to an interval for the result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.knn import Tree
from touchline.session import stage

#: Points of a cell, the fewest and the most cells (their moments travel with the tasks).
CELL_ROWS = 64
LEAST_CELLS = 128
MOST_CELLS = 8_192
#: Points that the cuts are taken from, at most twice as many, and those of them that the work is tried on.
#: They change the work, not the interval's truth.
SAMPLE_ROWS = 65_536
TRIED_ROWS = 256
#: Pairs of points that cost as much as a point and a cell.
PAIRS_A_CELL = 6
#: Points that meet a cell's members in one task, members of a part of a cell, pairs with points and with cells worked
#: out at once, and pairs with cells of a task.
PROBE_ROWS = 20_000
PART_ROWS = 20_000
AT_ONCE = 1_000_000
CELLS_AT_ONCE = 65_536
TASK_CELLS = 100_000_000
# Fixed value: the greatest third derivative of a distance along a line, over 6, for a gap of 1.
THIRD = 2 / math.sqrt(3) / 6


@dataclass
class Cells:
    """Moments of the cells: weight, mean, covariance, the farthest that a member can lie from the mean, the cluster."""

    weight: np.ndarray
    mean: np.ndarray
    cov: np.ndarray
    radius: np.ndarray
    cluster: np.ndarray
    totals: np.ndarray

    def far(self, x: np.ndarray, own: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each point and cell: whether moments do, the mean distance from them, and the bound of its error."""
        gap = [x[:, j, None] - self.mean[None, :, j] for j in range(x.shape[1])]
        trace = np.trace(self.cov, axis1=1, axis2=2)
        squares = sum(g * g for g in gap)
        d = np.sqrt(squares)
        # the mean distance lies between the distance of the mean and the root of the mean square
        most = np.sqrt(squares + trace)
        about, error = (most + d) / 2, (most - d) / 2
        along = sum((1 if i == j else 2) * self.cov[:, i, j] * gap[i] * gap[j] for i in range(len(gap)) for j in range(i, len(gap)))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = THIRD * (self.radius * trace) / (d - self.radius) ** 2
            closer = (d > self.radius) & (rest < error)
            np.copyto(about, d + (trace - along / squares) / (2 * d), where=closer)
        np.copyto(error, rest, where=closer)
        least = np.stack([d[:, mine] @ self.weight[mine] for mine in self.of], axis=1) / self.totals
        mine = least[np.arange(len(x)), own]
        least[np.arange(len(x)), own] = np.inf
        scale = np.maximum(mine, least.min(1, initial=np.inf))
        scale[~np.isfinite(scale)] = 0
        good = np.ones(d.shape, bool)
        for c, mine in enumerate(self.of):
            bound, allowed = error[:, mine] * (self.weight[mine] / self.totals[c]), tolerance / 4 * scale
            over = np.flatnonzero(bound.sum(1) > allowed)
            if len(over):
                # the worst cells are left out until the bounds of the others are small enough
                order = np.argsort(bound[over], axis=1, kind="stable")
                sorted_bound = np.take_along_axis(bound[over], order, 1)
                kept = np.empty(order.shape, bool)
                np.put_along_axis(kept, order, (sorted_bound.cumsum(1) <= allowed[over, None]) | (sorted_bound == 0), 1)
                good[over[:, None], mine[None]] = kept
        return good, about, error

    @property
    def of(self) -> list[np.ndarray]:
        """The cells of each cluster."""
        return [np.flatnonzero(self.cluster == c) for c in range(len(self.totals))]

    @classmethod
    def of_points(cls, x: np.ndarray, w: np.ndarray, cell: np.ndarray, cluster: np.ndarray, totals: np.ndarray) -> Cells:
        """Cells of points at hand: `cell` numbers the cell of each, `cluster` gives that of each cell."""
        k, dims = len(cluster), x.shape[1]
        weight = np.bincount(cell, w, k)
        mean = np.stack([np.bincount(cell, w * x[:, j], k) / weight for j in range(dims)], axis=1)
        gap = x - mean[cell]
        cov = np.stack([[np.bincount(cell, w * gap[:, i] * gap[:, j], k) / weight for j in range(dims)] for i in range(dims)]).transpose(2, 0, 1)
        radius = np.zeros(k)
        np.maximum.at(radius, cell, np.sqrt((gap**2).sum(1)))
        return cls(weight, mean, cov, radius, cluster, totals)


def _forest(rows: Sequence[np.ndarray], cells: int, least: int) -> list[Tree]:
    """Cuts of the points of each cluster into so many cells in all: the one of the widest spread times share is cut next."""
    trees = [Tree([-1], [0.0], [-1], [-1]) for _ in rows]
    heap: list = []

    def offer(c: int, node: int, x: np.ndarray) -> None:
        if len(x) >= 2 * least and (x.max(0) > x.min(0)).any():
            heapq.heappush(heap, (-math.sqrt(x.var(0).sum()) * len(x) / len(rows[c]), c, node, x))

    for c, x in enumerate(rows):
        offer(c, 0, x)
    made = len(rows)
    while heap and made < cells:
        _, c, node, x = heapq.heappop(heap)
        tree, j = trees[c], int(np.argmax(x.max(0) - x.min(0)))
        cut = float(np.median(x[:, j]))
        if cut >= x[:, j].max():
            cut = float(x[:, j][x[:, j] < cut].max())
        below = x[:, j] <= cut
        tree.column[node], tree.cut[node] = j, cut
        tree.left[node], tree.right[node] = len(tree.column), len(tree.column) + 1
        for part in (x[below], x[~below]):
            tree.column.append(-1), tree.cut.append(0.0), tree.left.append(-1), tree.right.append(-1)
            offer(c, len(tree.column) - 1, part)
        made += 1
    return trees


def _leaves(trees: Sequence[Tree], x: np.ndarray, of: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), np.int64)
    for c in np.unique(of).tolist():
        leaf[of == c] = trees[c].leaf(x[of == c])
    return leaf


def _best_forest(x: np.ndarray, of: np.ndarray, w: np.ndarray, clusters: int, total: int, cell_rows: int, tolerance: float) -> list[Tree]:
    """The cuts with the least work for each point, by the sample: pairs with cells, and with the members of near ones."""
    rows = [x[of == c] for c in range(clusters)]
    totals = np.maximum(np.bincount(of, w, clusters), 1e-300)
    limit = max(clusters, min(MOST_CELLS, math.ceil(total / cell_rows)))
    least = max(1, cell_rows * len(x) // max(1, 2 * total))
    tried = np.random.default_rng(0).permutation(len(x))[:TRIED_ROWS]
    best, found, cells = math.inf, None, min(limit, LEAST_CELLS)
    while True:
        trees = _forest(rows, cells, least)
        keys, cell = np.unique(np.stack([of, _leaves(trees, x, of)]), axis=1, return_inverse=True)
        moments, near = Cells.of_points(x, w, cell.ravel(), keys[0], totals), 0.0
        members = np.bincount(cell.ravel(), minlength=keys.shape[1]) * (total / max(1, len(x)))
        step = max(1, CELLS_AT_ONCE // max(1, keys.shape[1]))
        for a in range(0, len(tried), step):
            some = tried[a : a + step]
            near += float((~moments.far(x[some], of[some], tolerance)[0] @ members).sum())
        work = keys.shape[1] * PAIRS_A_CELL + near / max(1, len(tried))
        if work < best:
            best, found = work, trees
        if cells >= limit or cells * PAIRS_A_CELL > best:
            return found
        cells = min(limit, 2 * cells)


def _cells(points: DataFrame, cols: Sequence[str], clusters: Sequence[str], cell_rows: int, tolerance: float) -> tuple[DataFrame, Cells, int]:
    total = points.count()
    share = F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) < F.lit(math.ceil(min(1.0, SAMPLE_ROWS / max(1, total)) * (1 << 40)))
    sample = points.where(share).select("_c", "_w", *cols).limit(2 * SAMPLE_ROWS).toArrow()
    rows, of = np.stack([sample.column(c).to_numpy() for c in cols], axis=1), sample.column("_c").to_numpy()
    trees = _best_forest(rows, of, sample.column("_w").to_numpy(), len(clusters), total, cell_rows, tolerance)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, c_of = np.stack([batch.column(c).to_numpy() for c in cols], axis=1), batch.column("_c").to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_leaves(trees, x, c_of))], names=[*batch.schema.names, "_leaf"])

    fields = ", ".join(f"`{c}` double" for c in cols)
    held = stage(points.mapInArrow(leaves, f"{fields}, _c int, _w double, _leaf long"), "points")
    mean = held.groupBy("_c", "_leaf").agg(F.sum("_w").alias("w"), F.count("*").alias("n"), *[(F.sum(F.col(c) * F.col("_w")) / F.sum("_w")).alias(f"m_{c}") for c in cols])
    # the second pass centres the squares, so that large coordinates lose no digits
    moved = held.join(mean, ["_c", "_leaf"]).withColumns({f"d_{c}": F.col(c) - F.col(f"m_{c}") for c in cols})
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    table = moved.groupBy("_c", "_leaf").agg(
        F.first("w").alias("w"), F.first("n").alias("n"), *[F.first(f"m_{c}").alias(f"m_{c}") for c in cols],
        F.sqrt(F.max(sum(F.col(f"d_{c}") * F.col(f"d_{c}") for c in cols))).alias("r"),
        *[(F.sum(F.col(f"d_{a}") * F.col(f"d_{b}") * F.col("_w")) / F.sum("_w")).alias(f"s_{a}_{b}") for a, b in pairs],
    ).orderBy("_c", "_leaf").toPandas()
    cov = np.zeros((len(table), len(cols), len(cols)))
    for a, b in pairs:
        i, j = cols.index(a), cols.index(b)
        cov[:, i, j] = cov[:, j, i] = table[f"s_{a}_{b}"]
    weight, cluster = table["w"].to_numpy(float), table["_c"].to_numpy()
    totals = np.bincount(cluster, weight, len(clusters))
    number = points.sparkSession.createDataFrame(
        [(int(c), int(leaf), i, max(1, math.ceil(n / PART_ROWS))) for i, (c, leaf, n) in enumerate(zip(table["_c"], table["_leaf"], table["n"], strict=True))],
        "_c int, _leaf long, _cell long, _parts long",
    )
    members = held.join(number, ["_c", "_leaf"]).drop("_leaf")
    return members, Cells(weight, table[[f"m_{c}" for c in cols]].to_numpy(float), cov, table["r"].to_numpy(float), cluster, totals), total


def _pair_sums(cols: Sequence[str]):
    """Of each point the weighted sum of distances to the members of one cell."""

    def run(probes: pa.Table, members: pa.Table) -> pa.Table:
        names = [("_id", pa.int64()), ("_other", pa.int32()), ("_sum", pa.float64()), ("_error", pa.float64())]
        if not probes.num_rows or not members.num_rows:
            return pa.table({n: [] for n, _ in names}, schema=pa.schema(names))
        q, x = (np.stack([t.column(c).to_numpy() for c in cols], axis=1) for t in (probes, members))
        w, out = members.column("_w").to_numpy(), np.zeros(len(q))
        step = max(1, AT_ONCE // len(x))
        for a in range(0, len(q), step):
            out[a : a + step] = np.sqrt(((q[a : a + step, None] - x[None]) ** 2).sum(2)) @ w
        other = np.full(len(q), members.column("_c")[0].as_py(), np.int32)
        return pa.table([probes.column("_id"), pa.array(other), pa.array(out), pa.array(np.zeros(len(q)))], schema=pa.schema(names))

    return run


def silhouette_within(
    df: DataFrame, cols: Sequence[str], label: str, tolerance: float = 0.01, cell_rows: int = CELL_ROWS, trace: dict | None = None
) -> DataFrame:
    """Mean silhouette with the Euclidean distance as one row: silhouette, error (a bound of it, below the tolerance).

    Rows with a NULL coordinate or label are left out; a row alone in its cluster
    counts 0, as does one without a distance to others. `trace` takes the numbers of
    distinct points, of pairs of them, and of pairs that were worked out one by one
    or by cell.
    """
    cols, spark = list(cols), df.sparkSession
    names = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    cols = [f"x{i}" for i in range(len(cols))]
    points = df.select(*names, F.col(label).cast("string").alias("_label")).na.drop("any").groupBy(*cols, "_label").agg(F.count("*").cast("double").alias("_w"))
    points = stage(points, "distinct")
    clusters = [r[0] for r in points.select("_label").distinct().orderBy("_label").limit(MOST_CELLS).collect()]
    if len(clusters) < 2:
        return spark.range(1).select(F.lit(0.0).alias("silhouette"), F.lit(0.0).alias("error")).where(F.lit(bool(clusters)))
    number = spark.createDataFrame(list(enumerate(clusters)), "_c int, _label string")
    coded = points.join(number, "_label").select(*cols, "_c", "_w")
    members, cells, n = _cells(stage(coded, "coded"), cols, clusters, cell_rows, tolerance)
    members = stage(members.withColumn("_id", F.xxhash64("_c", *cols)), "members")
    step = max(1, CELLS_AT_ONCE // max(1, len(cells.weight)))
    names = ["_id", "_other", "_sum", "_error", "_cell", *cols]
    fields = ", ".join(f"{c} double" for c in cols)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the cells of each cluster that moments do for, and a row for each other cell, which has near members."""
        of = cells.of
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                x = np.stack([part.column(c).to_numpy() for c in cols], axis=1)
                good, about, error = cells.far(x, part.column("_c").to_numpy(), tolerance)
                w = good * cells.weight
                about *= w
                error *= w
                empty = [pa.nulls(len(x), pa.int64()), *[pa.nulls(len(x), pa.float64()) for _ in cols]]
                for c, mine in enumerate(of):
                    sums = [pa.array(np.full(len(x), c, np.int32)), pa.array(about[:, mine].sum(1)), pa.array(error[:, mine].sum(1))]
                    yield pa.RecordBatch.from_arrays([part.column("_id"), *sums, *empty], names=names)
                row, cell = np.nonzero(~good)
                if len(row):
                    kept, none = part.take(pa.array(row)), [pa.nulls(len(row), t) for t in (pa.int32(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays([kept.column("_id"), *none, pa.array(cell), *[kept.column(c) for c in cols]], names=names)

    tasks = max(1, math.ceil(n * len(cells.weight) / TASK_CELLS))
    probes = members.select("_id", "_c", *cols).repartition(tasks, "_id")
    far = stage(probes.mapInArrow(seen, f"_id long, _other int, _sum double, _error double, _cell long, {fields}"), "near")
    sums = far.where("_cell is null").select("_id", "_other", "_sum", "_error")
    pairs = far.where("_cell is not null").select("_cell", "_id", *cols)
    visits = pairs.groupBy("_cell").agg(F.count("*").alias("_visits")).withColumn("_groups", F.ceil(F.col("_visits") / PROBE_ROWS))
    visits = stage(visits, "visits")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    parts = members.select("_cell", "_parts").distinct()
    asked = pairs.join(visits, "_cell").join(parts, "_cell").withColumn("_group", F.pmod(F.col("_id"), F.col("_groups"))).withColumn("_part", each("_parts"))
    met = members.join(visits, "_cell").withColumn("_part", F.pmod(F.col("_id"), F.col("_parts"))).withColumn("_group", each("_groups"))
    keys = ["_cell", "_part", "_group"]
    exact = asked.select(*keys, "_id", *cols).groupBy(*keys).cogroup(met.select(*keys, "_c", "_w", *cols).groupBy(*keys)).applyInArrow(
        _pair_sums(cols), "_id long, _other int, _sum double, _error double"
    )
    if trace is not None:
        single = members.groupBy("_cell").agg(F.count("*").alias("n")).join(visits, "_cell").agg(F.sum(F.col("n") * F.col("_visits"))).first()[0] or 0
        trace.update(points=n, pairs=n * n, worked=single + n * len(cells.weight))
    whole = sums.unionByName(exact).groupBy("_id", "_other").agg(F.sum("_sum").alias("_sum"), F.sum("_error").alias("_error"))
    sizes = spark.createDataFrame([(c, float(t)) for c, t in enumerate(cells.totals)], "_other int, _n double")
    whole = whole.join(sizes, "_other").join(members.select("_id", "_c", "_w"), "_id")
    own = F.col("_other") == F.col("_c")
    low, high = F.greatest(F.col("_sum") - F.col("_error"), F.lit(0.0)), F.col("_sum") + F.col("_error")
    rest = F.col("_n") - 1
    ab = whole.groupBy("_id", "_w").agg(
        F.max(F.when(own, F.col("_n"))).alias("_n"),
        F.max(F.when(own, F.try_divide(low, rest))).alias("_a0"), F.max(F.when(own, F.try_divide(high, rest))).alias("_a1"),
        F.min(F.when(~own, low / F.col("_n"))).alias("_b0"), F.min(F.when(~own, high / F.col("_n"))).alias("_b1"),
    )
    value = lambda a, b: F.when(F.col("_n") <= 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col(b) - F.col(a), F.greatest(a, b)), F.lit(0.0)))
    # the silhouette falls with a and rises with b
    ends = ab.select("_w", value("_a1", "_b0").alias("s0"), value("_a0", "_b1").alias("s1"))
    mean = lambda c: F.sum(c * F.col("_w")) / F.sum("_w")
    return ends.agg(mean((F.col("s0") + F.col("s1")) / 2).alias("silhouette"), mean((F.col("s1") - F.col("s0")) / 2).alias("error"))
