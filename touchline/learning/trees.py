"""Trees from histograms: regression and classification trees, random forests and boosted trees, as MLlib defines them.

The features are cut into bins once, and the rows are staged as blocks of bytes, one
byte for a number and one for all slots of an encoded category. One job a level gives
each open node of all trees the counts and sums of its bins (of a classification tree
the counts of each class): tasks pass on their part of each node, and the tasks after
the shuffle choose the best split. Only the splits
reach the driver. The models of all folds grow in the same jobs, and a tree grown to
the greatest depth holds the shallower ones of its grid.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import drop_stages, stage

#: Rows that the cuts between bins are taken from, as many as MLlib takes.
CUT_ROWS = 10_000
#: Rows of a block, and of a task where the cluster has fewer cores.
BLOCK_ROWS = 50_000
TASK_ROWS = 1_000_000
LEAST_ROWS = 30_000
# Fixed value: the chances of 0, 1, 2, ... draws of a row in a bootstrap sample, as a table over 16 bits.
_CHANCES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
DRAWS = np.searchsorted(_CHANCES, (np.arange(65536) + 0.5) / 65536).astype(np.float64)


@dataclass
class Column:
    """One column of bins: a number with its cuts, or the slots of one encoded category (the bin after them: none)."""

    start: int
    slots: int
    cuts: np.ndarray | None

    @property
    def bins(self) -> int:
        return self.slots + 1 if self.cuts is None else len(self.cuts) + 1


def cuts_of(values: np.ndarray, most: int) -> np.ndarray:
    """Cuts between the bins of a sampled number: between all values if they are few, else by equal counts."""
    at, n = np.unique(values + 0.0, return_counts=True)
    if len(at) <= 1:
        return np.zeros(0)
    if len(at) <= most:
        return (at[:-1] + at[1:]) / 2
    stride, cuts, seen = len(values) / most, [], n[0]
    target = stride
    for i in range(1, len(at)):
        before, seen = seen, seen + n[i]
        # the cut goes where the count comes closest to the next multiple of the stride
        if abs(before - target) < abs(seen - target):
            cuts.append((at[i - 1] + at[i]) / 2)
            target += stride
    return np.array(cuts[: most - 1])


def columns_of(sample: np.ndarray, groups: Sequence[int], most: int, indexed: bool = False) -> list[Column]:
    """Columns of a table whose first slots are numbers, then groups of encoded categories of the given sizes.

    An `indexed` table has the number of its slot in place of each group.
    """
    numbers = sample.shape[1] - (len(groups) if indexed else sum(groups))
    out = [Column(j, 1, cuts_of(sample[:, j], min(most, max(2, len(sample))))) for j in range(numbers)]
    at = numbers
    for size in groups:
        out.append(Column(at, size, None))
        at += size
    return out


def binned(x: np.ndarray, columns: Sequence[Column], indexed: bool = False) -> np.ndarray:
    out = np.zeros((len(columns), len(x)), np.uint8 if max(c.bins for c in columns) <= 256 else np.uint16)
    for i, c in enumerate(columns):
        if c.cuts is not None:
            out[i] = np.searchsorted(c.cuts, x[:, c.start])
        elif indexed:
            out[i] = np.minimum(x[:, i], c.slots)
        elif c.slots:
            part = x[:, c.start : c.start + c.slots]
            out[i] = np.where(part.any(1), part.argmax(1), c.slots)
    return out


@dataclass
class Trees:
    """Trees in heap order, root 1: the column and the bin or slot that divide a node (column -1: a leaf), and its mean.

    The mean of a classification tree is the share of each class.
    """

    columns: Sequence[Column]
    depth: int
    column: np.ndarray
    cut: np.ndarray
    mean: np.ndarray
    count: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, columns: Sequence[Column], trees: int, depth: int, classes: int = 0) -> Trees:
        size = (trees, 2 << depth)
        mean = np.zeros((*size, classes) if classes else size)
        return cls(columns, depth, np.full(size, -1, np.int16), np.zeros(size, np.int32), mean, np.zeros(size), np.zeros(size))

    @property
    def classes(self) -> int:
        return self.mean.shape[2] if self.mean.ndim == 3 else 0

    def reach(self, tree: int, x: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row at the given depth, or its leaf above."""
        rows = x.shape[1]
        column, cut, leaf = self.column[tree], self.cut[tree], self.column[tree] < 0
        encoded = np.array([c.cuts is None for c in self.columns])[column] & ~leaf
        # a row goes right if its bin is above one end and not above the other
        low = np.where(leaf, 1 << 20, np.where(encoded, cut - 1, cut)).astype(np.int32)
        high = np.where(encoded, cut, 1 << 20).astype(np.int32)
        first = np.where(leaf, np.arange(len(leaf)), 2 * np.arange(len(leaf))).astype(np.int32)
        start, flat, own = np.maximum(column, 0).astype(np.int64) * rows, x.ravel(), np.arange(rows)
        node = np.ones(rows, np.int32)
        for _ in range(depth):
            value = flat.take(start.take(node) + own)
            node = first.take(node) + ((value > low.take(node)) & (value <= high.take(node)))
        return node

    def predict(self, x: np.ndarray, weights: np.ndarray, depth: int | None = None) -> np.ndarray:
        most = self.depth if depth is None else depth
        return sum((w * self.mean[t][self.reach(t, x, most)] for t, w in enumerate(weights)), np.zeros((x.shape[1], *self.mean.shape[2:])))


@dataclass
class TreeModel:
    """A fitted model: weighted trees, used to the given depth."""

    trees: Trees
    weights: np.ndarray
    depth: int
    width: int
    most: int
    each: bool = True

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.trees.predict(x, self.weights, self.depth)

    @property
    def featureImportances(self) -> SparseVector:  # noqa: N802 - the name of MLlib's models
        """Gain times rows of the splits by slot; with `each`, every tree counts the same."""
        t, total = self.trees, np.zeros(self.width)
        for i in range(len(t.column)):
            own = np.zeros(self.width)
            for node in np.flatnonzero(t.column[i][: 1 << self.depth] >= 0):
                c = t.columns[t.column[i][node]]
                own[c.start + (0 if c.cuts is not None else t.cut[i][node])] += t.gain[i][node]
            total += own / own.sum() if self.each and own.sum() > 0 else own
        total = total / total.sum() if total.sum() > 0 else total
        return Vectors.sparse(self.width, [(i, float(v)) for i, v in enumerate(total) if v])


@dataclass
class Blocks:
    """Staged rows: each record holds some thousands of rows as bytes, binned in each of the given ways."""

    df: DataFrame
    ways: dict[int, list[Column]]
    width: int
    rows: int


_BLOCK = "base long, n long, label binary, fold binary, score binary, "


def _read(batch: pa.RecordBatch, ways: dict[int, list[Column]]) -> Iterator[tuple[dict[int, np.ndarray], np.ndarray, np.ndarray, np.ndarray, int]]:
    for i in range(batch.num_rows):
        get = lambda name: batch.column(name)[i].as_py()  # noqa: E731, B023
        n = get("n")
        x = {}
        for most, columns in ways.items():
            kind = np.uint8 if max(c.bins for c in columns) <= 256 else np.uint16
            x[most] = np.frombuffer(get(f"x{most}"), kind).reshape(len(columns), n)
        yield x, np.frombuffer(get("label")), np.frombuffer(get("fold"), np.uint8), np.frombuffer(get("score")), get("base")


def _inputs(df: DataFrame):
    """The inputs of each row as an array: those in a column x, with an index for each category, or the slots of the features."""
    return F.col("x") if "x" in df.columns else vector_to_array("features").alias("x")


def ways_of(df: DataFrame, groups: Sequence[int], mosts: Sequence[int], rows: int) -> dict[int, list[Column]]:
    """The columns for each greatest number of bins, their cuts from a sample of the rows (all, if few)."""
    width, indexed = df.schema["features"].metadata["ml_attr"]["num_attrs"], "x" in df.columns
    width = width - sum(groups) + len(groups) if indexed else width
    wanted = max(CUT_ROWS, max(m * m for m in mosts))
    draw = F.pmod(F.xxhash64(_inputs(df), "label", F.monotonically_increasing_id()), F.lit(1 << 40))
    some = df if rows <= wanted else df.where(draw < math.ceil(wanted / rows * (1 << 40)))
    x = some.select(_inputs(df)).toArrow().column("x").combine_chunks()
    sample = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width) if len(x) else np.zeros((0, width))
    return {m: columns_of(sample, groups, min(m, max(2, rows)), indexed) for m in mosts}


def blocks(df: DataFrame, ways: dict[int, list[Column]], width: int, rows: int) -> Blocks:
    """Rows (features, label, fold) as staged blocks."""
    fields, indexed = _BLOCK + ", ".join(f"x{m} binary" for m in ways), "x" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            out = {
                "base": t.column("id")[0].as_py(), "n": t.num_rows, "label": t.column("label").to_numpy().tobytes(),
                "fold": t.column("fold").to_numpy().astype(np.uint8).tobytes(), "score": np.zeros(t.num_rows).tobytes(),
            }
            out |= {f"x{m}": binned(x, columns, indexed).tobytes() for m, columns in ways.items()}
            held.clear()
            kinds = {"base": pa.int64(), "n": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in out.items()], names=list(out))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block()
        if held:
            yield block()

    some = df.select(_inputs(df), "label", F.col("fold").cast("int").alias("fold"), F.monotonically_increasing_id().alias("id"))
    return Blocks(stage(some.mapInArrow(run, fields), "blocks"), ways, width, rows)


@dataclass
class Growing:
    """A model in growth: how its rows are binned, the fold that it leaves out (-1: none), the features that a node looks at."""

    most: int
    left_out: int
    trees: Trees
    looked_at: int
    bootstrap: bool
    seed: int
    done: np.ndarray = None

    def looks(self, tree: int, nodes: np.ndarray, width: int) -> np.ndarray:
        """Which slots each node looks at."""
        out = np.ones((len(nodes), width), bool)
        if self.looked_at < width:
            out[:] = False
            for i, node in enumerate(nodes.tolist()):
                out[i, np.random.default_rng([self.seed % (1 << 32), tree, node]).permutation(width)[: self.looked_at]] = True
        return out


def _drawn(base: int, n: int, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the bootstrap sample of a tree: a hash of its number, the same in every pass."""
    with np.errstate(over="ignore"):
        z = np.arange(n, dtype=np.uint64) + np.uint64(base) + np.uint64((seed * 1_000_003 + tree + 1) % (1 << 32)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return DRAWS[(z >> np.uint64(48)).astype(np.int64)]


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of numbers as bytes."""
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


_SPLIT = "model int, tree int, node int, slot int, col int, cut int, gain double, n double, mean array<double>, n_right double, mean_right array<double>"


def _level(data: Blocks, models: Sequence[Growing], level: int, target: Callable, tasks: int) -> list:
    """The best split of each open node of a level, in one job."""
    ways, width = data.ways, data.width

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows of a task are few bytes each; the sums of all trees together are many
        held = []
        for batch in batches:
            for x, label, fold, score, base in _read(batch, ways):
                held.append((x, target(x, label, score), fold, base))
        for m, model in enumerate(models):
            used = [np.flatnonzero(fold != model.left_out) if model.left_out >= 0 else slice(None) for _, _, fold, _ in held]
            seen = [(np.ascontiguousarray(x[model.most][:, u]), y[u]) for (x, y, _, _), u in zip(held, used, strict=True)]
            for t in range(len(model.trees.column)):
                classes = model.trees.classes
                sums = [np.zeros((c.bins << level, 1 + max(1, classes))) for c in model.trees.columns]
                for (x, y), (_, _, fold, base), u in zip(seen, held, used, strict=True):
                    node = model.trees.reach(t, x, level)
                    opened = ~model.done[t].take(node)
                    w = _drawn(base, len(fold), t, model.seed)[u] if model.bootstrap else None
                    at = np.flatnonzero(opened if w is None else opened & (w > 0))
                    place = (node[at] - (1 << level)).astype(np.int64)
                    weight = None if w is None else w[at]
                    wy = y[at].astype(np.int64) if classes else y[at] if w is None else weight * y[at]
                    for c, column in enumerate(model.trees.columns):
                        cell = place * column.bins + x[c].take(at)
                        if classes:
                            counts = np.bincount(cell * classes + wy, weight, (column.bins << level) * classes).reshape(-1, classes)
                            sums[c][:, 0] += counts.sum(1)
                            sums[c][:, 1:] += counts
                            continue
                        sums[c][:, 0] += np.bincount(cell, weight, column.bins << level)
                        sums[c][:, 1] += np.bincount(cell, wy, column.bins << level)
                filled = np.flatnonzero(sums[0][:, 0].reshape(1 << level, -1).sum(1) > 0)
                look = model.looks(t, filled + (1 << level), width)
                for c, column in enumerate(model.trees.columns):
                    nodes = filled[look[:, column.start : column.start + column.slots].any(1)]
                    if len(nodes):
                        same = lambda v: pa.array(np.full(len(nodes), v, np.int32))  # noqa: E731, B023
                        yield pa.RecordBatch.from_arrays(
                            [same(m), same(t), pa.array((nodes + (1 << level)).astype(np.int32)), same(c), _binary(sums[c].reshape(1 << level, -1)[nodes])],
                            names=["model", "tree", "node", "col", "hist"],
                        )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in ("model", "tree", "node", "col")), strict=True)
            for key, hist in zip(keys, batch.column("hist"), strict=True):
                part = np.frombuffer(hist.as_buffer())
                sums[key] = sums[key] + part if key in sums else part
        found: dict[tuple[int, int, int], tuple] = {}
        for (m, t, node, c), part in sorted(sums.items()):
            model = models[m]
            column = model.trees.columns[c]
            part = part.reshape(-1, 1 + max(1, model.trees.classes))
            n, s = part[:, 0], part[:, 1:]
            n_all, s_all = n.sum(), s.sum(0)
            if column.cuts is None:
                n_right, s_right = n[:-1], s[:-1]
                slots = np.arange(column.start, column.start + column.slots)
                look = model.looks(t, np.array([node]), width)[0, slots]
            else:
                n_right, s_right = n_all - n.cumsum()[:-1], s_all - s.cumsum(0)[:-1]
                look = np.ones(len(n_right), bool)
            n_left, s_left = n_all - n_right, s_all - s_right
            with np.errstate(divide="ignore", invalid="ignore"):
                # less variance, or less Gini impurity, which is the variance of all classes' marks
                whole = float((s_all**2).sum() / n_all)
                gain = (s_left**2).sum(1) / n_left + (s_right**2).sum(1) / n_right - whole
            gain = np.where(look & (n_left > 0.5) & (n_right > 0.5), gain, -1.0)
            i = int(gain.argmax()) if len(gain) else -1
            key = (m, t, node)
            value = float(gain[i]) if i >= 0 else -1.0
            if value <= 1e-12 * max(1.0, whole):
                value = -1.0
            if key not in found or value > found[key][2]:
                right = (float(n_right[i]), (s_right[i] / n_right[i]).tolist()) if value > 0 else (0.0, [])
                slot = column.start + (i if column.cuts is None else 0)
                found[key] = (slot if value > 0 else -1, (c, i), value, float(n_all), (s_all / n_all).tolist(), *right)
        if found:
            rows = [(*key, v[0], *v[1], *v[2:]) for key, v in found.items()]
            kinds = [pa.int32()] * 6 + [pa.float64()] * 2 + [pa.list_(pa.float64()), pa.float64(), pa.list_(pa.float64())]
            names = [f.split()[0] for f in _SPLIT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    hists = data.df.mapInArrow(parts, "model int, tree int, node int, col int, hist binary")
    return hists.repartition(tasks, "model", "tree", "node").mapInArrow(best, _SPLIT).collect()


def grow(data: Blocks, models: Sequence[Growing], depth: int, target: Callable = lambda x, label, score: label) -> None:
    """Grow the models level by level; `target` gives what the trees predict from the bins, labels and staged scores."""
    spark = data.df.sparkSession
    for model in models:
        model.done = np.zeros(model.trees.column.shape, bool)  # nodes that no level looks at any more
    for level in range(depth):
        open_nodes = sum(int((~m.done[:, 1 << level : 2 << level]).sum()) for m in models)
        tasks = max(1, min(spark.sparkContext.defaultParallelism, open_nodes // 16))
        found = _level(data, models, level, target, tasks)
        for model in models:
            model.done[:, : 4 << level] = True
        for r in found:
            t, tree, node = models[r["model"]].trees, r["tree"], r["node"]
            shape, whole = t.mean.shape[2:], np.array(r["mean"])
            if level == 0:
                t.mean[tree, node], t.count[tree, node] = whole.reshape(shape), r["n"]
            if r["slot"] < 0:
                continue
            t.column[tree, node], t.cut[tree, node], t.gain[tree, node] = r["col"], r["cut"], r["gain"]
            n, right = r["n"], r["n_right"]
            right_mean = np.array(r["mean_right"])
            left_mean = (n * whole - right * right_mean) / (n - right)
            for child, rows, mean in ((2 * node, n - right, left_mean), (2 * node + 1, right, right_mean)):
                t.count[tree, child], t.mean[tree, child] = rows, mean.reshape(shape)
                models[r["model"]].done[tree, child] = False
        if not any(r["slot"] >= 0 for r in found):
            break


def errors(data: Blocks, models: Sequence[tuple[int, int, TreeModel]]) -> np.ndarray:
    """Of each (bins, fold scored or -1, model): rows, sums of squared and absolute errors, of labels less their first, squared too."""
    ways = data.ways

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, label, fold, _, _ in _read(batch, ways):
                rows = []
                for i, (most, scored, model) in enumerate(models):
                    used = np.flatnonzero(fold == scored) if scored >= 0 else slice(None)
                    y = label[used]
                    e = y - model.predict(x[most][:, used])
                    rows.append((i, float(len(y)), float(e @ e), float(np.abs(e).sum()), float(y.sum()), float(y @ y)))
                names = ["model", "n", "sse", "sae", "y", "yy"]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == 0 else pa.float64()) for k, v in enumerate(zip(*rows, strict=True))], names=names)

    sums = data.df.mapInArrow(run, "model int, n double, sse double, sae double, y double, yy double").groupBy("model")
    out = np.zeros((len(models), 5))
    for r in sums.agg(*[F.sum(c).alias(c) for c in ("n", "sse", "sae", "y", "yy")]).collect():
        out[r["model"]] = r[1:]
    return out


def metrics_of(sums: np.ndarray) -> dict[str, float]:
    n, sse, sae, y, yy = (float(v) for v in sums)
    if not n:
        return dict.fromkeys(("rmse", "mae", "r2"), float("nan"))
    spread = yy - y * y / n
    return {"rmse": math.sqrt(sse / n), "mae": sae / n, "r2": 1 - sse / spread if spread > 0 else float("nan")}


def fit_grid(data: Blocks, grid: Sequence[tuple[int, int]], trees: int, folds: int, seed: int) -> TreeModel:
    """The tree (`trees` 1) or forest of the best (depth, bins) by cross-validated RMSE, on all rows."""
    looked_at = data.width if trees == 1 else max(1, math.ceil(data.width / 3))

    def growing(most: int, left_out: int, depth: int) -> Growing:
        return Growing(most, left_out, Trees.empty(data.ways[most], trees, depth), looked_at, trees > 1, seed)

    weights = np.full(trees, 1 / trees)
    best = 0
    if len(grid) > 1:
        deepest = max(d for d, _ in grid)
        models = [growing(most, fold, deepest) for most in sorted({m for _, m in grid}) for fold in range(folds)]
        grow(data, models, deepest)
        asked = [(m.most, m.left_out, TreeModel(m.trees, weights, d, data.width, most)) for d, most in grid for m in models if m.most == most]
        sums = errors(data, asked).reshape(len(grid), folds, 5)
        with np.errstate(divide="ignore", invalid="ignore"):
            best = int(np.argmin(np.nanmean(np.sqrt(sums[:, :, 1] / sums[:, :, 0]), axis=1)))
    depth, most = grid[best]
    model = growing(most, -1, depth)
    grow(data, [model], depth)
    return TreeModel(model.trees, weights, depth, data.width, most)


def fit_classes(data: Blocks, classes: int, depth: int, most: int, trees: int, seed: int) -> TreeModel:
    """The classification tree (`trees` 1) or forest on all rows, whose labels number the classes."""
    looked_at = data.width if trees == 1 else max(1, math.ceil(math.sqrt(data.width)))
    model = Growing(most, -1, Trees.empty(data.ways[most], trees, depth, classes), looked_at, trees > 1, seed)
    grow(data, [model], depth)
    return TreeModel(model.trees, np.full(trees, 1 / trees), depth, data.width, most)


def confusions(data: Blocks, models: Sequence[TreeModel]) -> list[dict[tuple[float, float], int]]:
    """Of each classification model: the rows of each label and class said, in one job for all."""
    ways = data.ways

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, label, _, _, _ in _read(batch, ways):
                for i, model in enumerate(models):
                    pairs, n = np.unique(np.stack([label, model.predict(x[model.most]).argmax(1)]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), i, np.int32)), pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n)], names=["model", "y", "p", "n"])

    out: list[dict] = [{} for _ in models]
    for r in data.df.mapInArrow(run, "model int, y double, p double, n long").groupBy("model", "y", "p").agg(F.sum("n").alias("n")).collect():
        out[r["model"]][r["y"], r["p"]] = r["n"]
    return out


def fit_boosted(data: Blocks, depth: int, most: int, rounds: int, rate: float) -> TreeModel:
    """Boosted trees on squared errors: each tree fits twice the residuals of those before it."""
    columns, fields = data.ways[most], data.df.schema
    whole = Trees.empty(columns, rounds, depth)
    weights = np.array([1.0] + [rate] * (rounds - 1))
    scored, twice = data, lambda x, label, score: 2 * (label - score)
    for i in range(rounds):
        if i:
            # what the trees so far predict is staged with the rows, so that a level looks at one tree only
            scored = Blocks(stage(scored.df.mapInArrow(_scorer(whole, weights, i - 1, i, data.ways, most), fields), "scored"), data.ways, data.width, data.rows)
            drop_stages(data.df.sparkSession, "scored", keep=1)
        model = Growing(most, -1, Trees.empty(columns, 1, depth), data.width, False, 0)
        grow(scored, [model], depth, twice if i else lambda x, label, score: label)
        for name in ("column", "cut", "mean", "count", "gain"):
            getattr(whole, name)[i] = getattr(model.trees, name)[0]
    return TreeModel(whole, weights, depth, data.width, most, each=False)


def _some(trees: Trees, a: int, b: int) -> Trees:
    return Trees(trees.columns, trees.depth, *[getattr(trees, n)[a:b].copy() for n in ("column", "cut", "mean", "count", "gain")])


def _scorer(trees: Trees, weights: np.ndarray, a: int, b: int, ways: dict[int, list[Column]], most: int) -> Callable:
    held, w = _some(trees, a, b), weights[a:b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (x, _, _, score, _) in enumerate(_read(batch, ways)):
                new = (score + held.predict(x[most], w)).tobytes()
                row = batch.slice(i, 1)
                at = row.schema.get_field_index("score")
                yield row.set_column(at, "score", pa.array([new], pa.binary()))

    return run
