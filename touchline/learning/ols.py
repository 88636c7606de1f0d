"""Least squares with many-valued factors absorbed, and the tests of its coefficients.

Factors with many values (clubs) get no columns of their own. By the theorem of
partial regression it is enough to take every other column less what the factors
explain of it, which alternating subtraction of group means finds. Only the effects
of factor values are kept, and how often two of them meet: a sweep costs no rows,
and no row ever holds what is left of its columns. All columns and all labels are
swept together.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.learning.gram import MOST_FEATURES, added, sums_by_group
from touchline.session import drop_stages, stage

#: Sweeps end when no group mean is above this share of its column's deviation.
TOLERANCE = 1e-11
MOST_SWEEPS = 500
#: Levels of a factor whose effects meet in one task, and pairs of levels there.
BLOCK_LEVELS = 32_768
BLOCK_CELLS = 2_000_000

TERMS = "label string, term string, estimate double, std_error double, t_value double, p_value double, n long, freedom long"


# --- the distribution of t ---------------------------------------------------


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(abs(1 - (a + b) * x / (a + 1)), tiny)
    if 1 - (a + b) * x / (a + 1) < 0:
        d = -d
    out = d
    for m in range(1, 10_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def two_sided_p(t: float, freedom: float) -> float:
    """Chance that |T| is at least |t| under Student's distribution."""
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t))


# --- absorbing factors ---------------------------------------------------------


def _columns(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, Column]:
    """Numbers, and an indicator of each value of a category but the least, by name."""
    out = {c: F.col(c).cast("double") for c in numeric}
    for c in categorical:
        levels = sorted(r[0] for r in df.select(c).distinct().limit(MOST_FEATURES + 1).collect())
        if len(levels) > MOST_FEATURES:
            raise ValueError(f"{c} has over {MOST_FEATURES} values: absorb it")
        out |= {f"{c}_{v}": (F.col(c) == F.lit(v)).cast("double") for v in levels[1:]}
    return out


def _components(cells: DataFrame, factors: Sequence[str]) -> int:
    """Sets of factor values that no cell joins; each beyond the first frees one parameter."""
    if len(factors) < 2:
        return 1
    first, second = factors[:2]
    mark = stage(cells.groupBy(first).agg(F.min(F.col(first).cast("string")).alias("_mark")), "marks")
    while True:
        across = cells.join(mark, first).groupBy(second).agg(F.min("_mark").alias("_mark"))
        back = stage(cells.join(across, second).groupBy(first).agg(F.min("_mark").alias("_mark")), "marks")
        moved = mark.join(back.withColumnRenamed("_mark", "_new"), first).where("_new < _mark").limit(1).count()
        mark = back
        if not moved:
            return mark.select("_mark").distinct().count()


def _crossed(pairs: DataFrame, effects: DataFrame, blocks: tuple[int, int, int]) -> DataFrame:
    """Per level `a` the sum of the effects `v` of the levels `b` it meets, as often as they meet.

    Both sides are cut into blocks of levels. A task gets the effects of one block
    and the pairs with levels of one other, so that effects move once for each
    block of `a` and not with every pair.
    """
    rows_of, cols_of, parts = blocks
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = effects.select("b", "v", _block("b", cols_of).alias("_bb"), each(rows_of).alias("_ba")).withColumn("_part", each(parts))
    cut = pairs.select("a", "b", "_n", _block("a", rows_of).alias("_ba"), _block("b", cols_of).alias("_bb"), _block("a", parts, "b").alias("_part"))
    kinds = T.StructType([pairs.schema["a"], T.StructField("values", T.ArrayType(T.DoubleType()))])

    def run(met: pa.Table, known: pa.Table) -> pa.Table:
        if not met.num_rows or not known.num_rows:
            return pa.table({"a": met.column("a").slice(0, 0), "values": pa.array([], pa.list_(pa.float64()))})
        v = known.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(known.num_rows, -1)
        at = pc.index_in(met.column("b"), value_set=known.column("b").combine_chunks()).to_numpy()
        one = met.column("a").combine_chunks().dictionary_encode()
        to, n = one.indices.to_numpy(zero_copy_only=False), met.column("_n").to_numpy().astype(float)
        sums = np.column_stack([np.bincount(to, n * column[at], len(one.dictionary)) for column in np.ascontiguousarray(v.T)])
        values = pa.ListArray.from_arrays(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1], sums.ravel())
        return pa.table({"a": one.dictionary, "values": values})

    keys = ["_ba", "_bb", "_part"]
    return added(cut.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, kinds), ["a"])


def _block(col: str, blocks: int, *more: str) -> Column:
    return F.pmod(F.xxhash64(col, *more), F.lit(blocks)).cast("int")


def _explained(tables: DataFrame, width: int) -> np.ndarray:
    """Sum over levels of what the products of the vectors lose: m e' + e m' less n e e' less e s' + s e', of effects e, sums m and crossed sums s."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width))
        for batch in batches:
            n = batch.column("_n").to_numpy(zero_copy_only=False)
            m, e, s = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for c in ("m", "v", "s"))
            half = e.T @ (m - e * n[:, None] / 2 - s)
            held += half + half.T
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), pa.array(held.tolist(), pa.list_(pa.float64()))], names=["row", "values"])

    out = np.zeros((width, width))
    for r in added(tables.select("_n", "m", "v", "s").mapInArrow(run, "row long, values array<double>"), ["row"]).collect():
        out[r["row"]] = r["values"]
    return out


def _numbers(batch: pa.RecordBatch, col: str) -> np.ndarray:
    return batch.column(col).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _conjugate(start: DataFrame, spread: Callable[[DataFrame], DataFrame], size: np.ndarray, width: int, name: str) -> DataFrame:
    """Conjugate gradients for the effects `x` of one of two factors, each element by its own steps.

    Rows hold a level `a`, its weight, `x`, what is left `r` and the direction `p`;
    `spread` takes the part of a direction that the other factor explains. It needs
    about the root of the sweeps that alternating would. What is left by level, as
    a mean, is the step that alternating would take, and ends it alike.
    """
    lists = T.ArrayType(T.DoubleType())
    kinds = T.StructType([start.schema["a"], T.StructField("_n", T.DoubleType()), *[T.StructField(c, lists) for c in "xrp"]])
    listed = lambda m: pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], m.ravel())
    unit = np.where(size > 0, size, 1.0)

    def totals(table: DataFrame, alpha: np.ndarray | None) -> np.ndarray:
        """Of each task the products of direction and its image; or with steps those of what will be left, and its greatest share."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, most = np.zeros(width), np.zeros(width)
            for batch in batches:
                n, r, q = batch.column("_n").to_numpy(zero_copy_only=False)[:, None], _numbers(batch, "r"), _numbers(batch, "q")
                if alpha is None:
                    held += (_numbers(batch, "p") * q).sum(0)
                else:
                    r = r - alpha * q
                    held += (r * r / n).sum(0)
                    most = np.maximum(most, (np.abs(r / n) / unit).max(0, initial=0.0))
            yield pa.RecordBatch.from_arrays([pa.array([held.tolist()]), pa.array([most.tolist()])], names=["held", "most"])

        found = table.select("_n", "r", "p", "q").mapInArrow(run, "held array<double>, most array<double>").collect()
        return np.array([np.sum([r["held"] for r in found], axis=0), np.max([r["most"] for r in found], axis=0)])

    def stepped(table: DataFrame, alpha: np.ndarray, beta: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, r, p, q = (_numbers(batch, c) for c in "xrpq")
                n = batch.column("_n").to_numpy(zero_copy_only=False)[:, None]
                r = r - alpha * q
                new = [x + alpha * p, r, r / n + beta * p]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("_n"), *map(listed, new)], names=["a", "_n", *"xrp"])

        return table.mapInArrow(run, kinds)

    state, none, before = stage(start, name), F.array_repeat(F.lit(0.0), width), None
    for _ in range(MOST_SWEEPS):
        # a direction's image is its weight less what the other factor explains
        image = F.zip_with(F.transform("p", lambda x: x * F.col("_n")), F.coalesce("values", none), lambda x, y: x - y)
        table = stage(state.join(spread(state), "a", "left").select("a", "_n", "x", "r", "p", image.alias("q")), name)
        drop_stages(table.sparkSession, name, keep=1)
        if before is None:
            before, share = totals(table, np.zeros(width))
            live = share >= TOLERANCE
        curve = totals(table, None)[0]
        alpha = np.divide(before, curve, out=np.zeros(width), where=live & (curve > 0))
        after, share = totals(table, alpha)
        state = stepped(table, alpha, np.divide(after, before, out=np.zeros(width), where=live & (before > 0)))
        before, live = after, live & (share >= TOLERANCE) & (curve > 0)
        if not live.any():
            break
    return state


@dataclass
class Absorbed:
    """Effects `v` of the levels of each factor, the products that they explain, and the parameters that they took."""

    effects: list[DataFrame]
    explained: np.ndarray
    parameters: int


def absorbed(rows: DataFrame, factors: Sequence[str], columns: Sequence[Column], size: np.ndarray) -> Absorbed:
    """What the factors explain of the columns, whose means must be 0 and whose sizes set the scale of the tolerance.

    Rows with a NULL among them must be gone. A sweep takes the effects of each
    factor in turn as the means of what the others leave. They follow from the
    means of the columns per level and from how often two levels meet, so neither
    rows nor cells carry columns through a sweep. One factor needs one sweep; two
    are solved by conjugate gradients, as sweeps can be slow to settle.
    """
    spark, width, name = rows.sparkSession, len(columns), f"effects-{uuid.uuid4().hex[:8]}"
    if not factors:
        return Absorbed([], np.zeros((width, width)), 1)
    sums, pairs, blocks = [], {}, {}
    for f in factors:
        one = rows.groupBy(F.col(f).alias("a")).agg(F.count("*").cast("double").alias("_n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)])
        sums.append(stage(one.select("a", "_n", F.array(*[f"s{i}" for i in range(width)]).alias("m")), "levels"))
    levels = [s.count() for s in sums]
    cut = [max(1, math.ceil(n / BLOCK_LEVELS)) for n in levels]
    for k, f in enumerate(factors):
        for j, g in enumerate(factors[:k]):
            met = stage(rows.groupBy(F.col(f).alias("a"), F.col(g).alias("b")).agg(F.count("*").alias("_n")), "cells")
            parts = max(1, math.ceil(met.count() / (cut[k] * cut[j] * BLOCK_CELLS)))
            pairs[k, j], pairs[j, k] = met, met.select(F.col("b").alias("a"), F.col("a").alias("b"), "_n")
            blocks[k, j], blocks[j, k] = (cut[k], cut[j], parts), (cut[j], cut[k], parts)
    as_b = lambda table: table.select(F.col("a").alias("b"), "v")
    none = F.array_repeat(F.lit(0.0), width)
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    units = F.array(*[F.lit(float(x) or 1.0) for x in size])

    def crossed(k: int, others: Sequence[int], effects: dict[int, DataFrame]) -> DataFrame:
        """The sums of a factor with those of the effects that other factors have in its levels, as `s`."""
        out = sums[k].withColumn("s", none)
        for j in others:
            found = _crossed(pairs[k, j], as_b(effects[j]), blocks[k, j])
            out = out.join(found, "a", "left").select("a", "_n", "m", plus("s", F.coalesce("values", none)).alias("s"))
        return out

    effects: dict[int, DataFrame] = {}
    shared = lambda table: table.select("a", F.transform("m", lambda x: x / F.col("_n")).alias("v"))
    remain = lambda left: left.select("a", "_n", F.zip_with("m", "s", lambda m, s: m - s).alias("m"))
    if len(factors) == 2:
        start = remain(crossed(1, [0], {0: shared(sums[0])})).select("a", "_n", none.alias("x"), F.col("m").alias("r"), F.transform("m", lambda x: x / F.col("_n")).alias("p"))
        spread = lambda p: _crossed(pairs[0, 1], as_b(p.select("a", F.col("p").alias("v"))), blocks[0, 1])
        back = lambda p: spread(p).join(sums[0].select("a", "_n"), "a").select("a", F.transform("values", lambda x: x / F.col("_n")).alias("v"))
        solved = _conjugate(start, lambda p: _crossed(pairs[1, 0], as_b(back(p)), blocks[1, 0]), size, width, name)
        effects[1] = stage(solved.select("a", F.col("x").alias("v")), "effects")
        effects[0] = stage(shared(remain(crossed(0, [1], effects))), "effects")
        drop_stages(spark, name)
    for _ in range(0 if len(factors) == 2 else MOST_SWEEPS):
        worst = 0.0
        for k in range(len(factors)):
            left = crossed(k, [j for j in effects if j != k], effects)
            new = left.select("a", F.transform(F.zip_with("m", "s", lambda m, s: m - s), lambda x: x / F.col("_n")).alias("v"))
            before = effects[k].select("a", F.col("v").alias("_v")) if k in effects else sums[k].select("a", none.alias("_v"))
            moved = F.zip_with(F.zip_with("v", "_v", lambda x, y: F.abs(x - y)), units, lambda d, u: d / u)
            new = stage(new.join(before, "a").select("a", "v", F.array_max(moved).alias("_moved")), name)
            worst = max(worst, new.agg(F.max("_moved")).first()[0] or 0.0) if k else 0.0
            effects[k] = new
            drop_stages(spark, name, keep=len(factors))
        if len(factors) == 1 or worst < TOLERANCE:
            break
    explained = np.zeros((width, width))
    for k in range(len(factors)):
        explained += _explained(crossed(k, range(k), effects).join(effects[k], "a"), width)
    cells = pairs[1, 0].select(F.col("b").alias("f0"), F.col("a").alias("f1")) if len(factors) == 2 else None
    parameters = sum(levels) - (_components(cells, ["f0", "f1"]) if len(factors) == 2 else 0) - max(0, len(factors) - 2)
    return Absorbed([effects[k] for k in range(len(factors))], explained, parameters)


@dataclass
class Regression:
    """Coefficient tables of all labels, and the rows with fit and residual of each."""

    terms: DataFrame
    rows: DataFrame


def _kept(gram: np.ndarray, size: np.ndarray) -> list[int]:
    """Columns that the earlier ones and the factors don't determine, in order."""
    left, kept = gram.copy(), []
    for j in range(len(gram)):
        if left[j, j] <= 1e-10 * max(size[j], 1e-300):
            continue
        kept.append(j)
        left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return kept


def absorbed_least_squares(
    df: DataFrame, labels: Sequence[str], numeric: Sequence[str], categorical: Sequence[str] = (), absorb: Sequence[str] = (), keep: Sequence[str] = ()
) -> Regression:
    """Ordinary least squares of each label, with standard error, t and two-sided p of each coefficient.

    Rows with any NULL are left out, as is usual for this table. Categories become
    indicators of all values but the least, `absorb` names the factors without
    columns. A column that others determine has no estimate. `keep` names columns
    that identify the rows of fits and residuals.
    """
    used = df.select(*dict.fromkeys([*numeric, *categorical, *absorb, *labels, *keep])).na.drop("any", subset=[*numeric, *categorical, *absorb, *labels])
    used = stage(used, "regression")
    columns = _columns(used, numeric, categorical)
    p, spark, table, betas = len(columns), df.sparkSession, [], {}
    vector = [*columns.values(), *[F.col(c).cast("double") for c in labels]]
    raw = sums_by_group(used.select(F.array(*vector).alias("v")), None, F.lit(0), 1, "v")
    n = int(raw.total[0, 0]) if raw.total.size else 0
    if not n:
        terms = spark.createDataFrame([], TERMS)
        return Regression(terms, used.select(*keep, F.lit("").alias("label"), F.lit(0.0).alias("residual")).where("false"))
    # means of 0, so that the products lose no digits; a constant is absorbed in any case
    mean = raw.total[0, 1:] / n
    whole = (raw.total[1:, 1:] - n * np.outer(mean, mean))[:-1, :-1]
    second = np.diag(raw.total)[1:-1] + n * raw.origin[:-1] ** 2
    centred = [c - F.lit(float(o + m)) for c, o, m in zip(vector, raw.origin, mean, strict=False)]
    taken = absorbed(used, list(absorb), centred, np.sqrt(second / n))
    product = whole - taken.explained
    gram = product[:p, :p]
    kept = _kept(gram, second[:p])
    unit = np.sqrt(np.diag(gram)[kept])
    inverse = np.linalg.inv(gram[np.ix_(kept, kept)] / np.outer(unit, unit)) / np.outer(unit, unit) if kept else np.zeros((0, 0))
    freedom = n - len(kept) - taken.parameters
    for i, label in enumerate(labels):
        y = p + i
        beta = inverse @ product[kept, y]
        error = max(0.0, product[y, y] - product[kept, y] @ beta)
        variance = error / freedom if freedom > 0 else float("nan")
        found = dict(zip(kept, zip(beta, np.sqrt(variance * np.diag(inverse)), strict=True), strict=True))
        for j, term in enumerate(columns):
            if j in found:
                b, se = (float(v) for v in found[j])
                t = b / se if se > 0 else float("nan")
                table.append((label, term, b, se, t, two_sided_p(t, freedom) if t == t else float("nan"), n, freedom))
            else:
                table.append((label, term, None, None, None, None, n, freedom))
        betas[label] = [(j, float(b)) for j, b in zip(kept, beta, strict=True)]
    terms = spark.createDataFrame(table, TERMS)
    # a residual is the label less its fit, less the same of the effects; of those one number a label moves, and no columns
    less = lambda at, i, label: sum((at(j) * F.lit(-b) for j, b in betas[label]), at(p + i))
    rest = [less(lambda j: centred[j], i, c) for i, c in enumerate(labels)]
    rows = used.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], *[F.col(c).alias(f"f{i}") for i, c in enumerate(absorb)], *[r.alias(f"r{i}") for i, r in enumerate(rest)])
    for k, effects in enumerate(taken.effects):
        own = effects.select(F.col("a").alias(f"f{k}"), *[less(lambda j: F.col("v")[j], i, c).alias(f"e{i}") for i, c in enumerate(labels)])
        rows = rows.join(own, f"f{k}").withColumns({f"r{i}": F.col(f"r{i}") - F.col(f"e{i}") for i in range(len(labels))}).drop(*[f"e{i}" for i in range(len(labels))])
    each = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"r{i}").alias("residual")) for i, c in enumerate(labels)])
    return Regression(terms, rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.inline(each)))
