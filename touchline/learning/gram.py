"""Linear models from sufficient statistics.

One scan gives the sums of products of (1, features, label) of each group of rows;
groups are folds, or folds within nested samples. Every penalty, fold and sample is
then solved and scored from those sums, without another look at the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The widest feature vector that the sums are kept for.
MOST_FEATURES = 4096
#: Rows that the origin of the sums is taken from; any origin gives the same models.
ORIGIN_ROWS = 1000
MERGE_FAN_IN = 256


def added(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Element by element sum of `values` per key."""
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    listed = df.groupBy(*keys).agg(F.collect_list("values").alias("_all"))
    first, rest = F.col("_all")[0], F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0)))
    return listed.select(*keys, F.aggregate(rest, first, plus).alias("values"))


def _matrices(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


@dataclass
class Sums:
    """Sums of products by group, of (1, features, label) less an origin."""

    origin: np.ndarray
    groups: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return self.groups.sum(0)


def sums_by_group(df: DataFrame, label: str | None, group: Column, groups: int, features: str = "features") -> Sums:
    """The sums of each group number from 0; `features` is a vector or an array. Rows without a label don't count.

    With no label the last column of the sums is that of zeros.
    """
    kind = df.schema[features].dataType.typeName()
    x = F.col(features) if kind == "array" else vector_to_array(features)
    y = F.lit(0.0) if label is None else F.col(label).cast("double")
    rows = df.where(y.isNotNull()).select(group.cast("long").alias("group"), F.concat(x, F.array(y)).alias("x"))
    some = rows.select("x").limit(ORIGIN_ROWS).toArrow().column("x").combine_chunks()
    if not len(some):
        return Sums(np.zeros(0), np.zeros((groups, 0, 0)))
    width = len(some[0])
    if width - 1 > MOST_FEATURES:
        raise ValueError(f"{width - 1} features; sums are kept for at most {MOST_FEATURES}")
    origin = some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), width).mean(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            moved = np.hstack([np.ones((batch.num_rows, 1)), _matrices(batch, width) - origin])
            of = batch.column("group").to_numpy()
            for g in np.unique(of).tolist():
                part = moved[of == g]
                held[g] = held.get(g, 0) + part.T @ part
        for g, m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * len(m)), pa.array(range(len(m)), pa.int64()), pa.array(m.tolist(), pa.list_(pa.float64()))], names=["group", "row", "values"]
            )

    parts = rows.mapInArrow(run, "group long, row long, values array<double>")
    some_tasks = F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN_IN)).alias("part")
    merged = added(added(parts.select("*", some_tasks), ["group", "row", "part"]), ["group", "row"])
    out = np.zeros((groups, width + 1, width + 1))
    for r in merged.collect():
        out[r["group"], r["row"]] = r["values"]
    return Sums(origin, out)


@dataclass
class Fit:
    """Coefficients in the units of the features, and the intercept."""

    coefficients: np.ndarray
    intercept: float

    def rmse(self, sums: np.ndarray, origin: np.ndarray) -> float:
        moved = self.intercept - origin[-1] + self.coefficients @ origin[:-1]
        c = np.concatenate([[-moved], -self.coefficients, [1.0]])
        return float(np.sqrt(max(0.0, c @ sums @ c) / sums[0, 0])) if sums[0, 0] else float("nan")


def solve(sums: np.ndarray, origin: np.ndarray, penalty: float = 0.0, mixing: float = 0.0, tol: float = 1e-12, most: int = 10_000) -> Fit:
    """Elastic net over features scaled to unit deviation: `mixing` 0 is ridge, 1 is lasso.

    The penalty is on the scale of the label's deviation, as MLlib's is: the squares
    count `penalty` less the share `mixing`, divided by that deviation. A feature
    without spread gets 0. Ridge is solved at once, others by coordinate descent.
    """
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(cov), 0))
    size = np.sqrt(np.maximum(np.diag(sums)[1:] / n, 0)) + np.abs(origin)
    live = dev[:-1] > 1e-10 * np.maximum(size[:-1], 1e-300)
    beta = np.zeros(len(live))
    if live.any() and dev[-1] > 0:
        unit = dev[:-1][live]
        r = cov[:-1, :-1][np.ix_(live, live)] / np.outer(unit, unit)
        target = cov[:-1, -1][live] / unit
        square, absolute = penalty * (1 - mixing) / dev[-1], penalty * mixing
        if absolute == 0:
            b = np.linalg.lstsq(r + square * np.eye(len(r)), target, rcond=1e-12)[0]
        else:
            b, diagonal = np.zeros(len(r)), np.diag(r)
            for _ in range(most):
                change = 0.0
                for j in range(len(r)):
                    pull = target[j] - r[j] @ b + diagonal[j] * b[j]
                    new = np.sign(pull) * max(abs(pull) - absolute, 0.0) / (diagonal[j] + square)
                    change, b[j] = max(change, abs(new - b[j])), new
                if change <= tol * max(1e-300, np.abs(target).max()):
                    break
        beta[live] = b / unit
    return Fit(beta, float(mean[-1] + origin[-1] - beta @ (mean[:-1] + origin[:-1])))


def cross_validated(sums: Sums, grid: Sequence[tuple[float, float]]) -> tuple[list[tuple], tuple[float, float]]:
    """Every (penalty, mixing) on every fold left out: rows (penalty, mixing, fold, rows, rmse), and the best by mean RMSE."""
    rows, means = [], []
    for penalty, mixing in grid:
        scores = []
        for fold, left_out in enumerate(sums.groups):
            if not left_out[0, 0] or not (sums.total - left_out)[0, 0]:
                continue
            fit = solve(sums.total - left_out, sums.origin, penalty, mixing)
            scores.append(fit.rmse(left_out, sums.origin))
            rows.append((float(penalty), float(mixing), fold, int(left_out[0, 0]), scores[-1]))
        means.append(float(np.mean(scores)) if scores else float("inf"))
    return rows, tuple(grid[int(np.argmin(means))])


def fold_of(folds: int, *ids: Column) -> Column:
    """Fold number by a hash of the ids, the same on any partitioning."""
    return F.pmod(F.xxhash64(*ids), F.lit(folds).cast("long")).cast("int")


def linear_search(
    df: DataFrame, label: str, fold: Column, folds: int, grid: Sequence[tuple[float, float]], features: str = "features"
) -> tuple[DataFrame, Fit, tuple[float, float]]:
    """Cross-validated elastic net in one scan: the scores as a table, the best setting fitted on all rows, and that setting."""
    sums = sums_by_group(df, label, fold, folds, features)
    rows, best = cross_validated(sums, grid)
    table = df.sparkSession.createDataFrame(rows, "penalty double, mixing double, fold int, rows long, rmse double")
    return table, solve(sums.total, sums.origin, *best), best


def predicted(df: DataFrame, fit: Fit, features: str = "features", out: str = "prediction") -> DataFrame:
    kind = df.schema[features].dataType.typeName()
    x = F.col(features) if kind == "array" else vector_to_array(features)
    weights = F.array(*[F.lit(float(c)) for c in fit.coefficients])
    return df.withColumn(out, F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(fit.intercept), lambda a, b: a + b))


def learning_curve(
    df: DataFrame, label: str, draw: Column, fractions: Sequence[float], fold: Column, folds: int,
    grid: Sequence[tuple[float, float]], test: DataFrame, features: str = "features",
) -> list[tuple[float, int, float]]:
    """(fraction, rows, RMSE on the test rows) of the tuned model on nested samples, all from one scan of the rows.

    A row belongs to the samples whose fraction is above its draw in [0, 1), so the
    sums of a sample are those of the one below it and of the rows that it adds.
    """
    fractions = sorted(fractions)
    added = sum(F.when(draw >= f, 1).otherwise(0) for f in fractions)
    sums = sums_by_group(df.where(draw < fractions[-1]), label, added * folds + fold, folds * len(fractions), features)
    parts = sums.groups.reshape(len(fractions), folds, *sums.groups.shape[1:]).cumsum(0)
    scored = sums_by_group(test, label, F.lit(0), 1, features)
    # the test sums have their own origin; a fit is in plain units, so it needs only that one
    out = []
    for fraction, groups in zip(fractions, parts, strict=True):
        nested = Sums(sums.origin, groups)
        rows = int(nested.total[0, 0]) if nested.total.size else 0
        if not rows:
            out.append((fraction, 0, float("nan")))
            continue
        _, best = cross_validated(nested, grid)
        out.append((fraction, rows, solve(nested.total, nested.origin, *best).rmse(scored.total, scored.origin)))
    return out
