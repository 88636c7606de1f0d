"""The numbers behind the exploratory charts, as tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.relational import stable_draw
from touchline.operators.stats import attach, group_percentiles

# Fixed value: two-sided 95 % point of the normal distribution.
Z95 = 1.96
# 16-bit draws from which a Poisson count of mean 1 is at least 1, 2, 3...
POISSON_16 = (24110, 48219, 60274, 64292, 65297, 65498, 65531)
#: Draws of the bootstrap worked out at once in a task.
DRAWS_AT_ONCE = 1_000_000
# Deviations beyond which the normal kernel is left out; its tail there is below 1e-8.
REACH = 6.0


def _binned(df: DataFrame, col: str, bins: int) -> DataFrame:
    ends = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).alias("e"))
    x = F.col(col).cast("double")
    with_ends = df.where(F.col(col).isNotNull()).withColumn("_e", ends.scalar())
    width = (F.col("_e.hi") - F.col("_e.lo")) / F.lit(bins)
    at = F.least(F.coalesce(F.floor(F.try_divide(x - F.col("_e.lo"), width)), F.lit(0)), F.lit(bins - 1))
    return with_ends.withColumn("bin", at.cast("int")).withColumn(
        "bin_start", F.col("_e.lo") + F.col("bin") * width
    ).drop("_e")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins; the last bin includes the maximum."""
    return _binned(df, col, bins).groupBy("bin", "bin_start").agg(F.count("*").alias("n"))


def auto_bins(df: DataFrame, col: str) -> int:
    """Bin count by Sturges' rule."""
    n = df.where(F.col(col).isNotNull()).count()
    return max(1, math.ceil(math.log2(n)) + 1) if n else 1


def auto_histogram(df: DataFrame, col: str) -> DataFrame:
    """Counts in equal-width bins: as many as the narrower of two widths needs.

    Sturges' width is the range over log2(n) + 1, that of Freedman and Diaconis twice
    the range between quartiles over the cube root of n; without such a range
    Sturges' is taken. The last bin includes the maximum.
    """
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(col).alias("n"))
    quartiles = group_percentiles(df, [], col, {"q1": 0.25, "q3": 0.75})
    known = ends.join(quartiles.withColumn("_one", F.lit(1)), F.lit(1) == F.col("_one"), "left")
    span = F.col("hi") - F.col("lo")
    sturges = span / (F.log2("n") + 1)
    spread = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    width = F.when(spread > 0, F.least(spread, sturges)).otherwise(sturges)
    bins = F.greatest(F.coalesce(F.ceil(F.try_divide(span, width)), F.lit(1)), F.lit(1))
    held = known.select(F.struct("lo", "hi", bins.cast("double").alias("bins")).alias("e")).scalar()
    rows = df.where(F.col(col).isNotNull()).withColumn("_e", held)
    size = (F.col("_e.hi") - F.col("_e.lo")) / F.col("_e.bins")
    at = F.least(F.coalesce(F.floor(F.try_divide(x - F.col("_e.lo"), size)), F.lit(0)), F.col("_e.bins") - 1).cast("int")
    rows = rows.withColumn("bin", at).withColumn("bin_start", F.col("_e.lo") + F.col("bin") * size)
    return rows.groupBy("bin", "bin_start").agg(F.count("*").alias("n"))


def mean_interval(df: DataFrame, x: str, y: str) -> DataFrame:
    """Mean of y per x with a normal 95 % interval."""
    half = F.lit(Z95) * F.try_divide(F.stddev_samp(y), F.sqrt(F.count(y)))
    out = df.where(F.col(x).isNotNull()).groupBy(x).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), half.alias("_half")
    )
    return out.select(x, "n", "mean", (F.col("mean") - F.col("_half")).alias("low"), (F.col("mean") + F.col("_half")).alias("high"))


def _replicate_sums(x: str, replicates: int):
    """Weight and weighted sum of `_y` of each x and replicate in a batch; replicate -1 counts every row once."""
    table = np.searchsorted(POISSON_16, np.arange(1 << 16), side="right").astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, max(1, DRAWS_AT_ONCE // replicates)):
                part = batch.slice(a, max(1, DRAWS_AT_ONCE // replicates))
                n = part.num_rows
                draws = np.frombuffer(b"".join(part.column("_h").to_pylist()), ">u2").reshape(n, -1)[:, :replicates]
                codes = part.column(x).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                order = np.argsort(codes, kind="stable")
                edges = np.flatnonzero(np.diff(codes[order], prepend=-1))
                weights = np.column_stack([np.ones(n), table[draws]])[order]
                y = part.column("_y").to_numpy(zero_copy_only=False)[order][:, None]
                with np.errstate(invalid="ignore", over="ignore"):
                    # a number that isn't finite counts only where it was drawn
                    product = weights * y if np.isfinite(y).all() else np.where(weights > 0, weights * y, 0.0)
                    sums, total = np.add.reduceat(product, edges, axis=0), np.add.reduceat(weights, edges, axis=0)
                group, replicate = np.nonzero(total)
                key = part.column(x).take(pa.array(order[edges][group]))
                numbers = [pa.array((replicate - 1).astype(np.int32)), pa.array(total[group, replicate]), pa.array(sums[group, replicate])]
                yield pa.RecordBatch.from_arrays([key, *numbers], names=[x, "_b", "_w", "_s"])

    return run


def bootstrap_interval(
    df: DataFrame, x: str, y: str, row_id: str, replicates: int = 200, level: float = 0.95, seed: int = 42
) -> DataFrame:
    """Mean of y per x with a percentile bootstrap interval: x, n, mean, low, high.

    Poisson bootstrap: a row counts in each replicate as often as a Poisson draw of
    mean 1 says. The draws are taken from digests of the row's id, eight of 16 bits
    each, so they are the same on any partitioning. The rows are dealt out evenly
    once, as a row costs many digests; each batch then passes on only its sums of
    each (x, replicate), and one aggregate of those serves all replicates.
    """
    spark = df.sparkSession
    slices = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, F.col(row_id).cast("string").alias("_id"), F.col(y).cast("double").alias("_y"))
    digest = lambda d: F.md5(F.concat_ws(":", "_id", F.lit(d), F.lit(seed)))
    digests = F.unhex(F.concat(*[digest(d) for d in range(math.ceil(replicates / 8))])).alias("_h")
    kinds = T.StructType([known.schema[x], *[T.StructField(n, t()) for n, t in (("_b", T.IntegerType), ("_w", T.DoubleType), ("_s", T.DoubleType))]])
    sums = known.repartition(slices).select(x, "_y", digests).mapInArrow(_replicate_sums(x, replicates), kinds)
    means = sums.groupBy(x, "_b").agg(F.sum("_w").alias("_w"), (F.sum("_s") / F.sum("_w")).alias("_m"))
    drawn, whole, tail = F.col("_b") >= 0, F.col("_b") < 0, (1 - level) / 2
    each = means.groupBy(x).agg(
        F.max(F.when(whole, F.col("_w"))).cast("long").alias("n"), F.max(F.when(whole, F.col("_m"))).alias("mean"),
        F.percentile(F.when(drawn, F.col("_m")), F.array(F.lit(tail), F.lit(1 - tail))).alias("_e"),
    )
    return each.select(x, "n", "mean", F.col("_e")[0].alias("low"), F.col("_e")[1].alias("high"))


def box_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Quartiles, whiskers at the outermost points within 1.5 IQR, and outliers per group."""
    q = group_percentiles(df, keys, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    kept = df.where(" and ".join(f"{c} is not null" for c in [*keys, col]))
    rows = attach(kept, q, keys) if keys else kept.withColumn("_q", q.select(F.struct("*")).scalar()).select(*kept.columns, "_q.*")
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(col).cast("double")
    inside = (x >= low) & (x <= high)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def conditional_density(df: DataFrame, x: str, category: str, bins: int = 30) -> DataFrame:
    """Share of each category within each bin of x."""
    n = _binned(df.where(F.col(category).isNotNull()), x, bins).groupBy("bin", category).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("bin"))
    return n.withColumn("share", F.col("n") / whole)


def kernel_density(df: DataFrame, col: str, points: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density of a column at a short list of points, in one pass."""
    x = F.col(col).cast("double")
    norm = 1.0 / (bandwidth * math.sqrt(2 * math.pi))
    one = df.where(F.col(col).isNotNull()).agg(
        *[(F.avg(F.exp(-F.pow((x - p) / bandwidth, F.lit(2.0)) / 2)) * norm).alias(f"d{i}") for i, p in enumerate(points)]
    )
    rows = [F.struct(F.lit(float(p)).alias("x"), F.col(f"d{i}").alias("density")) for i, p in enumerate(points)]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def density_grid(df: DataFrame, col: str, bandwidth: float, points: int = 256) -> DataFrame:
    """Gaussian kernel density on an even grid over the range of a column, three bandwidths wider at both ends.

    Linear binning: a value gives its mass to the two grid points around it, by
    nearness, in one aggregate of the rows; only grid points then meet the kernel.
    The error falls with the square of the grid's step.
    """
    x = F.col(col).cast("double")
    known = df.where(F.col(col).isNotNull()).select(x.alias("_x"))
    ends = known.agg(
        F.struct((F.min("_x") - 3 * bandwidth).alias("lo"), ((F.max("_x") - F.min("_x") + 6 * bandwidth) / (points - 1)).alias("step"), F.count("*").alias("n")).alias("e")
    ).scalar()
    at = known.withColumn("_e", ends).withColumn("_p", (F.col("_x") - F.col("_e.lo")) / F.col("_e.step"))
    at = at.withColumn("_i", F.least(F.floor("_p"), F.lit(points - 2))).withColumn("_f", F.col("_p") - F.col("_i"))
    sides = F.array(F.struct(F.col("_i"), (1 - F.col("_f")).alias("_m")), F.struct((F.col("_i") + 1).alias("_i"), F.col("_f").alias("_m")))
    masses = at.select(F.inline(sides)).groupBy("_i").agg(F.sum("_m").alias("_m")).withColumn("_e", ends)
    reach = F.ceil(F.lit(REACH * bandwidth) / F.col("_e.step"))
    near = F.explode(F.sequence(F.greatest(F.col("_i") - reach, F.lit(0).cast("long")), F.least(F.col("_i") + reach, F.lit(points - 1).cast("long")))).alias("point")
    gap = (F.col("point") - F.col("_i")) * F.col("_e.step") / bandwidth
    kernel = F.exp(-gap * gap / 2) / (bandwidth * math.sqrt(2 * math.pi))
    reached = masses.select("_e", "_i", "_m", near)
    held = reached.groupBy("point").agg((F.sum(F.col("_m") * kernel) / F.max("_e.n")).alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").alias("point"), ends.alias("_e"))
    place = (F.col("_e.lo") + F.col("point") * F.col("_e.step")).alias("x")
    return grid.join(held, "point", "left").select("point", place, F.coalesce("density", F.lit(0.0)).alias("density"))


def scatter_sample(
    df: DataFrame, x: str, y: str, fraction: float, seed: int = 42, ids: Sequence[str] | None = None
) -> DataFrame:
    """A seeded sample of points to draw; by a hash of the ids, if given, so that it is the same on any partitioning."""
    if ids is None:
        return df.select(x, y).sample(False, fraction, seed)
    return df.where(stable_draw(seed, *[F.col(i) for i in ids]) < fraction).select(*ids, x, y)
