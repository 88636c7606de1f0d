"""Group statistics as small tables, and attaching them to rows.

All of them aggregate before they shuffle, so a key that holds a large share of
the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import stage

#: Groups and buckets of at most this many rows are ranked in one task.
DIRECT = 100_000
#: Bits that a round of the search adds, and join keys that a hot group is spread over.
DIGIT = 8
SALTS = 16


def _present(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def group_means(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Mean per group: ``cols`` maps output name to input column."""
    return df.where(_present(keys)).groupBy(*keys).agg(*[F.avg(c).alias(o) for o, c in cols.items()])


def group_mode(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Most frequent value per group; the lowest on a tie. NULLs do not count."""
    counts = df.where(_present([*keys, col])).groupBy(*keys, col).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(col).alias("v")))
    return counts.groupBy(*keys).agg(best["v"].alias(out))


def _ordered_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each double the whole number of 64 bits that sorts as it does (NaN last)."""
    for batch in batches:
        x = batch.column("_x").to_numpy(zero_copy_only=False) + 0.0
        bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
        bits = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], names=[*batch.schema.names, "_bits"])


def _bit_length(c: Column) -> Column:
    return F.when(c == 0, 0).otherwise(F.length(F.bin(c))).cast("int")


def _in_buckets(values: DataFrame, buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values with the bucket that holds them: the upper bits above `_span` agree. Hot keys are spread."""
    salted = values.withColumn("_salt", F.pmod("_bits", F.lit(SALTS).cast("long")))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    named = buckets.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col("_prefix").alias("_b_prefix"), F.col("_span").alias("_b_span"), F.explode(numbers).alias("_b_salt"))
    match = [F.col(k) == F.col(f"_b_{k}") for k in keys] + [F.col("_salt") == F.col("_b_salt")]
    held = F.expr("_b_span >= 64 or shiftright(_bits, least(_b_span, 63)) = _b_prefix")
    joined = salted.join(named, [*match, held]).withColumnsRenamed({"_b_prefix": "_prefix", "_b_span": "_span"})
    return joined.select(*values.columns, "_prefix", "_span")


def _narrowed(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each target moved into the one of the 2 ** DIGIT parts of its bucket that holds its rank."""
    buckets = targets.select(*keys, "_prefix", "_span").distinct()
    deeper = F.greatest(F.col("_span") - DIGIT, F.lit(0))
    held = _in_buckets(values, buckets, keys).withColumn("_to", deeper).withColumn("_part", F.expr("shiftright(_bits, _to)"))
    parts = held.groupBy(*keys, "_prefix", "_span", "_to", "_part").agg(F.sum("_c").alias("_m"))
    run = Window.partitionBy(*keys, "_prefix", "_span").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_m").over(run), F.lit(0)))
    found = targets.join(parts, [*keys, "_prefix", "_span"])
    found = found.where("_before <= _rank and _rank < _before + _m")
    return found.select(*keys, "_place", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("_part").alias("_prefix"), F.col("_to").alias("_span"), F.col("_m").alias("_n"))


def _at_ranks(counts: DataFrame, targets: DataFrame, groups: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Values at the targets' ranks, from counts of distinct values of their groups."""
    run = Window.partitionBy(*groups).orderBy("_bits")
    upto = counts.withColumn("_upto", F.sum("_c").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    found = targets.select(*groups, "_place", "_rank").join(upto, list(groups)) if groups else targets.select("_place", "_rank").join(upto, F.expr("_rank < _upto"))
    return found.where("_upto - _c <= _rank and _rank < _upto").select(*keys, "_place", F.col("_x").alias("_value"))


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    probs: Mapping[str, float],
    direct: int = DIRECT,
    trace: list | None = None,
) -> DataFrame:
    """Exact percentiles per group, interpolated linearly between neighbours.

    ``probs`` maps output name to probability. The rows shrink to counts of each
    group's distinct values first, and no later step sees them again. Groups of at
    most ``direct`` rows are ranked at once. Larger ones are
    searched by radix: the bucket of values that holds a rank is divided by the
    next DIGIT bits of their ordered bits, all groups and ranks in one aggregate,
    until buckets hold at most ``direct`` rows or one value. Only the rows of
    buckets are counted, nothing is sorted but the distinct values of a last
    bucket, and a round shuffles at most 2 ** DIGIT counts a bucket and task.
    ``trace`` takes the number of buckets and of rows in them of each round.
    """
    keys = list(keys) or ["_all"]
    source = df if "_all" not in keys else df.withColumn("_all", F.lit(0))
    rows = source.where(_present([*keys, col])).select(*keys, F.col(col).cast("double").alias("_x"))
    counted = rows.groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
    ddl = T.StructType([*counted.schema.fields, T.StructField("_bits", T.LongType())])
    values = stage(counted.mapInArrow(_ordered_bits, ddl), "values")  # each distinct value of a group once, with its count
    sizes = values.groupBy(*keys).agg(F.sum("_c").alias("_total"), F.min("_bits").alias("_low"), F.max("_bits").alias("_high"))
    most = sizes.agg(F.max("_total")).first()[0] or 0

    # the ranks below and above each position, as targets; `_place` numbers them
    sizes = stage(sizes, "sizes") if most > direct else sizes
    position = {o: F.lit(p) * (F.col("_total") - 1) for o, p in probs.items()}
    ranks = [F.struct(F.lit(2 * i + up).alias("_place"), (F.ceil(pos) if up else F.floor(pos)).alias("_rank")) for i, pos in enumerate(position.values()) for up in (0, 1)]
    targets = sizes.select("*", F.inline(F.array(*ranks)))

    if most <= direct:
        ends = _at_ranks(values, targets, keys, keys)
    else:
        light = targets.where(F.col("_total") <= direct)
        large = sizes.where(F.col("_total") > direct)  # at most one in `direct` rows is a large group
        marked = values.join(large.select(*keys), keys, "left_anti")
        ends = _at_ranks(marked, light, keys, keys)
        span = _bit_length(F.col("_low").bitwiseXOR(F.col("_high")))
        prefix = F.expr("case when _span >= 64 then 0 else shiftright(_low, least(_span, 63)) end")
        open_ = targets.where(F.col("_total") > direct).withColumn("_span", span)
        open_ = open_.select(*keys, "_place", "_rank", prefix.alias("_prefix"), "_span", F.col("_total").alias("_n"))
        while True:
            open_ = stage(open_, "targets")
            wide = open_.where((F.col("_n") > direct) & (F.col("_span") > 0))
            buckets, held = wide.select(*keys, "_prefix", "_span", "_n").distinct().agg(F.count("*"), F.sum("_n")).first()
            if not buckets:
                break
            if trace is not None:
                trace.append((buckets, held))
            open_ = _narrowed(values, wide, keys).unionByName(open_.where((F.col("_n") <= direct) | (F.col("_span") == 0)))
        inside = [*keys, "_prefix", "_span"]
        last = _in_buckets(values, open_.select(*inside).distinct(), keys)
        ends = ends.unionByName(_at_ranks(last, open_, inside, keys))

    place = {o: 2 * i for i, o in enumerate(probs)}
    at = lambda k: F.max(F.when(F.col("_place") == k, F.col("_value")))
    ends = ends.groupBy(*keys).agg(*[at(k + up).alias(f"_{up}_{o}") for o, k in place.items() for up in (0, 1)])
    named = [F.col(k).alias(f"_s_{k}") for k in keys]
    whole = ends.join(sizes.select(*named, "_total"), [F.col(k) == F.col(f"_s_{k}") for k in keys])
    low, high = (lambda o: F.col(f"_0_{o}")), (lambda o: F.col(f"_1_{o}"))
    if "_all" in keys:  # a table without values still has one row
        whole = df.sparkSession.range(1).select(F.lit(0).alias("_one")).join(whole, F.col("_one") == F.col("_all"), "left")
    return whole.select(
        *[k for k in keys if k != "_all"],
        *[F.when(low(o) == high(o), low(o)).otherwise(low(o) + (high(o) - low(o)) * (position[o] - F.floor(position[o]))).alias(o) for o in probs],
    )


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join a statistics table on its keys, keeping the column order.

    No broadcast hint: the planner broadcasts the table if its measured size
    allows it and otherwise joins by shuffle, splitting hot keys.
    """
    added = [c for c in stats.columns if c not in keys]
    return df.join(stats, list(keys), "left").select(*df.columns, *added)


def group_medians(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Median per group of several columns: they are stacked and searched together."""
    if len(cols) == 1:
        ((out, col),) = cols.items()
        return group_percentiles(df, keys, col, {out: 0.5})
    pairs = F.array(
        *[F.struct(F.lit(o).alias("_col"), F.col(c).cast("double").alias("_value")) for o, c in cols.items()]
    )
    long = df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.*")
    medians = group_percentiles(long, [*keys, "_col"], "_value", {"_median": 0.5})
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_col") == o, F.col("_median"))).alias(o) for o in cols]
    )


def group_statistic(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], method: str
) -> DataFrame:
    """Statistics table of several columns: ``cols`` maps output to input column."""
    if method == "mean":
        return group_means(df, keys, cols)
    if method == "median":
        return group_medians(df, keys, cols)
    out = None
    for o, c in cols.items():
        one = group_mode(df, keys, c, o)
        out = one if out is None else out.join(one, list(keys), "full")
    return out


def with_group_statistic(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], method: str
) -> DataFrame:
    """Rows with their group's mean, median or mode beside them."""
    return attach(df, group_statistic(df, keys, cols, method), keys)


def global_statistic(df: DataFrame, col: str, method: str) -> DataFrame:
    """One row, one column: mean, median, mode, min, max or sample stddev."""
    if method == "median":
        return group_percentiles(df, [], col, {col: 0.5})
    if method == "mode":
        return group_mode(df, [], col, col)
    agg = {"mean": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp}[method]
    return df.agg(agg(col).alias(col))


def min_max_scaled(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Value scaled to [0, 1] within its group; NULL where the group has no spread."""
    ends = df.where(_present(keys)).groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    scaled = F.try_divide((F.col(col) - F.col("_lo")).cast("double"), (F.col("_hi") - F.col("_lo")).cast("double"))
    return attach(df, ends, keys).withColumn(out, scaled).drop("_lo", "_hi")
