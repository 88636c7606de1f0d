"""Running values along an order within a key, safe for keys of any size.

A plain window puts all rows of a key into one task. Here the rows are dealt over
range partitions of (key, order), so a key of any size spreads over as many
partitions as its rows need and a partition holds a slice of the order. A prefix
scan joins them: each partition sums up in one row what it passes on, a scan of
those rows gives each partition what it starts with, and one pass inside the
partitions does the rest. Rows are shuffled twice: into their range and into the
window over it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stage

#: Rows that a slice of the order should hold, and the most slices that a shuffle is cut into. Beyond that slices
#: grow; a window task sorts its slice and spills what memory can't hold.
SLICE_ROWS = 100_000
MOST_SLICES = 20_000


def range_slices(df: DataFrame, order: Sequence[str], slices: int | None = None, out: str = "_slice") -> DataFrame:
    """The rows with the number of their slice along the order, written once.

    Slices are range partitions, as many as the rows need unless given. Rows with
    equal order values share a slice, so a total order gives the most even ones.
    """
    if slices is None:
        df = stage(df, "unsliced")
        slices = min(MOST_SLICES, max(1, math.ceil(df.count() / SLICE_ROWS)))
    ranged = df.repartitionByRange(slices, *order) if slices > 1 else df.coalesce(1)
    return stage(ranged.withColumn(out, F.spark_partition_id()), "slices")


def _known(names: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return known


def starts(sliced: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], backward: bool = False) -> DataFrame:
    """What a slice takes over for the key that it shares with the slices before it.

    One row a slice: ``_slice``, the key, and ``_c_<column>``, the last non-null value
    of that key in earlier slices (``backward``: the first in later ones).
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    place = F.struct(key.alias("key"), *order)
    best, near, far = (F.min_by, F.max, F.min) if backward else (F.max_by, F.min, F.max)
    # the key at the edge where the scan enters a slice, the key where it leaves, and the values it leaves with
    ends = sliced.where(_known(keys)).groupBy("_slice").agg(
        near(key).alias("_in"), far(key).alias("_out"),
        *[best(F.struct(key.alias("key"), F.col(c).alias("v")), F.when(F.col(c).isNotNull(), place)).alias(f"_e_{c}") for c in columns],
    )
    leaving = [F.when(F.col(f"_e_{c}.key") == F.col("_out"), F.struct(F.col(f"_e_{c}.v").alias("v"))).alias(f"_p_{c}") for c in columns]
    entering = [F.lit(None).alias(f"_p_{c}") for c in columns]
    passing = ends.select("_slice", F.col("_in").alias("_key"), F.lit(0).alias("_leaves"), *entering).unionByName(
        ends.select("_slice", F.col("_out").alias("_key"), F.lit(1).alias("_leaves"), *leaving)
    )
    along = Window.partitionBy("_key").orderBy(F.col("_slice").desc() if backward else F.col("_slice"), "_leaves")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    scanned = passing.select("_slice", "_key", "_leaves", *[F.last(f"_p_{c}", ignorenulls=True).over(before)["v"].alias(f"_c_{c}") for c in columns])
    return scanned.where("_leaves = 0").select("_slice", *[F.col(f"_key.{k}").alias(k) for k in keys], *[f"_c_{c}" for c in columns])


def carry_along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    backward: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Last non-null value at or before each row (``backward``: first at or after).

    ``order`` may be of any orderable types and must be total within a key: the
    rows of one place can't be cut. A row whose key holds NULL keeps its value.
    """
    keys, order = list(keys), list(order)
    # rows without a key need no order, so they spread by their content
    spread = F.when(~_known(keys), F.xxhash64(*order)).alias("_spread")
    sliced = range_slices(df.select("*", spread), [*keys, "_spread", *order], slices)
    carried = starts(sliced, keys, order, columns, backward)
    renamed = carried.select(*[F.col(c).alias(f"_k_{c}") for c in ["_slice", *keys]], *[f"_c_{c}" for c in columns])
    joined = sliced.join(renamed, [F.col(c) == F.col(f"_k_{c}") for c in ["_slice", *keys]], "left")
    inside = Window.partitionBy("_slice", *keys).orderBy(*[F.col(c).desc() if backward else F.col(c) for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {
        c: F.when(_known(keys), F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_c_{c}"))).otherwise(F.col(c))
        for c in columns
    }
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])
