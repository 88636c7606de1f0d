"""Backward as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ordered import carry_along

#: Buckets that keys are hashed into, and rows from which a bucket is hot: those are then spread over slices of the
#: order, as a key may hold most of them, and the others sorted in one task a key.
BUCKETS = 65_536
HOT_ROWS = 1_000_000


def _all_known(names: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def _hot(left: DataFrame, right: DataFrame, by: Sequence[str]) -> tuple[Column, list[int]]:
    """The bucket of a row's key, and the buckets with HOT_ROWS rows or more on both sides together: none in most tables.

    Only BUCKETS counts are held and moved, whatever the number of keys; at most one
    in HOT_ROWS rows gives a number to the driver.
    """
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS).cast("long"))
    both = left.select(bucket.alias("_b")).unionByName(right.select(bucket.alias("_b")))
    rows = both.groupBy("_b").agg(F.count("*").alias("_n")).where(F.col("_n") >= HOT_ROWS).select("_b").collect()
    return bucket, sorted(r["_b"] for r in rows)


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    payload: Sequence[str],
    tie_break: Sequence[str] = (),
    slices: int | None = None,
    once: bool = False,
) -> DataFrame:
    """Each left row with the latest right row of its key at or before ``on``.

    An equal ``on`` matches, the latest row counts even where its payload is
    NULL, and a left row without a match gets NULLs. Several right rows at the
    same point: the one greatest in ``tie_break`` (then payload) wins.

    Both sides are united and the last right row before a left row is carried to
    it: there is no join of the two tables. Keys are sorted one by one, after one
    shuffle, but for those in a hot bucket. These, or all if ``slices`` is given, go
    through a prefix scan over slices of the order, so that a hot key costs no more
    than its rows. With ``once`` equal left rows, which may have no columns but
    ``by`` and ``on``, count as one.
    """
    by_slices = lambda a, b: _by_slices(a.distinct() if once else a, b, by, on, payload, tie_break, slices)
    if slices is not None:
        return by_slices(left, right)
    bucket, hot = _hot(left, right, by)
    if not hot:
        return _by_key(left, right, by, on, payload, tie_break, once)
    light = _by_key(left.where(~bucket.isin(hot)), right.where(~bucket.isin(hot)), by, on, payload, tie_break, once)
    return light.unionByName(by_slices(left.where(bucket.isin(hot)), right.where(bucket.isin(hot))))


def _by_key(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, payload: Sequence[str], tie_break: Sequence[str], once: bool) -> DataFrame:
    """The as-of search by one sort within each key; right rows of one point come in the order of their tie-break."""
    if once and set(left.columns) != {*by, on}:
        raise ValueError("rows that count once have no columns but the key's")
    keys = [*by, on]
    names = [f"_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*tie_break, *payload])])
    build = right.where(_all_known(keys)).select(*renamed, F.lit(0).alias("_side"), row.alias("_row"))
    probe = left.select(*renamed, F.lit(1).alias("_side"), F.struct(*[F.col(c) for c in left.columns]).alias("_left"))
    both = probe.unionByName(build, allowMissingColumns=True)
    # rows without a key or place find nothing, so they spread by their content
    spread = F.when(~_all_known(names), F.xxhash64("_left")).alias("_spread")
    order = Window.partitionBy(*names[:-1], "_spread").orderBy(names[-1], "_side", "_row")
    along = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {"_row": F.last("_row", ignorenulls=True).over(along)}
    if once:  # equal left rows are neighbours
        before = F.lag(F.struct(names[-1], "_side")).over(order)
        out["_again"] = F.coalesce((before["_side"] == 1) & before[names[-1]].eqNullSafe(F.col(names[-1])), F.lit(False))
    found = both.select("*", spread).withColumns(out).where("_side = 1 and not _again" if once else "_side = 1")
    return found.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns], *[F.col(f"_row.{c}").alias(c) for c in payload])


def _by_slices(
    left: DataFrame, right: DataFrame, by: Sequence[str], on: str, payload: Sequence[str], tie_break: Sequence[str], slices: int | None
) -> DataFrame:
    """The as-of search by a prefix scan over slices of (key, ``on``). Right rows of one point shrink to the winner before they move."""
    keys = [*by, on]
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*tie_break, *payload])])
    build = right.where(_all_known(keys)).groupBy(*keys).agg(F.max(row).alias("_row"))
    build = build.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_any"), "_row")
    # left rows of one point come in any order behind the right one; the number only spreads them
    probe = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_any"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_left"),
    )
    both = probe.unionByName(build, allowMissingColumns=True)
    names = [f"_k{i}" for i in range(len(keys))]
    found = carry_along(both, names[:-1], [names[-1], "_side", "_any"], ["_row"], slices=slices).where("_side = 1")
    return found.select(*[F.col(f"_left.{c}").alias(c) for c in left.columns], *[F.col(f"_row.{c}").alias(c) for c in payload])


def latest_prior_in_bucket(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    bucket: str,
    left_on: str,
    right_on: str,
    payload: str,
    slices: int | None = None,
) -> DataFrame:
    """Latest non-null payload of the same key *and* bucket not after the left date.

    Left rows without one drop out, and one row per (key, bucket, date) stays.
    Stated as an as-of search, it never pairs all rows of a bucket.
    """
    keys = [*by, bucket]
    probe = left.select(*keys, left_on)
    build = right.where(F.col(payload).isNotNull()).select(
        *keys, F.col(right_on).alias(left_on), payload
    )
    found = asof_backward(probe, build, keys, left_on, [payload], slices=slices, once=True)
    return found.where(F.col(payload).isNotNull())
