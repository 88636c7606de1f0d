"""Fragment-and-replicate: combine every row of one table with every row of another.

Both tables are cut into blocks of bounded size by a hash of the whole row, so
blocks are even whatever the keys look like. One task gets one pair of blocks
and returns a reduced result, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage


def _block_count(df: DataFrame, rows: int) -> int:
    return max(1, math.ceil(df.count() / rows))


def blockwise(
    left: DataFrame,
    right: DataFrame,
    combine: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    left_rows: int,
    right_rows: int,
) -> DataFrame:
    """Apply ``combine`` to each pair of blocks; the block columns are dropped first.

    The rows should be distinct, as equal rows hash to the same block. The number
    of the right block comes back as ``block`` for merging in levels. Both tables
    are written first: they are counted, to set the number of blocks, and read.
    """
    left, right = stage(left, "left-blocks"), stage(right, "right-blocks")
    nl, nr = _block_count(left, left_rows), _block_count(right, right_rows)

    def cut(df, own, n_own, other, n_other):
        return df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    a = cut(left, "_lb", nl, "_rb", nr)
    b = cut(right, "_rb", nr, "_lb", nl)

    def one_pair(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        block = int(y["_rb"].iloc[0]) if len(y) else -1
        out = combine(x.drop(columns=["_lb", "_rb"]), y.drop(columns=["_lb", "_rb"]))
        return out.assign(block=block)

    keys = [F.col("_lb").cast("long").alias("_lb"), F.col("_rb").cast("long").alias("_rb")]
    # fresh aliases: the two tables often come from one, and must not share columns
    a = a.select(*[F.col(c).alias(c) for c in left.columns], *keys)
    b = b.select(*[F.col(c).alias(c) for c in right.columns], *keys)
    return (
        a.groupBy("_lb", "_rb")
        .cogroup(b.groupBy("_lb", "_rb"))
        .applyInPandas(one_pair, f"{schema}, block bigint")
    )
