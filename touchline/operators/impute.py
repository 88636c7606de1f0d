"""Filling missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.values import lookup
from touchline.operators.ordered import carry_along
from touchline.operators.stats import attach, global_statistic, group_statistic


@dataclass(frozen=True)
class GroupFill:
    """Group statistic for some columns.

    ``mode='fill'`` writes it into NULLs only; ``mode='replace'`` puts it into
    every row and keeps the old value where the group has no statistic.
    ``among`` is a condition on the rows that the statistic is taken from.
    """

    cols: tuple[str, ...]
    by: tuple[str, ...]
    method: str = "mean"
    mode: str = "fill"
    among: str = "true"


def group_fills(df: DataFrame, fills: Sequence[GroupFill]) -> DataFrame:
    """Several group imputations at once.

    All statistics are taken from ``df`` as it comes in, so the plan reads it
    once per statistic rather than doubling with every step.
    """
    out = df
    for i, fill in enumerate(fills):
        named = {f"_s{i}_{c}": c for c in fill.cols}
        out = attach(out, group_statistic(df.where(fill.among), fill.by, named, fill.method), fill.by)
    new: dict[str, Column] = {}
    for i, fill in enumerate(fills):
        for c in fill.cols:
            stat = F.col(f"_s{i}_{c}")
            new[c] = F.coalesce(F.col(c), stat) if fill.mode == "fill" else F.coalesce(stat, F.col(c))
    return out.withColumns(new).select(*df.columns)


def impute(
    df: DataFrame,
    cols: Sequence[str],
    method: str,
    by: Sequence[str] = (),
    value=None,
    mode: str = "fill",
) -> DataFrame:
    """Fill ``cols`` by ``constant``, ``mean``, ``median`` or ``mode``.

    With ``by`` the statistic is that of the row's group (see ``GroupFill`` for
    ``mode``), without it that of the whole table.
    """
    if method == "constant":
        return df.na.fill(value, subset=list(cols))
    if by:
        return group_fills(df, [GroupFill(tuple(cols), tuple(by), method, mode)])
    if method == "mean":
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("means")).scalar()
        return df.withColumns({c: F.coalesce(F.col(c), means[c]) for c in cols})
    return df.withColumns(
        {c: F.coalesce(F.col(c), global_statistic(df, c, method).scalar()) for c in cols}
    )


def impute_mode_then_global(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Group mode for NULLs; what is left takes the mode of the whole column."""
    return impute(impute(df, cols, "mode", by), cols, "mode")


def fill_where(df: DataFrame, col: str, mask: Column, value) -> DataFrame:
    """Fill NULLs with ``value`` only in rows under the mask."""
    return df.withColumn(col, F.when(mask & F.col(col).isNull(), F.lit(value)).otherwise(F.col(col)))


def override_where(df: DataFrame, col: str, mask: Column, value) -> DataFrame:
    """Write ``value`` into all rows under the mask."""
    return df.withColumn(col, F.when(mask, F.lit(value)).otherwise(F.col(col)))


def fill_by_key(df: DataFrame, col: str, key: str, table: Mapping) -> DataFrame:
    """Fill NULLs from a small literal table keyed by another column."""
    return df.withColumn(col, F.coalesce(F.col(col), lookup(F.col(key), table)))


def fill_mean_truncated(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs with the column mean cut to a whole number."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), df.agg(F.avg(c).cast("bigint").cast("double").alias(c)).scalar())
            for c in cols
        }
    )


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def fill_one_draw(df: DataFrame, col: str, row_id: str, seed: int = 42) -> DataFrame:
    """One seeded draw from the non-null values fills every NULL."""
    picked = df.where(F.col(col).isNotNull()).agg(
        F.min_by(col, F.struct(_draw(F.col(row_id), F.lit(seed)), F.col(row_id))).alias(col)
    )
    return df.withColumn(col, F.coalesce(F.col(col), picked.scalar()))


def fill_draw_from(df: DataFrame, col: str, row_id: str, choices: Sequence, seed: int = 42) -> DataFrame:
    """A seeded draw from a list for each NULL row."""
    hexa = F.substring(_draw(F.col(row_id), F.lit(seed)), 1, 8)
    n = F.conv(hexa, 16, 10).cast("bigint") % len(choices)
    pick = F.array(*[F.lit(c) for c in choices])[n.cast("int")]
    return df.withColumn(col, F.coalesce(F.col(col), pick))


def fill_by_type(df: DataFrame, number=0, text: str = "Unknown") -> DataFrame:
    """Numbers to ``number``, texts to ``text``, in all columns."""
    return df.na.fill(number).na.fill(text)


def forward_fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Last known value of the group; ``order`` must be total within it."""
    return carry_along(df, by, order, cols, slices=slices)


def backward_fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Next known value of the group."""
    return carry_along(df, by, order, cols, backward=True, slices=slices)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
