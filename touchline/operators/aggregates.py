"""Grouped aggregates of the preparation steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import contains_ignoring_case


def sum_or_zero(col: str):
    """Sum that is 0, not NULL, where nothing was there to add."""
    return F.coalesce(F.sum(col), F.lit(0))


def lineup_profile(apps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean age, height and value, and summed assists, of the line-up per key."""
    return (
        apps.where(" and ".join(f"{k} is not null" for k in keys))
        .groupBy(*keys)
        .agg(
            F.avg("age").alias("age"),
            F.avg("height_in_cm").alias("height_in_cm"),
            F.avg("market_value_in_eur").alias("market_value_in_eur"),
            sum_or_zero("assists").alias("assists"),
        )
    )


def text_counts(df: DataFrame, keys: Sequence[str], col: str, needles: Mapping[str, str]) -> DataFrame:
    """Per key, how many texts hold each needle in any case."""
    return (
        df.where(" and ".join(f"{k} is not null" for k in keys))
        .groupBy(*keys)
        .agg(*[F.count_if(contains_ignoring_case(F.col(col), n)).alias(o) for o, n in needles.items()])
    )


def totals(df: DataFrame, key: str, sums: Mapping[str, str]) -> DataFrame:
    """Sums per key: output name to input column."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[sum_or_zero(c).alias(o) for o, c in sums.items()])


def first_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], last: bool = False) -> DataFrame:
    """First (or last) non-null value of each column per key, along an order."""
    pick = F.max if last else F.min
    return (
        df.where(" and ".join(f"{k} is not null" for k in keys))
        .groupBy(*keys)
        .agg(
            *[
                pick(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v"))))["v"].alias(c)
                for c in cols
            ]
        )
    )


def mean_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])
