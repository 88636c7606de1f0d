"""Date parsing, ages and the calendar encoding."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two layouts in which birth dates are written.
DATE_LAYOUTS = ("yyyy-MM-dd", "MM/dd/yyyy")


def parse_date(c: Column, layouts: tuple[str, ...] = DATE_LAYOUTS) -> Column:
    """First layout that reads the text; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)).cast("date") for p in layouts])


def age_at(day: Column, born: Column) -> Column:
    """Whole 365-day years between the two days."""
    return F.floor(F.datediff(day, born) / 365).cast("int")


def age_in_season(season: Column, born: Column) -> Column:
    """Season minus birth year."""
    return season - F.year(born)


def exact_age(day: Column, born: Column) -> Column:
    """Birthdays passed by ``day``."""
    early = F.date_format(day, "MMdd") < F.date_format(born, "MMdd")
    return F.year(day) - F.year(born) - early.cast("int")


def calendar_features(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last date of ``df``.

    Holds the calendar year, the ISO week, the week scaled to [0, 1] within its
    year and that position as a point on the circle. The table has one row per
    day, so its size depends on the covered years and not on the rows of ``df``.
    """
    ends = df.agg(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    days = days.select("date", F.year("date").alias("year"), F.weekofyear("date").alias("week"))
    span = days.groupBy("year").agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    out = days.join(span, "year").withColumn(
        "week_normalized",
        F.try_divide((F.col("week") - F.col("lo")).cast(T.DoubleType()), F.col("hi") - F.col("lo")),
    )
    turn = F.col("week_normalized") * F.lit(2 * math.pi)
    return out.select(
        "date", "year", "week", "week_normalized",
        F.sin(turn).alias("week_sin"), F.cos(turn).alias("week_cos"),
    )
