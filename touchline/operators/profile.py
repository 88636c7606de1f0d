"""Reports on tables: nulls, distinct values, frequencies, correlation, quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.relational import columns_of_kind
from touchline.operators.stats import group_percentiles
from touchline.session import stage


def unpivot_row(df: DataFrame, fields: Mapping[str, Mapping[str, str]], name: str) -> DataFrame:
    """One-row aggregate to one row per entry: {label: {output: column}}."""
    rows = [
        F.struct(F.lit(label).alias(name), *[F.col(c).alias(o) for o, c in cols.items()])
        for label, cols in fields.items()
    ]
    return df.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, nulls and whether there are any."""
    cols = list(cols or df.columns)
    one = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in cols]
    )
    long = unpivot_row(one, {c: {"rows": "rows", "nulls": f"n_{c}"} for c in cols}, "column")
    return long.withColumn("any_null", F.col("nulls") > 0)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def table_diagnostics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Shape, types and null counts of several tables in one report."""
    parts = []
    for name, df in tables.items():
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
        parts.append(
            null_counts(df).select(
                F.lit(name).alias("table"), "column", kind[F.col("column")].alias("type"),
                "rows", F.lit(len(df.columns)).alias("columns"), "nulls",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def column_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) over all columns: one pass, combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("_p")).select("_p.*").groupBy("column", "value").agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    cols = list(cols or df.columns)
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return unpivot_row(one, {c: {"distinct_values": c} for c in cols}, "column")
    return column_values(df, cols).groupBy("column").agg(F.count("value").alias("distinct_values"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of the non-null values, most frequent first."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)
    )


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Contingency table in long form: the pairs that occur."""
    kept = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return kept.groupBy(row, col).agg(F.count("*").alias("n"))


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table with one column per value of ``col``: the given ones, or all that occur.

    Without ``values`` the planner looks them up first, of which it allows a bounded number.
    """
    kept = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return kept.groupBy(row).pivot(col, list(values) if values is not None else None).count().na.fill(0)


def correlations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise Pearson correlation of numeric columns, long form, in one pass."""
    cols = list(cols or columns_of_kind(df, "number"))
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    one = numbers.agg(*[F.corr(f"c{i}", f"c{j}").alias(f"r{i}_{j}") for i, j in pairs])
    rows = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            rows.append(F.struct(F.lit(cols[a]).alias("a"), F.lit(cols[b]).alias("b"), F.col(f"r{i}_{j}").alias("r")))
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


#: Characters of a text that travel with its digest.
FIRST_CHARACTERS = 64
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe_numbers(
    df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Count, mean, stddev, min, quartiles and max, one row per numeric column.

    ``approximate`` takes the quartiles from quantile sketches in the same pass.
    """
    cols = list(cols or columns_of_kind(df, "number"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    long = df.select(F.explode(pairs).alias("_p")).select("_p.*").where("x is not null")
    basic = long.groupBy("column").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        *[F.percentile_approx("x", p).alias(o) for o, p in QUARTILES.items() if approximate],
    )
    if approximate:
        return basic
    return basic.join(group_percentiles(long, ["column"], "x", QUARTILES), "column")


def describe_texts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value (the least of several) and its frequency per text column.

    Texts may be whole documents: what is shuffled and counted are digests with the
    first characters. Only texts that may be the most frequent are looked at again.
    """
    cols = list(cols or columns_of_kind(df, "text"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("_p")).select("_p.*").where("value is not null")
    long = long.withColumn("_key", F.sha2(F.col("value").cast("binary"), 256))
    counts = stage(long.groupBy("column", "_key").agg(F.count("*").alias("n"), F.min(F.left("value", F.lit(FIRST_CHARACTERS))).alias("_first")), "counts")
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("_first").alias("first"))).alias("_best")
    whole = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), best)
    held = counts.join(whole.select("column", "_best"), "column").where((-F.col("n") == F.col("_best.rank")) & (F.col("_first") == F.col("_best.first")))
    held = stage(held.select("column", "_key"), "most-frequent")
    top = long.join(held, ["column", "_key"], "left_semi").groupBy("column").agg(F.min("value").alias("top"))
    return whole.join(top, "column").select("column", "count", "unique", "top", (-F.col("_best.rank")).alias("freq"))


def variable_kinds(df: DataFrame) -> DataFrame:
    """Each column as ``binary`` (number, two values), ``numerical`` or ``categorical``."""
    numbers = columns_of_kind(df, "number")
    kind = (
        F.when(~F.col("column").isin(numbers), "categorical")
        .when(F.col("distinct_values") == 2, "binary")
        .otherwise("numerical")
    )
    return distinct_counts(df).withColumn("kind", kind)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per pair of labels, with a flag where they agree."""
    return df.groupBy(a, b).agg(F.count("*").alias("n")).withColumn("same", F.coalesce(F.col(a) == F.col(b), F.lit(False)))


def explicit_order(col: str, order: Sequence[str]):
    """Rank column for categories in a stated order; others get NULL."""
    at = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(col))
    return F.nullif(at, F.lit(0))


def argmax_abs(df: DataFrame, metric: str, tie_break: Sequence[str]) -> DataFrame:
    """The row with the greatest absolute metric."""
    return df.where(F.col(metric).isNotNull()).orderBy(F.desc(F.abs(metric)), *tie_break).limit(1)
