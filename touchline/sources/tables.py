"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from touchline.sources.schemas import SCHEMAS

PIPELINE_TABLES = (
    "games",
    "clubs",
    "competitions",
    "game_events",
    "players",
    "appearances",
    "player_valuations",
)


def _nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


#: Texts of a CSV cell that mean NULL.
NULL_TEXTS = ("", "nan", "null", "none", "nat", "<na>")


def _cell(name: str, kind: DataType, strict: bool) -> Column:
    """A CSV cell under its declared type. Integers may be written as `52000.0`, as they are where a column has gaps."""
    text = F.trim(F.col(name))
    value = F.col(name).try_cast(kind)
    if kind.typeName() in ("integer", "long", "short"):
        # a cast that fails costs far more than one that holds, so cells that are known to fail are told by their form
        pointed, missing = text.rlike(r"^[+-]?[0-9]*[.][0-9]*$"), F.lower(text).isin(*NULL_TEXTS)
        number = text.try_cast("decimal(38,10)")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        value = F.when(missing, F.lit(None)).when(pointed, whole).otherwise(F.coalesce(value, whole))
    if strict and kind.typeName() != "string":
        lost = value.isNull() & F.col(name).isNotNull() & ~F.lower(text).isin(*NULL_TEXTS)
        value = F.when(lost, F.raise_error(F.concat(F.lit(f"column {name} can't hold "), text)).cast(kind)).otherwise(value)
    return value.alias(name)


def load_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet", strict: bool = True) -> DataFrame:
    """One input table under its declared schema.

    A CSV scan maps columns by header name: only the declared columns that the
    file holds are read, whatever their order, and NaN text becomes NULL. A cell
    that its type can't hold ends the scan, unless ``strict`` is off: then it is NULL.
    """
    if fmt == "parquet":
        return spark.read.parquet(f"{root}/{name}.parquet")
    path = f"{root}/{name}.csv"
    declared = {f.name: f.dataType for f in SCHEMAS[name].fields}
    header = spark.read.option("header", True).csv(path)
    cols = [_cell(c, declared[c], strict) for c in header.columns if c in declared]
    return _nan_to_null(header.select(*cols))


def load_inputs(
    spark: SparkSession, root: str, fmt: str = "csv", names: tuple[str, ...] = PIPELINE_TABLES
) -> dict[str, DataFrame]:
    """All input tables of the preparation plan, by name."""
    return {n: load_table(spark, root, n, fmt) for n in names}


def infer_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with a header and inferred types (an extra pass over the file)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with a header per part file; no row index."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet directory, optionally partitioned (the feature table: by year)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
