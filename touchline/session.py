"""Session settings shared by the entry points, the benchmark and the tests."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_dirs: dict[str, str] = {}
_stages: dict[str, list[str]] = {}


def local_session(cores: str = "*", app: str = "touchline", partitions: int = 8) -> SparkSession:
    """A session for one machine; a cluster brings its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised stages.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in one process
    may fall back to a folder of its own, as executors elsewhere could not read it;
    that folder goes when the process ends.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="touchline-stages-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table once and continue from the written copy.

    This cuts the lineage, so that the steps behind it are neither planned nor
    run again by each consumer, and it survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stages.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, name: str = "", keep: int = 0) -> int:
    """Delete the stages that this application has written, once no result reads them any more; how many there were.

    With a name only those of it, but for as many of the latest as are kept.
    """
    held = _stages.pop(spark.sparkContext.applicationId, [])
    named = [p for p in held if p.rsplit("/", 1)[-1].startswith(f"{name}-")] if name else held
    paths = named[: max(0, len(named) - keep)]
    _stages[spark.sparkContext.applicationId] = [p for p in held if p not in paths]
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        place = path_of(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)
