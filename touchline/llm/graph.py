"""Connected components of a graph that only executors see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import stage


def components(edges: DataFrame) -> DataFrame:
    """Rows node, component (the smallest node reachable) for every node of the edges a, b (long, no nulls).

    Rounds of large-star and small-star steps turn each component into a star around its smallest node. A round moves
    each edge a bounded number of times, its minima are combined before they are shuffled, and its result is written to
    the shared folder, so that the next one does not depend on executors that may be lost.
    """
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct(), "edges")
    before = None
    while True:
        check = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "to")).alias("x")).first()
        if check == before or not check["n"]:
            return now.select("node", F.col("to").alias("component")).union(now.select("to", "to")).distinct()
        before = check
        both = now.union(now.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("m")).select(F.col("node").alias("n"), F.least("n", "m").alias("m"))
        large = both.where("to > node").join(least, F.col("node") == F.col("n")).select(F.col("to").alias("node"), F.col("m").alias("to")).distinct()
        lowest = large.groupBy("node").agg(F.min("to").alias("m")).withColumnRenamed("node", "n")
        small = large.join(lowest, F.col("node") == F.col("n")).select(F.explode(F.array(F.struct("node", F.col("m").alias("to")), F.struct(F.col("to").alias("node"), F.col("m").alias("to")))).alias("e"))
        now = stage(small.select("e.*").where("node != to").distinct(), "edges")
