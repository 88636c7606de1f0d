"""Benchmark decontamination: short test items found inside long documents, with Spark expressions only.

Method: size-partitioned MinHash containment search. All shingles (five words in a row) are put in the order of one
random permutation, their hash. An item of q shingles is contained if at least `need` of them, the share `threshold`
rounded up, are in a document. Of the q - need + 1 smallest hashes of the item, its MinHash sketch, at least one must
then be in the document, so looking up sketches misses nothing. Items are partitioned by size; in each partition a
document is sketched by its shingles below the partition's largest sketch hash, and only those are looked up. What is
found is verified by counting the item's shingles in the document, compared as text.

The documents are read without a shuffle and give rows only for shingles found in a sketch. Sketches and found pairs are
broadcast only if a count is within BROADCAST_ROWS, items within BROADCAST_ITEMS; beyond that the same joins are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
BROADCAST_ROWS = 500_000
BROADCAST_ITEMS = 5_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits (null: none)."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """Distinct runs of five words; the whole sequence where there are fewer, none without words."""

    def of(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < SHINGLE, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(runs))

    # bound to a variable, as an expression that a lambda holds is worked out again for each element
    return F.get(F.transform(F.array(words(text)), of), F.lit(0))


def _hashes(hashed_words: str) -> Column:
    """MinHash values of the shingles, from the hashes of the words; repeated ones stay."""
    w = F.col(hashed_words)
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
    whole = F.array(F.aggregate(w, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
    return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(F.size(w) < SHINGLE, whole).otherwise(runs)


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """Rows part, item_id, h: the sketch of each item; part is the partition by size."""
    hashed = items.withColumn("w", F.transform(words(F.col("text")), lambda x: F.xxhash64(x))).select("item_id", F.array_sort(F.array_distinct(_hashes("w"))).alias("hs"))
    q = F.size("hs")
    sketch = F.slice("hs", 1, q - F.ceil(q * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1)
    return hashed.where("size(hs) > 0").select(F.floor(F.log2(q)).cast("int").alias("part"), "item_id", F.explode(sketch).alias("h"))


def contained(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row for each document and item it contains: id_column, `item_id`, `n_item` and `n_shared` (distinct shingles).

    An item is contained if n_shared >= threshold * n_item. Items of fewer than five words are one shingle, which only a
    document with just these words holds; items and documents without words, null ones included, are never found.
    Documents are told apart by id_column, null being one value; of repeated ids the row with the most shingles of the
    item counts; repeated items likewise. Empty tables on either side give no row; other columns don't matter.
    """
    items = items.select(items["item_id"], items["text"].cast("string").alias("text"))
    source = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    sketch = sketches(items, threshold)
    size = sketch.agg(F.count("*").alias("n")).first()["n"]
    by_part = {r["part"]: r["most"] for r in sketch.groupBy("part").agg(F.max("h").alias("most")).collect()}  # under 32 rows
    highest = max(by_part.values(), default=-(2**63))

    hashed = source.select("id", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("w"))
    below = hashed.select("id", F.explode(F.filter(_hashes("w"), lambda h: h <= F.lit(highest))).alias("h"))
    table = sketch.groupBy("h").agg(F.collect_set("item_id").alias("items"))
    found = below.join(F.broadcast(table) if size <= BROADCAST_ROWS else table, "h")
    pairs = found.select("id", F.explode("items").alias("item_id")).distinct()

    pairs = pairs.withColumnRenamed("id", "found").persist()
    n_pairs, n_items = pairs.count(), items.count()
    wanted = items.select("item_id", shingles(F.col("text")).alias("wanted"))
    texts = source.join(F.broadcast(pairs) if n_pairs <= BROADCAST_ROWS else pairs, F.col("id").eqNullSafe(F.col("found"))).select("id", "item_id", shingles(F.col("text")).alias("held"))
    both = texts.join(F.broadcast(wanted) if n_items <= BROADCAST_ITEMS else wanted, "item_id")
    counted = both.select("id", "item_id", F.size("wanted").cast("long").alias("n_item"), F.size(F.array_intersect("wanted", "held")).cast("long").alias("n_shared"))
    sure = counted.where(F.col("n_shared") >= F.col("n_item") * F.lit(threshold) - F.lit(1e-9))
    best = sure.groupBy("id", "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("best"))
    return best.select(F.col("id").alias(id_column), "item_id", "best.n_item", "best.n_shared")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of docs whose id contains no item, with all their columns."""
    bad = contained(docs, items, id_column, text_column, threshold).select(F.col(id_column).alias("__found")).distinct()
    return docs.join(bad, docs[id_column].eqNullSafe(bad["__found"]), "left_anti")
