"""URL filtering by a list, with a blocked Bloom filter before the exact hash join.

Method: listed entries are canonical URLs, `host/path`. Each URL gives the few keys under which an entry could hold it.
A blocked Bloom filter of the entries, in which each key touches one block of 512 bits, lets almost only keys pass that
are listed; what passes goes to an exact hash join, which takes away the false positives. The longest entry wins.

The filter has 16 bits an entry and MAX_BLOCKS blocks at most (64 MB), so its size is bounded however long the list
is; a filter of a longer list lets more pass and the join does more. The list itself is broadcast only where its count
is within BROADCAST_ENTRIES; beyond that the join is a shuffled one. URLs of one host don't meet anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 8
BITS_PER_ENTRY = 16
MAX_BLOCKS = 1 << 20
BROADCAST_ENTRIES = 200_000
#: Odd multipliers that pick the bit of each 64-bit word of a block; with 32 bits of a hash they stay below 2 ** 62.
SALTS = tuple(k >> 3 | 1 for k in (0x23D6F4AB, 0x508A9E26, 0x36BD9F4D, 0x44E7B6F1, 0x7A2F1C97, 0x1B873593, 0x4CC9E2D5, 0x5E2D58D9))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first `://`, A-Z lowered, up to / ? # or the end; path: then up to ? # or the end."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The bit of each word that each hash sets, one column a word."""
    low = (hashes & np.uint64(0xFFFFFFFF))[:, None]
    return (low * np.array(SALTS, np.uint64)[None, :] >> np.uint64(20)) & np.uint64(63)


def bloom_filter(entries: DataFrame, key: str, count: int) -> np.ndarray:
    """Blocks by words of 64 bits. Executors fold the entries of a block into one row before anything is shuffled."""
    blocks = max(1, min(MAX_BLOCKS, -(-count * BITS_PER_ENTRY // (64 * WORDS))))
    h = F.xxhash64(key)
    low = h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))

    def word(salt: int) -> Column:
        return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(low * F.lit(salt).cast("long"), 20).bitwiseAND(F.lit(63).cast("long")).cast("int")))

    rows = entries.groupBy(F.pmod(F.shiftright(h, 32), F.lit(blocks).cast("long")).alias("block")).agg(*(word(s).alias(f"w{i}") for i, s in enumerate(SALTS))).collect()
    out = np.zeros((blocks, WORDS), np.uint64)
    for r in rows:
        out[r["block"]] = np.array([r[f"w{i}"] for i in range(WORDS)], np.int64).view(np.uint64)
    return out


def might_hold(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be that of an entry: true for all entries, and rarely for others."""
    block = np.mod(hashes.astype(np.int64) >> 32, len(filter_))
    return ((filter_[block] >> _bits(hashes.view(np.uint64))) & np.uint64(1)).all(axis=1)


def judge_urls(pages: DataFrame, entries: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """id_column, `host`, `path`, `entry` and `verdict` (both of the entry that holds the URL, else null).

    Of several entries those of the highest `rank` go first, then the longest.

    `entries` has `entry` (`host/path`; a path that ends in `/` holds every path that begins with it, another one only
    itself; the host holds its subdomains too) `verdict` and `rank`; the same entry listed twice counts with the higher
    rank and then the smaller verdict.
    A null URL or one without `://` has an empty host and path and no entry. Null entries are passed over. Repeated
    rows are judged each; empty tables on either side are fine; other columns don't matter.
    """
    spark = pages.sparkSession
    listed = entries.where("entry is not null").groupBy("entry").agg(F.min(F.struct((-F.col("rank")).alias("last"), "verdict")).alias("of")).select("entry", "of.verdict", (-F.col("of.last")).alias("rank"))
    size = listed.agg(F.count("*").alias("n"), F.max(F.size(F.split(F.substring_index("entry", "/", 1), r"\."))).alias("labels"), F.max(F.size(F.split("entry", "/"))).alias("parts")).first()
    labels, parts = size["labels"] or 0, size["parts"] or 0
    filter_ = spark.sparkContext.broadcast(bloom_filter(listed, "entry", size["n"]))

    host, path = host_and_path(pages[url_column])
    rows = pages.select(pages[id_column].alias("id"), host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    # no entry is longer than the longest, so neither are the keys
    names, steps = F.slice(F.reverse(F.split("host", r"\.")), 1, max(labels, 1)), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.size(names)), lambda n: F.array_join(F.reverse(F.slice(names, 1, n)), "."))
    folders = F.transform(F.sequence(F.lit(1), F.least(F.size(steps) - 1, F.lit(max(parts, 1)))), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/")))
    whole = F.when((F.size(steps) <= parts) & ~F.col("path").endswith("/"), F.array("path")).otherwise(F.array().cast("array<string>"))
    paths = F.when(F.size(steps) > 1, F.concat(folders, whole)).otherwise(F.array().cast("array<string>"))
    keys = rows.where("host != ''").select("row", F.explode(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))).alias("entry"))
    hashed = keys.withColumn("h", F.xxhash64("entry"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = filter_.value
        for batch in batches:
            keep = might_hold(table, batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64))
            yield batch.filter(pa.array(keep)).select(["row", "entry"])

    possible = hashed.mapInArrow(run, T.StructType([hashed.schema["row"], hashed.schema["entry"]]))
    exact = F.broadcast(listed) if size["n"] <= BROADCAST_ENTRIES else listed.hint("shuffle_hash")
    best = possible.join(exact, "entry").groupBy("row").agg(F.max(F.struct("rank", F.length("entry"), "entry", "verdict")).alias("best"))
    return rows.join(best, "row", "left").select(F.col("id").alias(id_column), "host", "path", F.col("best.entry").alias("entry"), F.col("best.verdict").alias("verdict"))
