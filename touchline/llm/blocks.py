"""Blocks of documents that ask key groups about all other blocks.

Some questions need, for every key in a text, something about that key in the whole corpus. Rows of single keys would
move many times the corpus. Here documents are packed into blocks of a few megabytes and written once; a block sends
each key group its own distinct keys as one array, the group answers with an array in the same order, and the block,
read again, puts the answers to its keys. A key that a third of all documents hold costs one entry a block.

No task holds more than a block, or a group: groups are cut from the key's leading bits, their number grows with the
corpus, and keys are distinct within a block.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import U64, buffers, pieces
from touchline.session import stage

BLOCK_BYTES = 6 << 20
#: Bytes of text for which there is one group.
GROUP_BYTES = 24 << 20
#: Stands for a null id where ids are compared: behind all others.
NO_ID = np.iinfo(np.int64).max
_SCHEMA = "block long, ids array<long>, bounds array<long>, data binary, size long"


@dataclass
class Block:
    """ids (NO_ID for null) in ascending order and the texts."""

    key: int
    ids: np.ndarray
    texts: pa.Array


def packed(data: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(data).tobytes(), 3)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def pack(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Documents as blocks, written to the shared folder. A longer text is a block of its own; a null one is empty."""
    source = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), itertools.count()

        def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows["id"].fill_null(NO_ID)
            order = np.argsort(ids.to_numpy(), kind="stable")
            data, bounds = buffers(rows["text"].take(pa.array(order)))
            sorted_ids = ids.to_numpy()[order]
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + next(seen)]), pa.array([sorted_ids]), pa.array([bounds]), pa.array([zstandard.compress(data.tobytes(), 3)], pa.binary()), pa.array([len(data)])],
                names=["block", "ids", "bounds", "data", "size"],
            )

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in pieces(batch, limit=BLOCK_BYTES // 4):
                if held and size + part.nbytes > BLOCK_BYTES:
                    yield block(held)
                    held, size = [], 0
                held.append(part)
                size += part.nbytes
        if held:
            yield block(held)

    return stage(source.mapInArrow(run, _SCHEMA), "blocks")


def read(batches: Iterator[pa.RecordBatch], *others: str) -> Iterator[tuple]:
    """Each Block, with the values of other columns of its row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = np.asarray(row.column("ids")[0].values)
            bounds = np.asarray(row.column("bounds")[0].values)
            data = zstandard.decompress(row.column("data")[0].as_py()) if bounds[-1] else b""
            texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)])
            yield Block(row.column("block")[0].as_py(), ids, texts), *(row.column(c)[0].as_py() for c in others)


def group_bits(blocks: DataFrame) -> int:
    """Leading bits of a key that name its group."""
    size = blocks.agg(F.sum("size").alias("size")).first()["size"] or 0
    return max(4, int(np.ceil(np.log2(max(1, size / GROUP_BYTES)))))


def cuts(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Group, begin and end of each group that ascending keys hold."""
    if not len(keys):
        return []
    of = keys >> U64(64 - bits)
    begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    return list(zip(of[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=True))


def ask(blocks: DataFrame, emit: Callable, columns: tuple[str, ...], joined: tuple[str, ...] = ()) -> DataFrame:
    """What blocks send: emit(block, *joined values) yields (group, *values of columns), all binary but the group."""
    schema = "grp long, block long, " + ", ".join(f"{c} binary" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, *rest in read(batches, *joined):
            rows = list(emit(block, *rest))
            if rows:
                groups, *values = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array([block.key] * len(rows), pa.int64()), *(pa.array(v, pa.binary()) for v in values)], names=["grp", "block", *columns])

    return blocks.select("block", "ids", "bounds", "data", *joined).mapInArrow(run, schema)


def answer(asked: DataFrame, reply: Callable, columns: tuple[str, ...], sums: tuple[str, ...] = ()) -> DataFrame:
    """What groups send back: reply(values of each column, a list each) gives one binary a row, in their order.

    With `sums`, names of long columns, it also gives one number for each of them, which stands in the group's first
    row; the other rows have 0.
    """
    schema = "block long, grp long, reply binary" + "".join(f", {s} long" for s in sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):  # one row at a time, as each holds an array
                    yield tuple(batch.column(c)[i].as_py() for c in ("grp", "block", *columns))

        for group, same in itertools.groupby(rows(), key=lambda r: r[0]):
            _, owners, *values = zip(*same, strict=True)
            replies = reply(*map(list, values))
            arrays = [pa.array(owners, pa.int64()), pa.array([group] * len(owners), pa.int64())]
            replies, numbers = replies if sums else (replies, ())
            arrays += [pa.array(replies, pa.binary()), *(pa.array([n] + [0] * (len(owners) - 1), pa.int64()) for n in numbers)]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "grp", "reply", *sums])

    return asked.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, schema)


def back(blocks: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """blocks with the column `name`: what its groups replied, by group (null: nothing was asked)."""
    mine = replies.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("grp", "reply"))), lambda r: r["reply"]).alias(name))
    return blocks.join(mine, "block", "left")
