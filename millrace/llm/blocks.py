"""Documents packed into stored blocks, and runs of sorted hashes as messages between blocks.

Operators that ask "does this window occur elsewhere?" for every window of a corpus would move a
row per window.  Instead each block of documents sends its sorted, distinct hashes, cut by ranges of
the hash, as packed runs; a range compares the runs of all blocks and answers each with a code a
hash.  A window that a third of all documents hold is one hash a block, so no key is hot.  Blocks are
rows of a written table, so that the answer meets the very block that asked, whatever executors or
splits there are by then.
"""

from __future__ import annotations

import datetime
import decimal
import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import narrow
from millrace.session import materialise, ship_package

#: Bytes of text a block, if no document is longer.
BLOCK_BYTES = 6 << 20
#: Hashes that one range compares at once.
RANGE_HASHES = 2 << 20


def pack_bytes(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unpack_bytes(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_run(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit values as steps; equal bytes of all steps stand together."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return pack_bytes(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_run(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack_bytes(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_blocks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                block_bytes: int = BLOCK_BYTES, keep_ids_together: bool = False) -> DataFrame:
    """A stored table of blocks: block (a unique long), ids, sizes (bytes a text), payload.

    Rows are taken as they come within a partition; null texts are empty.  ``keep_ids_together``
    lets a block end only where the id changes.
    """
    ship_package(docs.sparkSession)
    chosen = narrow(docs, id_column, text_column)
    kind = chosen.schema[id_column].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size, id_type = 0, [], [], 0, None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                 pa.array([ids], pa.list_(id_type)), pa.array([[len(text) for text in texts]], pa.list_(pa.int32())),
                 pa.array([pack_bytes(b"".join(texts))], pa.binary())], ["block", "ids", "sizes", "payload"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = text or b""
                if ids and size + len(text) > block_bytes and not (keep_ids_together and key == ids[-1]):
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(key)
                texts.append(text)
                size += len(text)
        if ids:
            yield block()

    return materialise(chosen.mapInArrow(
        pack, f"block long, ids array<{kind}>, sizes array<int>, payload binary"), "blocks")


def texts_of(sizes: list[int], payload: bytes) -> list[bytes]:
    data = unpack_bytes(payload)
    ends = np.cumsum(sizes, dtype=np.int64)
    return [data[end - size:end] for end, size in zip(ends.tolist(), sizes)]


def ordered_blocks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks that hold consecutive ids, nulls first; ``order_key`` of a block's first id gives their order.

    Where the files are in order of the id already, each split is sorted by itself; else the rows are
    dealt by ranges of the id first.  Which is the case is read from the id column, and checked once
    more on the blocks themselves.
    """
    chosen = narrow(docs, id_column, text_column)
    key = F.col(f"`{id_column}`")

    def disjoint(ranges: DataFrame) -> bool:
        if ranges.filter("nulls").limit(2).count() > 1:
            return False
        ranges = ranges.filter("low IS NOT NULL")
        joined = ranges.select(F.col("low").alias("at"), F.lit(1).alias("step")).unionByName(
            ranges.select(F.col("high").alias("at"), F.lit(-1).alias("step")))
        # As many ranges as splits or blocks: open ones at any id may be one at most.
        after = Window.orderBy("at", F.col("step").desc())
        return joined.withColumn("open", F.sum("step").over(after.rowsBetween(Window.unboundedPreceding, 0))).filter("open > 1").limit(1).count() == 0

    splits = chosen.select(key.alias("key")).groupBy(F.spark_partition_id().alias("split")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.max(F.col("key").isNull()).alias("nulls"))
    for in_place in ([True, False] if disjoint(splits) else [False]):
        dealt = chosen if in_place else chosen.repartitionByRange(key)
        packed = pack_blocks(dealt.sortWithinPartitions(key), id_column, text_column, block_bytes, keep_ids_together=True)
        ranges = packed.select(
            F.array_min("ids").alias("low"), F.array_max("ids").alias("high"), F.exists("ids", lambda k: k.isNull()).alias("nulls"))
        if disjoint(ranges):
            break
    return packed


def order_key(key: object) -> str:
    """A text that sorts as ids of one column do, nulls first: whole numbers, texts, dates, times, booleans,
    decimals, fractions and bytes."""
    if key is None:
        return ""
    if isinstance(key, int):  # booleans too
        return f"1{key + (1 << 63):020d}"
    if isinstance(key, str):
        return f"1{key}"
    if isinstance(key, datetime.datetime):
        return f"1{key.replace(tzinfo=None).isoformat(timespec='microseconds')}"
    if isinstance(key, datetime.date):
        return f"1{key.isoformat()}"
    if isinstance(key, decimal.Decimal):  # all of a column have the same scale
        sign, digits, _ = key.as_tuple()
        number = int("".join(map(str, digits)))
        return f"1{10**38 + (-number if sign else number):040d}"
    if isinstance(key, float):
        bits = struct.unpack(">Q", struct.pack(">d", math.nan if key != key else key + 0.0))[0]
        return f"1{bits ^ (((1 << 64) - 1) if bits >> 63 else (1 << 63)):016x}"
    if isinstance(key, bytes):
        return f"1{key.hex()}"
    raise TypeError(f"ids of type {type(key).__name__} have no order here")


def exchange(blocks: DataFrame, hashes_of: Callable[[list, list[int], bytes], np.ndarray], total: int,
             mark: Callable[[np.ndarray], np.ndarray], by_id: bool = False) -> tuple[DataFrame, int]:
    """Answers (block, part, answer), a code for each of the block's hashes within a range, and the
    bits of a hash that name its range.

    ``hashes_of`` gives a block's sorted distinct hashes; ``total`` about how many there are in all.
    ``mark`` gets, for the sorted values of a range, whether each is the first of its equals, and
    gives a code to each, zero for no news.  Equal values are in the order of the blocks,
    or ``by_id`` in that of the blocks' first ids.
    """
    parts = 1
    while parts * RANGE_HASHES < total:
        parts *= 2
    bits = parts.bit_length() - 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = hashes_of(row["ids"], row["sizes"], row["payload"])
                edges = np.searchsorted(values >> np.uint64(64 - bits) if bits else np.zeros(len(values), dtype=np.uint64), np.arange(parts + 1, dtype=np.uint64))
                used = [part for part in range(parts) if edges[part] < edges[part + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(used), pa.int64()),
                     pa.array([order_key(row["ids"][0]) if by_id else ""] * len(used), pa.string()), pa.array(used, pa.int32()),
                     pa.array([pack_run(values[edges[part]:edges[part + 1]]) for part in used], pa.binary())],
                    ["block", "low", "part", "run"])

    runs = blocks.mapInArrow(send, "block long, low string, part int, run binary")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["low", "block"], kind="stable")
        each = [unpack_run(run) for run in frame["run"]]
        values = np.concatenate(each)
        by_value = np.argsort(values, kind="stable")
        ordered = values[by_value]
        first = np.r_[True, ordered[1:] != ordered[:-1]]
        codes = np.empty(len(values), dtype=np.uint8)
        codes[by_value] = mark(first)
        answers, at = [], 0
        for run in each:
            own = codes[at:at + len(run)]
            answers.append(pack_bytes(own.tobytes(), 1) if own.any() else None)
            at += len(run)
        said = frame[["block", "part"]].assign(answer=answers)
        return said[said["answer"].notna()]

    return runs.groupBy("part").applyInPandas(compare, "block long, part int, answer binary"), bits


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the list of its answers, empty if all were no."""
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    return blocks.join(listed, "block", "left")


def read_answers(answers: list[dict] | None, values: np.ndarray, bits: int) -> np.ndarray:
    """The codes of a block's answers in the order of its sorted distinct hashes."""
    codes = np.zeros(len(values), dtype=np.uint8)
    parts = values >> np.uint64(64 - bits) if bits else np.zeros(len(values), dtype=np.uint64)
    for answer in answers or ():
        begin, end = np.searchsorted(parts, np.array([answer["part"], answer["part"] + 1], dtype=np.uint64))
        codes[begin:end] = np.frombuffer(unpack_bytes(answer["answer"]), dtype=np.uint8)
    return codes
