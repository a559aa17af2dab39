"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact check.

A document is contaminated by an item if some window of as many words as the item has a weighted
Jaccard similarity of at least 0.8 with it: both as multisets of five-word shingles, the sum of the
smaller multiplicities over that of the greater.  A document with fewer words than the item is one window.

1. Such a window of m shingles shares at least t(m + k) / (1 + t) of them with the k of the item.  A bitmap of the
   items' shingles, of fixed size, tells how many of a window's shingles any item has; windows with
   fewer cannot pass and are not fingerprinted.  What is left of a document are regions.
2. Regions are reduced to different contents, so that a passage in a third of all documents is
   searched once.  Each window in them gets a SimHash.
3. Items are indexed in four blocks of 16 bits, under each value that differs from theirs in a quarter
   of the radius at most: by the pigeonhole principle no fingerprint within the radius is missed.
4. Candidates within the radius are verified by the similarity itself.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import narrow
from millrace.llm.substring_dedup import rabin_karp
from millrace.session import materialise, ship_package

SHINGLE, SIMILARITY = 5, 0.8
#: Bits in which fingerprints of similar texts may differ.  At similarity 0.8 ten of 64 are expected.
RADIUS, BLOCKS = 15, 4
#: The bitmap has 2^26 bits, 8 MB, whatever there is to put in; it comes to the driver in pieces of 64 KB.
BITMAP_BITS, PIECE_BITS = 26, 19


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, ASCII letters in lower case."""
    words = text.lower().split()
    return rabin_karp(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)), size)


def needed(m: int, k: int, similarity: float) -> int:
    """Shingles that windows of m and k must share."""
    return max(math.ceil(similarity * (m + k) / (1 + similarity) - 1e-9), 1)


def fingerprints_of(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """SimHash of the k hashes from each start."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(2 * (sums[starts + k] - sums[starts]) > k, axis=1, bitorder="little").view("<u8").ravel()

#: Bytes of a row of the index, and of an index that is broadcast.
INDEX_ROW, BROADCAST_BYTES = 40, 128 << 20


def similarity_of(one: Counter, other: Counter) -> float:
    shared = sum((one & other).values())
    return shared / (sum(one.values()) + sum(other.values()) - shared)


def _prepared(items: DataFrame, shingle: int) -> DataFrame:
    """Different items with at least one word: _item, item_id, n (words), gram (words a shingle), hashes, mark."""
    kind = items.schema["item_id"].dataType.simpleString()

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                n = len((text or b"").split())
                if n:
                    gram = min(shingle, n)
                    hashes = shingles(text, gram)
                    mark = fingerprints_of(hashes, np.zeros(1, dtype=np.int64), len(hashes))
                    rows.append((key, n, gram, hashes.view(np.int64).tolist(), int(mark.view(np.int64)[0])))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.list_(pa.int64())), pa.array(columns[4], pa.int64())], ["item_id", "n", "gram", "hashes", "mark"])

    made = narrow(items, "item_id", "text").mapInArrow(prepare, f"item_id {kind}, n int, gram int, hashes array<long>, mark long")
    return materialise(made.withColumn("_item", F.xxhash64("item_id", "hashes")).dropDuplicates(["_item"]), "items")


def _bitmap(prepared: DataFrame) -> np.ndarray:
    def piece(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << PIECE_BITS, dtype=np.uint8)
        bits[frame["cell"].to_numpy() & ((1 << PIECE_BITS) - 1)] = 1
        return pd.DataFrame({"piece": [int(frame["cell"].iloc[0]) >> PIECE_BITS], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    cells = prepared.select(F.explode("hashes").alias("hash")).select(
        F.shiftrightunsigned("hash", 64 - BITMAP_BITS).alias("cell")).distinct()
    rows = cells.groupBy(F.shiftright("cell", PIECE_BITS).alias("_piece")).applyInPandas(piece, "piece long, bits binary").collect()
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    size = 1 << (PIECE_BITS - 3)
    for row in rows:
        bitmap[row["piece"] * size:(row["piece"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bitmap


def _known(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    cell = hashes >> np.uint64(64 - BITMAP_BITS)
    return bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1


def _windows(hashes: np.ndarray, whole: bool, ks: list[int], bitmap: np.ndarray, similarity: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(k, m, starts) of the windows of m shingles of which enough are known: m is k, or fewer where the
    ``whole`` document has fewer."""
    known = _known(hashes, bitmap)
    if not known.any():
        return
    sums = np.concatenate([[0], np.cumsum(known, dtype=np.int64)])
    for k in ks:
        m = min(k, len(hashes)) if whole else k
        if m <= len(hashes) and sums[-1] >= needed(m, k, similarity):
            starts = np.flatnonzero(sums[m:] - sums[:-m] >= needed(m, k, similarity))
            if len(starts):
                yield k, m, starts


def find_contamination(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                       shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The contaminated documents: id, item_id, start (word of the best window), n_words (of the item),
    similarity, n_windows; one row per id and item.  A document shorter than the item is compared as a whole.

    Items have item_id and text.  Texts are compared by words in lower case (A-Z).  An item
    with fewer words than a shingle is one shingle of all its words; one without words, or with a
    null text, matches nothing, and neither does a null document.  Repeated items give a row each id;
    repeated documents share a row.  Null ids are ids like any other.  Empty tables give an empty result;
    further columns are not read.  Of the windows that reach the similarity, those whose SimHash is
    further off than ``radius`` are missed.
    """
    spark = docs.sparkSession
    ship_package(spark)
    chosen = narrow(docs, id_column, text_column)
    kind = chosen.schema[id_column].dataType.simpleString()
    prepared = _prepared(items, shingle)
    # As many as there are different lengths of items.
    sizes = [(row["gram"], row["n"] - row["gram"] + 1) for row in prepared.select("gram", "n").distinct().collect()]
    ks = {gram: sorted({k for g, k in sizes if g == gram}) for gram in sorted({g for g, _ in sizes})}
    bitmap = spark.sparkContext.broadcast(_bitmap(prepared))

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for gram in ks if text else ():
                    hashes = shingles(text, gram)
                    change = np.zeros(len(hashes) + 1, dtype=np.int64)
                    for _, m, starts in _windows(hashes, True, ks[gram], bitmap.value, similarity):
                        change[:-m] += np.bincount(starts, minlength=len(change) - m)
                        change[m:] -= np.bincount(starts, minlength=len(change) - m)
                    edges = np.flatnonzero(np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0))
                    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        own, whole = hashes[begin:end], end - begin == len(hashes)
                        content = hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest() + f"-{gram}" + "-whole" * whole
                        rows.append((key, gram, begin, content, own.view(np.int64), whole))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.string()), pa.array(columns[4], pa.list_(pa.int64())),
                 pa.array(columns[5], pa.bool_())], ["id", "gram", "start", "content", "hashes", "whole"])

    found = materialise(chosen.mapInArrow(regions, f"id {kind}, gram int, start int, content string, hashes array<long>, whole boolean"), "regions")
    contents = materialise(found.groupBy("content").agg(F.first("gram").alias("gram"), F.first("hashes").alias("hashes"), F.first("whole").alias("whole")), "contents")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, gram, hashes, whole in zip(*(column.to_pylist() for column in batch.columns)):
                hashes = np.array(hashes, dtype=np.int64).view(np.uint64)
                for k, m, starts in _windows(hashes, whole, ks[gram], bitmap.value, similarity):
                    marks = fingerprints_of(hashes, starts, m)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([content] * len(starts)), pa.array(np.full(len(starts), k + gram - 1, dtype=np.int32)),
                         pa.array(starts.astype(np.int32)), pa.array(marks.view(np.int64))], ["content", "n", "at", "mark"])

    width = 64 // BLOCKS

    def block(mark: str, i: int):
        return F.shiftrightunsigned(mark, width * i).bitwiseAND(F.lit((1 << width) - 1))

    def keys(mark: str):
        return F.explode(F.array(*[F.struct(F.lit(i).alias("block"), block(mark, i).alias("value")) for i in range(BLOCKS)]))

    flips = [sum(1 << bit for bit in bits) for away in range(radius // BLOCKS + 1) for bits in combinations(range(width), away)]
    index = prepared.select("_item", "n", F.col("mark").alias("item_mark"), keys("mark").alias("key")).select(
        "_item", "n", "item_mark", "key", F.explode(F.lit(flips)).alias("flip")).select(
        "_item", "n", "item_mark", "key.block", F.col("key.value").bitwiseXOR(F.col("flip").cast("long")).alias("value"))
    # Small rows with much work each: dealt to all cores by hash, however few files they lie in.
    dealt = contents.select("content", "gram", "hashes", "whole").repartition(2 * spark.sparkContext.defaultParallelism, "content")
    windows = dealt.mapInArrow(mark, "content string, n int, at int, mark long")
    probes = windows.select("content", "n", "at", "mark", keys("mark").alias("key")).select("content", "n", "at", "mark", "key.block", "key.value")
    # The index has a row for each item, block and flip; it is broadcast if that is few, else both sides are exchanged.
    few = prepared.count() * BLOCKS * len(flips) * INDEX_ROW <= BROADCAST_BYTES
    index = F.broadcast(index) if few else index.hint("merge")
    within = F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))) <= radius
    candidates = probes.join(index, ["n", "block", "value"]).filter(within).groupBy("content", "_item").agg(F.collect_set("at").alias("places"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content, item, places, hashes, wanted in zip(*(column.to_pylist() for column in batch.columns)):
                target, k = Counter(wanted), len(wanted)
                scored = sorted(((similarity_of(Counter(hashes[at:at + k]), target), -at) for at in places), reverse=True)
                passed = [pair for pair in scored if pair[0] >= similarity]
                if passed:
                    rows.append((content, item, -passed[0][1], passed[0][0], len(passed)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.int64())], ["content", "_item", "at", "similarity", "n_windows"])

    verified = materialise(
        candidates.join(contents.select("content", "hashes"), "content")
        .join(prepared.select("_item", F.col("hashes").alias("wanted")), "_item")
        .select("content", "_item", "places", "hashes", "wanted")
        .mapInArrow(verify, "content string, _item long, at int, similarity double, n_windows long"), "verified")
    hits = found.select("id", "start", "content").join(verified, "content").join(prepared.select("_item", "item_id", "n"), "_item")
    best = F.max(F.struct("similarity", (-(F.col("start") + F.col("at"))).alias("back"), "n"))
    return hits.groupBy("id", "item_id").agg(best.alias("best"), F.sum("n_windows").alias("n_windows")).select(
        F.col("id").alias(id_column), "item_id", (-F.col("best.back")).cast("long").alias("start"),
        F.col("best.n").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity"), "n_windows")
