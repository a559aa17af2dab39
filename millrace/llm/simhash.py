"""SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits and link at three or fewer differing ones, so one of the two halves
differs in one bit at most.  The anchors of a half are the words of a covering code: a Hamming code
of 31 bits, perfect with radius 1, and the 32nd bit as it is.  Every half has one anchor within the
covering radius, its home, and is replicated to all anchors within radius plus threshold, that is 2.
The home of a fingerprint thus holds all that link to it by that half, and comparing at each anchor
finds every link.

Only different fingerprints are compared, and an anchor yields links enough to connect its members,
not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import narrow
from millrace.llm.components import components
from millrace.session import materialise, ship_package

#: Fixed by the contract: words a shingle, seed of its hash, greatest distance.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Shingles whose bits are counted at once.
SLAB = 1 << 16
#: Members of an anchor that one task compares; anchors with more are cut by bytes of the other half.
CROWD = 20_000

LINKS = "kind int, anchor long, a long, b long"


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit by bit, whether over half of the shingles' hashes have it; zero without words."""
    if not words:
        return 0
    grams = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(gram), seed) for gram in grams), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SLAB):
        octets = hashes[at:at + SLAB].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint as a signed long) of every row."""
    ship_package(docs.sparkSession)
    chosen = narrow(docs, id_column, text_column)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array(
                [fingerprint((text or b"").lower().split(), shingle) for text in batch.column(1).cast(pa.binary()).to_pylist()],
                dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], [id_column, "fingerprint"])

    return chosen.mapInArrow(mark, f"`{id_column}` {chosen.schema[id_column].dataType.simpleString()}, fingerprint long")


def _steps() -> np.ndarray:
    """By syndrome of a 31-bit word, what to add for the code words within distance 2: first the
    nearest, then those at distance 2.  Bit i has the syndrome i + 1."""
    steps = np.zeros((32, 16), dtype=np.uint64)
    for syndrome in range(1, 32):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ syndrome) - 1)) for i in range(1, 32) if i < i ^ syndrome != 0 and i != syndrome]
        steps[syndrome] = [1 << (syndrome - 1), *pairs]
    return steps


STEPS = _steps()
CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)]


def anchors(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, which of ``marks``, whether it is its home) for both halves of 64-bit ``marks``."""
    keys, of, homes = [], [], []
    for half in (0, 1):
        part = (marks >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        word = part & np.uint64(0x7FFFFFFF)
        syndrome = np.zeros(len(marks), dtype=np.int64)
        for k, check in enumerate(CHECKS):
            syndrome |= (np.bitwise_count(word & np.uint64(check)).astype(np.int64) & 1) << k
        near = part[:, None] ^ STEPS[syndrome]
        across = near[:, :1] ^ np.uint64(1 << 31)
        near = np.concatenate([near, across], axis=1) | np.uint64(half << 32)
        index = np.broadcast_to(np.arange(len(marks))[:, None], near.shape)
        home = np.zeros(near.shape, dtype=bool)
        home[:, 0] = True
        # A code word has no other within distance 2.
        there = np.ones(near.shape, dtype=bool)
        there[syndrome == 0, 1:16] = False
        keys.append(near[there])
        of.append(index[there])
        homes.append(home[there])
    return np.concatenate(keys), np.concatenate(of), np.concatenate(homes)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(marks), SLAB):
            slab = marks[at:at + SLAB]
            key, of, home = anchors(slab)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(slab[of].view(np.int64)), pa.array(home)],
                ["anchor", "fingerprint", "home"])


def spanning_links(marks: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect what is within ``distance`` of each other, one less than the members of
    each connected set.  What was reached is not compared again."""
    links, left = [], marks
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            mark = queue.pop()
            near = np.bitwise_count(left ^ mark) <= distance
            found = left[near]
            links += [(int(mark), int(other)) for other in found]
            queue += list(found)
            left = left[~near]
    return links


def _compare(batches: Iterator[pa.RecordBatch], crowd: int | None) -> Iterator[pa.RecordBatch]:
    """Links of rows (anchor, fingerprint, home) sorted by anchor, as kind 0.

    The rows of an anchor with more than ``crowd`` members are passed on as kind 1, and not held.
    """
    def links_of(anchor: np.ndarray, mark: np.ndarray, home: np.ndarray) -> np.ndarray:
        start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        size = np.diff(np.r_[start, len(anchor)])
        hosts = np.add.reduceat(home, start) > 0
        found = []
        small = np.repeat((size > 1) & (size <= 16) & hosts, size)
        at = np.flatnonzero(small)
        for step in range(1, 16):
            at = at[at + step < len(anchor)]
            at = at[anchor[at + step] == anchor[at]]
            if not len(at):
                break
            hit = at[np.bitwise_count(mark[at] ^ mark[at + step]) <= DISTANCE]
            found.append(np.stack([mark[hit], mark[hit + step]], axis=1))
        for first, n in zip(start[(size > 16) & hosts], size[(size > 16) & hosts]):
            found.append(np.array(spanning_links(mark[first:first + n]), dtype=np.uint64).reshape(-1, 2))
        return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.uint64)

    def record(kind: int, anchor: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, dtype=np.int32)), pa.array(anchor), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
            ["kind", "anchor", "a", "b"])

    def linked(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if parts:
            pairs = np.unique(links_of(*[np.concatenate(column) for column in zip(*parts)]), axis=0)
            if len(pairs):
                yield record(0, np.zeros(len(pairs), dtype=np.int64), pairs[:, 0].copy(), pairs[:, 1].copy())

    def passed(rows: tuple) -> pa.RecordBatch:
        return record(1, rows[0], rows[1], rows[1])

    held: list[tuple] = []  # rows of the last anchor so far
    crowded = None
    for batch in batches:
        rows = (batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False))
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        head, tail = tuple(x[:last] for x in rows), tuple(x[last:] for x in rows)
        if crowded is not None:
            n = int(np.searchsorted(rows[0], crowded, side="right"))
            if n:
                yield passed(tuple(x[:n] for x in rows))
            if n == len(rows[0]):
                continue
            crowded, head, tail = None, tuple(x[n:last] for x in rows), tuple(x[max(last, n):] for x in rows)
        if len(head[0]) or (held and held[-1][0][-1] != tail[0][0]):
            yield from linked([*held, head] if len(head[0]) else held)
            held = []
        held.append(tail)
        if crowd is not None and sum(len(part[0]) for part in held) > crowd:
            for part in held:
                yield passed(part)
            held, crowded = [], tail[0][0]
    yield from linked(held)


def links(marks: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all within the distance."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, crowd)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare(batches, None)

    dealt = marks.select("fingerprint").mapInArrow(_replicate, "anchor long, fingerprint long, home boolean")
    found = materialise(
        dealt.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(first, LINKS), "anchors")
    # At a crowded anchor the other half differs in three bits at most, so one of its four bytes is
    # the same: the crowd is cut by place and value of that byte.
    other = F.when(F.col("anchor") < F.lit(1 << 32), F.shiftrightunsigned("a", 32)).otherwise(F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)))
    cut = F.explode(F.array(*[
        F.shiftleft(F.lit(k).cast("long"), 8).bitwiseOR(F.shiftrightunsigned(other, 8 * k).bitwiseAND(F.lit(255))) for k in range(4)]))
    crowds = (
        found.filter("kind = 1").select(F.col("anchor"), F.col("a").alias("fingerprint"), cut.alias("_cut"))
        .select(F.xxhash64("anchor", "_cut").alias("anchor"), "fingerprint", F.lit(True).alias("home"))
        .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(rest, LINKS)
    )
    return found.filter("kind = 0").select("a", "b").unionByName(crowds.select("a", "b"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 hexadecimal digits) and component_id, the smallest id
    that can be reached over links.

    A null text has no words; all texts without words share fingerprint zero and link like any
    other.  Repeated rows share a component.  A null id is never a component's id unless all ids of
    the component are null.  Further columns are not read; an empty table gives an empty result.
    """
    marked = materialise(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min(F.col(f"`{id_column}`")).alias("_least")), "distinct")
    stars = components(links(distinct))
    rooted = distinct.join(stars.withColumnsRenamed({"a": "fingerprint", "b": "_root"}), "fingerprint", "left").withColumn(
        "_root", F.coalesce("_root", "fingerprint"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "_root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        id_column, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
