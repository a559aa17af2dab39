"""Exact nearest rows for many queries, by cosine, dot product or distance.

``data`` has ``id bigint, vec array``; ``queries`` has ``qid bigint, vec array`` and
may have ``skip bigint``, the id that this query must not return (itself).  The
result has ``qid, rank, id, score``, where ``score`` is the similarity or, for the
distance metrics, the (squared, if expanded) distance.

The pairs are never written out.  Each task keeps the best k rows per query of its
share of the data, and only those are exchanged.

* Queries are computed once, into a stored table whose size is then known.  If they fit a
  checked number of bytes, and make few pairs, they are broadcast, and the data is read where it lies.
* If not, both sides are stored by cells, queries meet only data that bounds cannot rule out, and
  no query is copied (``pivots``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.blocks import METRICS, Best, Queries, to_matrix, with_vectors
from millrace.operators.pivots import pivot_search
from millrace.session import materialise, ship_package

FOUND = "qid bigint, id bigint, score double"
ROWS_PER_BATCH_OUT = 20_000

BROADCAST_BYTES = 64 << 20
SLICE_BYTES = 64 << 20
#: Scores that a task holds at once, best so far of its queries.
HELD_SCORES = 1 << 22
FOUND_ROWS = 1_000_000_000
#: Pairs of a query and a row that are all compared; up to so many queries the rows are not counted.
FEW_PAIRS, FEW_QUERIES = 1 << 28, 1 << 10


def data_rows(data: DataFrame) -> DataFrame:
    return data.select(F.col("id").cast("bigint").alias("id"), "vec")


def query_rows(queries: DataFrame) -> DataFrame:
    skip = F.col("skip") if "skip" in queries.columns else F.lit(None)
    return queries.select(F.col("qid").cast("bigint").alias("qid"), skip.cast("bigint").alias("skip"), "vec")


def dimensions(*tables: DataFrame) -> int:
    """Length of the vectors, read from a row of the first table that has one, else 0."""
    for df in tables:
        lengths = df.select(F.size("vec").alias("d"))
        # Mostly the first row has a vector; a filter would compute vectors twice.
        for some in (lengths, lengths.filter(F.col("d") > 0)):
            first = some.first()
            if first and first.d and first.d > 0:
                return first.d
    return 0


def rows_within(max_bytes: int, dims: int, more: int = 0) -> int:
    """How many vectors fit, with their two ids and ``more`` bytes each."""
    return max_bytes // (8 * dims + 16 + more)


def small_enough(stored: DataFrame, max_bytes: int, dims: int, k: int, more: int = 0) -> pa.Table | None:
    """The rows of a stored table that have a vector, if all fit, else None.

    They fit if they take at most ``max_bytes``, and k scores for each at most ``HELD_SCORES``.
    The rows are counted first, which a stored table answers from its files' footers.
    """
    rows = stored.count()
    if rows > rows_within(max_bytes, dims, more) or rows * k > HELD_SCORES:
        return None
    table = stored.toArrow()
    return table.filter(table.column("vec").is_valid())


def rank_found(found: DataFrame, k: int) -> DataFrame:
    """Merge the best rows of all tasks to the best k per query."""
    best_first = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return (
        found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
        .select("qid", "rank", "id", "score")
    )


def in_fewer_tasks(rows: DataFrame, found_per_task: int) -> DataFrame:
    """Let a task read several splits where tasks would send more rows than need be.

    Every task sends the best k rows of each query, so the number of tasks times that
    is exchanged: about ``FOUND_ROWS``, but all cores stay busy, which counts more where
    there are many.  No exchange is added.
    """
    busy = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(busy, FOUND_ROWS // max(1, found_per_task)))


def regrouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join many short batches to fewer long ones."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= ROWS_PER_BATCH_OUT:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of each run of equal values."""
    if len(column) == 0:
        return
    changes = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
    starts = np.concatenate([[0], np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1])
    ends = np.append(starts[1:], len(column))
    for start, end in zip(starts.tolist(), ends.tolist()):
        yield start, end - start


def scan_cells(new_best: Callable[[Queries, int], Best], metric: str, k: int):
    """Task function over rows ``cell, side, id, skip, vec`` sorted by cell and side.

    In each cell the data (side 0) comes first and is held; the queries (side 1) stream past it,
    as many at a time as ``HELD_SCORES`` allows.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: object = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for start, length in runs(batch.column("cell")):
                here = with_vectors(batch.slice(start, length))
                if not here.num_rows:
                    continue
                name = here.column("cell")[0].as_py()
                if name != cell:
                    cell, held = name, []
                data = int(pc.sum(pc.equal(here.column("side"), 0)).as_py() or 0)
                if data:
                    part = here.slice(0, data)
                    held.append((part.column("id").to_numpy(zero_copy_only=False), to_matrix(part.column("vec"))))
                if data == here.num_rows or not held:
                    continue
                if len(held) > 1:
                    held = [(np.concatenate([ids for ids, _ in held]), np.concatenate([matrix for _, matrix in held]))]
                ids, matrix = held[0]
                step = max(1, HELD_SCORES // min(k, len(ids)))
                for first in range(data, here.num_rows, step):
                    asked = pa.Table.from_batches([here.slice(first, step)])
                    best = new_best(Queries.from_table(asked, "id", metric), min(k, len(ids)))
                    best.scan(ids, matrix)
                    yield best.rows()

    return lambda batches: regrouped(scan(batches))


def search_cells(data: DataFrame, queries: DataFrame, partitions: int | None,
                 new_best: Callable[[Queries, int], Best], metric: str, k: int) -> DataFrame:
    """Bring the data and the queries of each cell together and search there.

    ``data`` has ``cell, id, vec`` and ``queries`` has ``cell, qid, skip, vec``.
    """
    both = data.select(
        "cell", F.lit(0).alias("side"), "id", F.lit(None).cast("bigint").alias("skip"),
        F.col("vec").cast("array<double>").alias("vec"),
    ).unionByName(queries.select(
        "cell", F.lit(1).alias("side"), F.col("qid").alias("id"), "skip",
        F.col("vec").cast("array<double>").alias("vec"),
    ))
    placed = both.repartition(partitions, "cell") if partitions else both.repartition("cell")
    return placed.sortWithinPartitions("cell", "side").mapInArrow(scan_cells(new_best, metric, k), FOUND)


def nearest(data: DataFrame, queries: DataFrame, k: int = 1, metric: str = "l2",
            query_block: int = 1024, max_broadcast_bytes: int = BROADCAST_BYTES,
            slice_rows: int | None = None) -> DataFrame:
    """The k best rows per query; equal scores go to the smaller id.

    ``query_block`` bounds the score matrix in a task, ``slice_rows`` the data that many queries meet at
    once; neither changes results.  Rows and queries without a vector are left
    out, and under ``cosine`` so are zero vectors.  Runs when called: the queries are computed and
    stored once.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k < 1 or query_block < 1:
        raise ValueError("k and query_block must be positive")
    ship_package(data.sparkSession)
    rows, asked = data_rows(data), materialise(query_rows(queries), "queries")

    def new_best(block: Queries, most: int) -> Best:
        return Best(block, most, metric, False, query_block)

    dims = dimensions(asked, rows)
    many = asked.count()
    count = rows.count() if many > FEW_QUERIES or not max_broadcast_bytes else 0
    table = small_enough(asked, max_broadcast_bytes, dims, k) if many * count <= FEW_PAIRS else None
    if table is not None:
        found = _search_in_place(in_fewer_tasks(rows, table.num_rows * k), table, new_best, metric, k)
    else:
        found = pivot_search(rows, asked, count or rows.count(), dims, slice_rows, new_best, metric, k).found()
    ranked = rank_found(found, k)
    if metric == "l2":
        return ranked.withColumn("score", F.sqrt(-F.col("score")))
    return ranked.withColumn("score", -F.col("score")) if metric == "l2_expanded" else ranked


def _search_in_place(rows: DataFrame, table: pa.Table, new_best: Callable[[Queries, int], Best],
                     metric: str, k: int) -> DataFrame:
    if table.num_rows == 0:
        return rows.sparkSession.createDataFrame([], FOUND)
    block = Queries.from_table(table, "qid", metric)
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = new_best(shared.value, k)
        for batch in map(with_vectors, batches):
            if batch.num_rows:
                best.scan(batch.column("id").to_numpy(zero_copy_only=False), to_matrix(batch.column("vec")))
        yield best.rows()

    return rows.mapInArrow(scan, FOUND)
