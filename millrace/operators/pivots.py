"""Exact search for many queries, where most of the data is never met.

Rows are dealt to the cells of a tree of cuts, drawn from a sample, and each cell's rows are stored in slices of a
bounded size.  The box around a slice bounds the score of any row in it.  Queries are stored in blocks by their own
cell; a block first meets one slice there, which tells each query how good its k-th row is at least, and then only
slices whose bound reaches that for some query of the block.  Within a slice rows lie in leaves, small boxes of
their own, and a query is compared only with the leaves that it may still find something in.

No query is copied.  Which block meets which slice is a short list beside the block, and the two stored tables
are paired partition by partition: a task reads its slices and the blocks from storage, where pairs that are not on
the list fall away before any vector is looked at.  What is exchanged is each row of the data and each query,
twice at most (to its slice or block, and to the first meeting), and what is found.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import Best, Queries, to_matrix, unit_rows, with_vectors
from millrace.session import materialise

#: Cells at most, and rows of data sampled for each; they come to the driver.
MOST_CELLS, SAMPLED = 512, 16
#: Bytes of vectors in a stored slice of data and in a stored block of queries.
SLICE_BYTES, BLOCK_BYTES = 16 << 20, 4 << 20
#: Rows that a stored slice may have at least, and slices that there are at least if so.
SLICE_ROWS, LEAST_SLICES = 4096, 96
#: Rows of a leaf, a small box within a slice.
LEAF_ROWS = 256
#: Bounds that a task holds at once.
HELD_BOUNDS = 1 << 22
#: Share by which bounds are widened for rounding.
ROUNDING = 1e-9
FOUND = "qid bigint, id bigint, score double"


@dataclass(frozen=True)
class Cells:
    """A tree of cuts across single dimensions; its leaves are numbered cells."""

    dim: np.ndarray
    cut: np.ndarray
    #: Of a node its lower child, the upper follows; of a leaf its cell.
    below: np.ndarray
    many: int

    @classmethod
    def fit(cls, sample: np.ndarray, many: int) -> Cells:
        """Cells with about equally many rows of a sample, by cuts across the widest dimension."""
        dim, cut, below, cells = [-1], [0.0], [0], 0
        open_nodes = deque([(0, sample, many)])
        while open_nodes:
            node, rows, share = open_nodes.popleft()
            widest = int(rows.std(axis=0).argmax()) if share > 1 and len(rows) > 1 and rows.shape[1] else -1
            values = rows[:, widest] if widest >= 0 else rows[:0].ravel()
            at = float(np.median(values)) if len(values) else 0.0
            if len(values) and at >= values.max():
                at = float(values.min() / 2 + values.max() / 2)
            upper = values > at
            if not upper.any() or upper.all():
                below[node], cells = cells, cells + 1
                continue
            dim[node], cut[node], below[node] = widest, at, len(dim)
            for part, some in ((~upper, share // 2), (upper, share - share // 2)):
                open_nodes.append((len(dim), rows[part], some))
                dim.append(-1)
                cut.append(0.0)
                below.append(0)
        return cls(np.array(dim), np.array(cut), np.array(below), cells)

    def of(self, matrix: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        node, rows = np.zeros(len(matrix), dtype=np.int64), np.arange(len(matrix))
        while len(rows):
            rows = rows[self.dim[node[rows]] >= 0]
            here = node[rows]
            node[rows] = self.below[here] + (matrix[rows, self.dim[here]] > self.cut[here])
        return self.below[node].astype(np.int32)


def leaf_order(matrix: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Places of rows, so that each ``leaf_rows`` of them lie close together."""
    order, parts = np.arange(len(matrix)), [(0, len(matrix))]
    while parts:
        begin, end = parts.pop()
        if end - begin <= leaf_rows:
            continue
        rows = matrix[order[begin:end]]
        widest = int((rows.max(axis=0) - rows.min(axis=0)).argmax())
        lower = -(-(end - begin) // leaf_rows) // 2 * leaf_rows
        order[begin:end] = order[begin:end][np.argpartition(rows[:, widest], lower)]
        parts += [(begin, begin + lower), (begin + lower, end)]
    return order


def best_possible(asked: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """No row within a box from ``low`` to ``high`` scores higher for a query than this."""
    reach = np.maximum(np.abs(low), np.abs(high))
    size = (asked * asked).sum(axis=1)[:, None] + (reach * reach).sum(axis=1)[None, :]
    if metric == "dot":
        return np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T + ROUNDING * size
    gap = np.zeros((len(asked), len(low)))
    if len(low) < asked.shape[1]:  # by box or by dimension, whichever are fewer
        for at in range(len(low)):
            far = np.maximum(low[at] - asked, asked - high[at])
            np.maximum(far, 0, out=far)
            gap[:, at] = np.einsum("ij,ij->i", far, far)
    for at in range(asked.shape[1] if len(low) >= asked.shape[1] else 0):
        own = asked[:, at, None]
        far = np.maximum(low[None, :, at] - own, own - high[None, :, at])
        np.maximum(far, 0, out=far)
        far *= far
        gap += far
    if metric == "cosine":
        return 1 - gap / 2 + ROUNDING * size
    return ROUNDING * size - gap


class Leaves:
    """The rows of a stored slice, leaf by leaf."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, leaf_rows: int) -> None:
        self.ids, self.matrix, self.leaf_rows = ids, matrix, leaf_rows
        starts = np.arange(0, len(ids), leaf_rows)
        self.low, self.high = np.minimum.reduceat(matrix, starts), np.maximum.reduceat(matrix, starts)

    def offer(self, best: Best) -> None:
        """Offer all rows that may be among the best of some query."""
        whole = best_possible(best.queries.matrix, self.low.min(axis=0)[None, :], self.high.max(axis=0)[None, :], best.metric)[:, 0]
        asking = np.flatnonzero(whole >= best.bar(np.arange(len(whole))))
        step = max(1, HELD_BOUNDS // len(self.low))
        for first in range(0, len(asking), step):
            self._offer(best, asking[first:first + step])

    def _offer(self, best: Best, asking: np.ndarray) -> None:
        bound = best_possible(best.queries.matrix[asking], self.low, self.high, best.metric)
        # A query's most promising leaf comes first, so that it needs few of the others.
        nearest = bound.argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1):
            self._scan(best, int(nearest[places[0]]), asking[places])
        bound[np.arange(len(asking)), nearest] = -np.inf
        reached = bound >= best.bar(asking)[:, None]
        if 2 * np.count_nonzero(reached) > reached.size:
            best.scan(self.ids, self.matrix, asking)
            return
        for leaf in np.flatnonzero(reached.any(axis=0)).tolist():
            places = np.flatnonzero(reached[:, leaf])
            places = places[bound[places, leaf] >= best.bar(asking[places])]
            if len(places):
                self._scan(best, leaf, asking[places])

    def _scan(self, best: Best, leaf: int, places: np.ndarray) -> None:
        rows = slice(leaf * self.leaf_rows, (leaf + 1) * self.leaf_rows)
        best.scan(self.ids[rows], self.matrix[rows], places)


def _doubles(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<f8").reshape(rows, -1)


@dataclass(frozen=True)
class PivotSearch:
    """Stored slices (slice, ids, vecs, box) and blocks (qids, skips, vecs, floors, meets) of one search."""

    slices: DataFrame
    blocks: DataFrame
    new_best: Callable[[Queries, int], Best]
    k: int
    leaf_rows: int

    def found(self) -> DataFrame:
        """The best k rows of each query in each slice that its block meets: ``qid, id, score``."""
        new_best, k, leaf_rows = self.new_best, self.k, self.leaf_rows

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[int, Leaves] | None = None
            for batch in batches:
                for at in range(batch.num_rows):
                    number, ids, vecs, qids, skips, asked, floors = (column[at].as_buffer() if pa.types.is_binary(column.type) else column[at].as_py() for column in batch.columns)
                    if held is None or held[0] != number:
                        ids = np.frombuffer(ids, dtype="<i8")
                        held = number, Leaves(ids, _doubles(vecs, len(ids)), leaf_rows)
                    qids = np.frombuffer(qids, dtype="<i8")
                    best = new_best(Queries(qids, np.frombuffer(skips, dtype="<i8"), _doubles(asked, len(qids))), min(k, len(held[1].ids)))
                    best.floor = np.frombuffer(floors, dtype="<f8")
                    held[1].offer(best)
                    yield best.rows()

        pairs = self.slices.join(self.blocks.withColumnRenamed("vecs", "asked"), F.array_contains("meets", F.col("slice")))
        return pairs.select("slice", "ids", "vecs", "qids", "skips", "asked", "floors").mapInArrow(scan, FOUND)

    def skipped(self) -> DataFrame:
        """One row: ``pairs`` of a query and a data row in all, ``met`` those that were compared, and ``share`` skipped."""
        rows = self.slices.select("slice", (F.length("ids") / 8).alias("rows"))
        asked = self.blocks.select((F.length("qids") / 8).alias("queries"), F.explode("meets").alias("slice"))
        met = asked.groupBy("slice").agg(F.sum("queries").alias("queries")).join(rows, "slice").agg(F.sum(F.col("queries") * F.col("rows")).alias("met"))
        total = rows.agg(F.sum("rows").alias("rows")).join(self.blocks.agg(F.sum(F.length("qids") / 8).alias("queries")))
        return total.join(met).select((F.col("rows") * F.col("queries")).alias("pairs"), "met").withColumn("share", 1 - F.col("met") / F.col("pairs"))


def pivot_search(rows: DataFrame, asked: DataFrame, count: int, dims: int, slice_rows: int | None, new_best: Callable[[Queries, int], Best],
                 metric: str, k: int) -> PivotSearch:
    """Prepare a search of ``rows`` (id, vec), of which there are ``count``, for stored ``asked`` (qid, skip, vec)."""
    spark = rows.sparkSession
    # Few rows a slice make many leaves, not many slices: what pairs of slices and blocks cost does not grow with their rows.
    wanted = slice_rows or min(max(1, SLICE_BYTES // (8 * max(1, dims) + 8)), max(SLICE_ROWS, count // LEAST_SLICES))
    leaf_rows = min(LEAF_ROWS, wanted)
    per_slice = max(wanted, min(math.ceil(count / LEAST_SLICES), SLICE_BYTES // (8 * max(1, dims) + 8)))
    per_block = max(1, min(BLOCK_BYTES // (8 * max(1, dims) + 24), per_slice))
    many = max(1, min(MOST_CELLS, 2 * math.ceil(count / per_slice)))
    tasks = 4 * spark.sparkContext.defaultParallelism

    def vectors(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        batch = with_vectors(batch)
        if not batch.num_rows:
            return batch, np.zeros((0, dims))
        matrix = to_matrix(batch.column("vec"))
        matrix = unit_rows(matrix) if metric == "cosine" else matrix
        good = np.isfinite(matrix).all(axis=1)
        return batch.filter(pa.array(good)), matrix[good]

    # A sample of bounded size places the cuts; every row is dealt to one cell.
    fraction = min(1.0, 2 * SAMPLED * many / max(1, count))
    some = rows.select("vec").sample(fraction, 7).limit(SAMPLED * many).toArrow().combine_chunks()
    sample = vectors(some.to_batches()[0])[1] if some.num_rows else np.zeros((0, dims))
    tree = Cells.fit(sample, many)
    shared = spark.sparkContext.broadcast(tree)

    def deal(name: str, extra: tuple[str, ...]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, matrix = vectors(batch)
                if not kept.num_rows:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shared.value.of(matrix)), kept.column(name), *[kept.column(column) for column in extra],
                     pa.array([row.tobytes() for row in np.ascontiguousarray(matrix, dtype="<f8")], pa.binary())],
                    ["cell", name, *extra, "vec"])
        return work

    def in_cells(dealt: DataFrame, most: int) -> dict[int, int]:
        """Of each cell that has rows, how many parts of ``most`` rows it is cut into."""
        return {row.cell: math.ceil(row.n / most) for row in dealt.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()}

    def numbered(values: dict[int, int]) -> Column:
        """A number per cell, as few as there are cells."""
        return F.get(F.array(*[F.lit(values.get(cell, 0)) for cell in range(tree.many)]), F.col("cell"))

    dealt = materialise(rows.select("id", "vec").mapInArrow(deal("id", ()), "cell int, id bigint, vec binary"), "dealt")
    cuts = in_cells(dealt, per_slice)
    firsts = dict(zip(cuts, np.cumsum([0, *cuts.values()]).tolist()))
    slice_of = (numbered(firsts) + F.pmod(F.xxhash64("id"), numbered(cuts).cast("bigint")).cast("int")).alias("slice")
    parts = max(1, min(tasks, sum(cuts.values())))
    slices = materialise(dealt.select(slice_of, "id", "vec").repartition(parts, "slice").sortWithinPartitions("slice").mapInArrow(
        _pack("slice", ("id",), 1 << 62, leaf_rows), "slice int, ids binary, vecs binary, box binary"), "slices")
    if not cuts:
        empty = spark.createDataFrame([], "qids binary, skips binary, vecs binary, floors binary, meets array<int>")
        return PivotSearch(slices, empty, new_best, k, leaf_rows)

    # A block of queries has one cell, and meets a slice there (or of the next cell that has rows) first.
    near = materialise(asked.select("qid", F.coalesce("skip", F.lit(np.iinfo(np.int64).min)).alias("skip"), "vec").mapInArrow(
        deal("qid", ("skip",)), "cell int, qid bigint, skip bigint, vec binary"), "dealt-queries")
    shares, full = in_cells(near, per_block), np.array(list(cuts))
    home = {cell: int(full[min(np.searchsorted(full, cell), len(full) - 1)]) for cell in range(tree.many)}
    share = F.pmod(F.xxhash64("qid"), F.greatest(numbered(shares), F.lit(1)).cast("bigint"))
    where = numbered({cell: firsts[full] for cell, full in home.items()}) + F.pmod(
        share, numbered({cell: cuts[full] for cell, full in home.items()}).cast("bigint")).cast("int")
    packed = near.select(where.alias("home"), "cell", share.alias("share"), "qid", "skip", "vec").repartition(parts, "home").sortWithinPartitions(
        "home", "cell", "share").mapInArrow(_pack("home", ("qid", "skip"), per_block), "home int, qids binary, skips binary, vecs binary")
    # A box a slice.
    boxes = {row.slice: _doubles(row.box, 2) for row in slices.select("slice", "box").collect()}
    numbers = np.array(sorted(boxes), dtype=np.int32)
    walls = spark.sparkContext.broadcast((numbers, *(np.array([boxes[number][side] for number in numbers.tolist()]) for side in (0, 1))))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qids, ids = np.frombuffer(row["qids"], dtype="<i8"), np.frombuffer(row["ids"], dtype="<i8")
                queries = Queries(qids, np.frombuffer(row["skips"], dtype="<i8"), _doubles(row["asked"], len(qids)))
                best = new_best(queries, k)
                Leaves(ids, _doubles(row["vecs"], len(ids)), leaf_rows).offer(best)
                floors, (numbers, low, high) = best.scores[:, -1].copy(), walls.value
                reach, step = np.zeros(len(numbers), dtype=bool), max(1, HELD_BOUNDS // len(numbers))
                for at in range(0, len(qids), step):
                    reach |= (best_possible(queries.matrix[at:at + step], low, high, metric) >= floors[at:at + step, None]).any(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["qids"]], pa.binary()), pa.array([row["skips"]], pa.binary()), pa.array([row["asked"]], pa.binary()),
                     pa.array([floors.astype("<f8").tobytes()], pa.binary()), pa.array([numbers[reach]], pa.list_(pa.int32()))],
                    ["qids", "skips", "vecs", "floors", "meets"])

    first = packed.withColumnRenamed("vecs", "asked").join(slices.repartition(parts, "slice"), F.col("home") == F.col("slice"))
    blocks = materialise(first.select("qids", "skips", "asked", "ids", "vecs").mapInArrow(
        ask, "qids binary, skips binary, vecs binary, floors binary, meets array<int>"), "blocks")
    return PivotSearch(slices, blocks, new_best, k, leaf_rows)


def _pack(key: str, numbers: tuple[str, ...], most: int, leaf_rows: int = 0):
    """Task function that joins rows with equal keys, at most ``most``, to one row of bytes: key, a field of 64-bit numbers
    for each of ``numbers``, and the vectors; with ``leaf_rows`` in the order of leaves, and with the box around them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            fields = [table.column(name).to_numpy().astype("<i8") for name in numbers]
            vecs, box = b"".join(value.as_buffer() for value in table.column("vec")), []
            if leaf_rows:
                matrix = _doubles(vecs, len(table))
                order = leaf_order(matrix, leaf_rows)
                fields, vecs = [field[order] for field in fields], matrix[order].tobytes()
                box = [pa.array([np.array([matrix.min(axis=0), matrix.max(axis=0)]).astype("<f8").tobytes()], pa.binary())]
            stored = [pa.array([data], pa.binary()) for data in (*[field.tobytes() for field in fields], vecs)]
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *stored, *box], [key, *[f"{name}s" for name in numbers], "vecs", *["box"][:len(box)]])

        for batch in batches:
            keys = batch.column(key).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                while begin < end:
                    if held and (int(keys[begin]) != at or size >= most):
                        yield made()
                        held, size = [], 0
                    at = int(keys[begin])
                    step = min(end - begin, most - size)
                    held.append(batch.slice(begin, step))
                    begin, size = begin + step, size + step
        if held:
            yield made()

    return work
