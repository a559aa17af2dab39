"""Sign-projection hashing of vectors, and nearest rows among bucket mates.

A vector is reduced to D bits, one per random plane: on which side of it the vector
lies.  Each of L tables picks k of the bits; rows that agree with a query in all k
bits of some table are its candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.blocks import Best, Queries, to_matrix, unit_rows, with_vectors
from millrace.operators.neighbours import (
    BROADCAST_BYTES, FOUND, SLICE_BYTES, data_rows, dimensions, in_fewer_tasks, query_rows, rows_within,
    search_cells, small_enough,
)
from millrace.session import materialise, ship_package

#: Bytes of a bucket's name and two numbers, beside its bits.
NAME_BYTES = 64
#: Slices that a bucket is cut into though it would fit fewer.
FEW_SLICES = 4


@dataclass(frozen=True)
class SignHash:
    """Parameters of the hash; equal parameters draw equal planes and picks."""

    planes: int
    bits: int
    tables: int
    seed: int

    def draw_planes(self, dims: int) -> np.ndarray:
        """Unit normals of the planes, one per row."""
        return unit_rows(np.random.default_rng(self.seed).normal(size=(self.planes, dims)))

    def draw_picks(self) -> np.ndarray:
        """Which bits each table looks at; a bit may be picked twice."""
        generator = np.random.default_rng(self.seed)
        return generator.integers(low=0, high=self.planes, size=(self.tables, self.bits))


def sides(matrix: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """1 where a row lies on the side of a plane's normal, else 0."""
    return (matrix @ planes.T > 0).astype(np.int32)


def names(bits: np.ndarray, picks: np.ndarray) -> pa.Array:
    """The picked bits of each row as text, one after the other for each table."""
    digits = np.ascontiguousarray(bits[:, picks] + ord("0"), dtype=np.uint8)
    return pa.array(digits.view(f"S{picks.shape[1]}").ravel()).cast(pa.string())


def _lists(flat: pa.Array, length: int, known: pa.Array) -> pa.Array:
    """``flat`` cut into lists of ``length``, with a null list where not ``known``."""
    steps = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(steps * length), flat, mask=pc.invert(known))


def sign_bits(df: DataFrame, planes: np.ndarray, vec: str = "vec", out: str = "bits") -> DataFrame:
    """Add one bit per plane: 1 where the vector lies on the side of its normal."""
    ship_package(df.sparkSession)

    @F.arrow_udf("array<int>")
    def project(vectors: pa.Array) -> pa.Array:
        known = vectors.is_valid()
        bits = sides(to_matrix(vectors.filter(known)).reshape(-1, planes.shape[1]), planes)
        return _lists(pa.array(bits.ravel()), len(planes), known)

    return df.withColumn(out, project(F.col(vec)))


def bucket_names(df: DataFrame, scheme: SignHash, dims: int, vec: str = "vec") -> DataFrame:
    """Add ``buckets``: the picked bits as text, one per table."""
    ship_package(df.sparkSession)
    planes, picks = scheme.draw_planes(dims), scheme.draw_picks()

    @F.arrow_udf("array<string>")
    def project(vectors: pa.Array) -> pa.Array:
        known = vectors.is_valid()
        bits = sides(to_matrix(vectors.filter(known)).reshape(-1, planes.shape[1]), planes)
        return _lists(names(bits, picks), len(picks), known)

    return df.withColumn("buckets", project(F.col(vec)))


def one_row_per_table(named: DataFrame, *keep: str) -> DataFrame:
    """``tbl, bucket`` and the columns to keep; rows without a vector go.

    The outer form of the generator, because for the inner form the optimizer adds a
    filter on the array, which would compute all buckets a second time.
    """
    per_table = named.select(F.posexplode_outer("buckets").alias("tbl", "bucket"), *keep)
    return per_table.filter(F.col("tbl").isNotNull())


def lsh_index(data: DataFrame, scheme: SignHash) -> DataFrame:
    """``tbl, bucket, id, vec``: each row once per table, hashed when it is read."""
    rows = data_rows(data)
    return one_row_per_table(bucket_names(rows, scheme, dimensions(rows)), "id", "vec")


def lsh_nearest(index: DataFrame, queries: DataFrame, scheme: SignHash, k: int = 3,
                query_block: int = 1024, max_broadcast_bytes: int = BROADCAST_BYTES,
                slice_rows: int | None = None) -> DataFrame:
    """The k candidates with the largest dot product per query: ``qid, rank, id, score``.

    Equal products go to the larger id.  ``k`` may be as large as the whole ranking.
    Rows that no query shares a bucket with are dropped before any vector is moved.
    Each task keeps k rows per query; a row that is among the best k of all
    candidates is among the best k of its bucket, so nothing is lost.

    Many queries meet the data bucket by bucket.  For that the names of the buckets are stored, and the vectors beside
    them once, so an id names one row.  A bucket with more rows than ``slice_rows`` (by default as many as fit
    ``SLICE_BYTES``) is cut into slices that different tasks hold, and its queries stream past each of them; there are at most
    ``FEW_SLICES``, or as many as ``SLICE_BYTES`` asks for.
    An index for many searches is ``lsh_store.StoredIndex``.
    """
    ship_package(index.sparkSession)
    asked = materialise(query_rows(queries), "queries")
    dims = dimensions(asked, index)
    table = small_queries(asked, max_broadcast_bytes, dims, k, scheme)
    if table is not None:
        found = _search_in_place(in_fewer_tasks(index, table.num_rows * k), table, scheme, query_block, k)
    else:
        entries = materialise(index.select("tbl", "bucket", "id"), "entries")
        vectors = materialise(index.filter("tbl = 0").select("id", "vec"), "vectors")
        found = search_buckets(entries, vectors, asked, scheme, dims, slice_rows, query_block, k)
    return ranked(found, k)


def small_queries(asked: DataFrame, max_bytes: int, dims: int, k: int, scheme: SignHash) -> pa.Table | None:
    """The stored queries if they, with a name for each table, are few enough to broadcast."""
    return small_enough(asked, max_bytes, dims, k, scheme.tables * (scheme.bits + NAME_BYTES))


def ranked(found: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("qid").orderBy(F.desc("score"), F.desc("id"))
    # A row found through several tables has one score, hence one rank, and the
    # second step needs no exchange of its own.
    return (
        found.withColumn("rank", F.dense_rank().over(best_first)).filter(F.col("rank") <= k)
        .dropDuplicates(["qid", "id"]).select("qid", "rank", "id", "score")
    )


def by_bucket(table: pa.Table, scheme: SignHash) -> tuple[Queries, pa.Table]:
    """The queries, and for each (tbl, bucket) of theirs the list of their places."""
    block = Queries.from_table(table, "qid", "dot")
    bits = sides(block.matrix, scheme.draw_planes(block.matrix.shape[1]))
    asked = pa.table({
        "place": np.repeat(np.arange(len(block)), scheme.tables),
        "tbl": np.tile(np.arange(scheme.tables, dtype=np.int32), len(block)),
        "bucket": names(bits, scheme.draw_picks()),
    })
    return block, asked.group_by(["tbl", "bucket"]).aggregate([("place", "list")])


def cell_name() -> Column:
    return F.concat_ws("|", F.col("tbl").cast("string"), "bucket")


def scan_buckets(hits: DataFrame, block: Queries, groups: pa.Table, query_block: int, k: int) -> DataFrame:
    """The best k of ``hits`` (cells, id, vec) for the queries of each row's cells."""
    places = {
        f"{number}|{name}": np.array(members)
        for number, name, members in zip(*(groups.column(c).to_pylist() for c in ("tbl", "bucket", "place_list")))
    }
    shared = hits.sparkSession.sparkContext.broadcast((block, places))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, places = shared.value
        best = Best(block, k, "dot", True, query_block)
        for batch in map(with_vectors, batches):
            if not batch.num_rows:
                continue
            ids, matrix = batch.column("id").to_numpy(zero_copy_only=False), to_matrix(batch.column("vec"))
            lists = batch.column("cells")
            rows = pc.list_parent_indices(lists).to_numpy()
            cells = lists.flatten().dictionary_encode()
            codes = cells.indices.to_numpy(zero_copy_only=False)
            by_cell = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[by_cell], np.arange(1, len(cells.dictionary)))
            for cell, members in zip(cells.dictionary.to_pylist(), np.split(rows[by_cell], cuts)):
                best.scan(ids[members], matrix[members], places[cell])
        yield best.rows()

    return hits.select("cells", "id", "vec").mapInArrow(scan, FOUND)


def _search_in_place(index: DataFrame, table: pa.Table, scheme: SignHash, query_block: int, k: int) -> DataFrame:
    spark = index.sparkSession
    if table.num_rows == 0:
        return spark.createDataFrame([], FOUND)
    block, groups = by_bucket(table, scheme)
    # The size check counted a name for each query and table, so these fit too.
    wanted = F.broadcast(spark.createDataFrame(groups.select(["tbl", "bucket"])))
    hits = index.join(wanted, ["tbl", "bucket"], "left_semi")
    return scan_buckets(hits.select(F.array(cell_name()).alias("cells"), "id", "vec"), block, groups, query_block, k)


def search_buckets(entries: DataFrame, vectors: DataFrame, asked: DataFrame, scheme: SignHash, dims: int, slice_rows: int | None,
                   query_block: int, k: int) -> DataFrame:
    """Bring rows and queries of each bucket together, from ``entries`` (tbl, bucket, id) and ``vectors`` (id, vec)."""
    held = max(1, rows_within(SLICE_BYTES, dims))
    per_slice = min(slice_rows or held, held)
    ask = one_row_per_table(bucket_names(asked, scheme, dims), "qid", "skip", "vec")
    # Each slice costs a copy of its bucket's queries, so beyond a few there are no more than memory asks for.
    size = F.count(F.lit(1))
    slices = F.least(F.ceil(size / per_slice), F.greatest(F.lit(FEW_SLICES), F.ceil(size / held)))
    plan = entries.groupBy("tbl", "bucket").agg(slices.cast("int").alias("slices"))

    # There are at most as many buckets as names, which bounds the plan's bytes.
    if (scheme.tables << scheme.bits) * (scheme.bits + NAME_BYTES) <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    mates = ask.select("tbl", "bucket").distinct()
    cell = F.concat_ws("|", *[F.col(part).cast("string") for part in ("tbl", "bucket", "slice")])
    # Rows without a bucket mate among the queries are dropped before any vector moves on.
    near = entries.join(mates, ["tbl", "bucket"], "left_semi").join(plan, ["tbl", "bucket"]).withColumn(
        "slice", F.pmod(F.xxhash64("id"), F.col("slices")))
    data = vectors.join(near.select(cell.alias("cell"), "id"), "id")
    query = ask.join(plan, ["tbl", "bucket"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def new_best(block: Queries, most: int) -> Best:
        return Best(block, most, "dot", True, query_block)

    return search_cells(
        data.select("cell", "id", "vec"), query.select(cell.alias("cell"), "qid", "skip", "vec"),
        None, new_best, "dot", k)
