"""An index of sign-projection hashing that outlives a search: fit once, opened often, appended to.

Below its path lie ``scheme`` (a JSON row), ``vectors`` (id, vec, part), each vector once, and ``entries`` (tbl,
bucket, id, part), the names of its buckets.  Both are tables bucketed on disk, vectors by id and entries
by tbl and bucket, so that a search exchanges neither: the few entries whose buckets its queries share
go to where the vectors lie.  A search hashes the queries alone and writes nothing but them.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.lsh import (
    BROADCAST_BYTES, SignHash, bucket_names, by_bucket, cell_name, one_row_per_table, ranked, scan_buckets, search_buckets, small_queries,
)
from millrace.operators.neighbours import FOUND, data_rows, dimensions, query_rows
from millrace.session import materialise, ship_package

#: Bytes of vectors in one bucket of the table, about.
BUCKET_BYTES = 128 << 20


class StoredIndex:
    """An index at a path; ``build`` makes one, ``open`` takes one that is there."""

    def __init__(self, spark: SparkSession, path: str, scheme: SignHash, dims: int, buckets: int) -> None:
        self.spark, self.path, self.scheme, self.dims, self.buckets = spark, path, scheme, dims, buckets
        ship_package(spark)
        # The catalog only learns how the files are laid out; a session that ends forgets it, the files stay.
        self._names = {}
        for table, columns, keys in (("vectors", "id BIGINT, vec ARRAY<DOUBLE>, part INT", "id"), ("entries", "tbl INT, bucket STRING, id BIGINT, part INT", "tbl, bucket")):
            name = self._names[table] = f"millrace_{table}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
            place = f"{path}/{table}".replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'")

    @classmethod
    def build(cls, data: DataFrame, scheme: SignHash, path: str, buckets: int | None = None) -> StoredIndex:
        """Hash and store ``data`` (id, vec) at a new path.  Rows without a vector are left out; an id names one row.

        ``buckets`` is the number of files that vectors are dealt to, by default one for each ``BUCKET_BYTES``
        and a few more, for what will be appended.
        """
        spark, rows = data.sparkSession, data_rows(data)
        dims = dimensions(rows)
        if buckets is None:
            buckets = max(8, math.ceil(2 * rows.count() * (8 * max(dims, 1) + 8) / BUCKET_BYTES))
        described = spark.createDataFrame([(*asdict(scheme).values(), dims, buckets)], [*asdict(scheme), "dims", "buckets"])
        described.coalesce(1).write.json(f"{path}/scheme")
        index = cls(spark, path, scheme, dims, buckets)
        index.append(rows)
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> StoredIndex:
        row = spark.read.json(f"{path}/scheme").first().asDict()
        return cls(spark, path, SignHash(row["planes"], row["bits"], row["tables"], row["seed"]), row["dims"], row["buckets"])

    def vectors(self) -> DataFrame:
        return self.spark.table(self._names["vectors"])

    def entries(self) -> DataFrame:
        return self.spark.table(self._names["entries"])

    def append(self, data: DataFrame) -> None:
        """Add rows with new ids.  Vectors go first: what has no entry is never found, so that an append that failed
        between the two shows nothing, and can be repeated."""
        self.spark.catalog.refreshTable(self._names["vectors"])
        last = self.vectors().agg(F.max("part")).first()[0]
        part = 0 if last is None else last + 1
        rows = data_rows(data).select("id", F.col("vec").cast("array<double>").alias("vec"), F.lit(part).alias("part"))
        self._dealt(rows.filter("vec IS NOT NULL"), "id").write.insertInto(self._names["vectors"])
        if not self.dims:
            self.dims = dimensions(self.vectors())
        added = self.vectors().filter(F.col("part") == part)
        named = one_row_per_table(bucket_names(added.select("id", "vec"), self.scheme, self.dims), "id") if self.dims else None
        if named is not None:
            self._dealt(named.select("tbl", "bucket", "id", F.lit(part).alias("part")), "tbl", "bucket").write.insertInto(self._names["entries"])

    def _dealt(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows dealt as the table's buckets are, so that a task writes one file."""
        return rows.repartition(self.buckets, *keys)

    def nearest(self, queries: DataFrame, k: int = 3, query_block: int = 1024, max_broadcast_bytes: int = BROADCAST_BYTES,
                slice_rows: int | None = None) -> DataFrame:
        """As ``lsh_nearest``: the k candidates with the largest dot product per query, ``qid, rank, id, score``."""
        asked = materialise(query_rows(queries), "queries")
        entries, vectors = self.entries(), self.vectors()
        table = small_queries(asked, max_broadcast_bytes, self.dims, k, self.scheme)
        if not self.dims or table is not None and table.num_rows == 0:
            return ranked(self.spark.createDataFrame([], FOUND), k)
        if table is None:
            current = vectors.select("id", "vec", "part")
            return ranked(search_buckets(entries.select("tbl", "bucket", "id"), self._found_once(current, entries), asked, self.scheme, self.dims, slice_rows, query_block, k), k)
        block, groups = by_bucket(table, self.scheme)
        # The size check counted a name for each query and table.
        wanted = F.broadcast(self.spark.createDataFrame(groups.select(["tbl", "bucket"])))
        hits = entries.join(wanted, ["tbl", "bucket"], "left_semi").groupBy("id").agg(F.collect_set(cell_name()).alias("cells"), F.max("part").alias("_part"))
        # Not an equality of columns: that would become a join key, by which the vectors do not lie.
        rows = vectors.join(hits, "id").filter("part - _part = 0").select("cells", "id", "vec")
        return ranked(scan_buckets(rows, block, groups, query_block, k), k)

    def _found_once(self, vectors: DataFrame, entries: DataFrame) -> DataFrame:
        """Vectors of the parts that have entries: one that a failed append left behind has none."""
        whole = entries.select("part").distinct()
        return vectors.join(F.broadcast(whole), "part", "left_semi").select("id", "vec")
