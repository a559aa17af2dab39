"""Delimited sources, and sinks."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ship_package

SINK_FORMATS = ("parquet", "json", "csv")
# The columns of climate files that are used.
CLIMATE_COLUMNS = ("STATION", "NAME", "DATE", "TMIN", "TMAX")


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    """Resource rows by position: ``constellation, star, units`` from fields 0, 1, 5.

    Fields are parted at every comma; quotes mean nothing.  A header is known by its
    first field, so headers inside joined files go as well.
    """
    fields = F.split("value", ",")
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.filter(fields[0] != "Constellation").select(
        fields[0].alias("constellation"), fields[1].alias("star"),
        F.trim(fields[5]).cast("bigint").alias("units"))


def _first_lines(spark: SparkSession, path: str) -> dict[int, str]:
    """By hash of its path, the first line of each file that could be cut into splits.

    One task step a file, which stops at its first line, so that a buffer of each file is read.  Files of less than
    ``spark.sql.files.openCostInBytes`` are never cut and have no entry; the others are at most
    as many as that size fits into the input.
    """
    files = {name: spark.conf.get(f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes")}
    least = min(int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)) for size in files.values())
    large = spark.read.text(path).filter((F.col("_metadata.file_size") >= least) & (F.col("value") != "")).select(
        F.xxhash64("_metadata.file_path").alias("file"), "value")
    try:  # the splits of a scan are laid out when it becomes an RDD: here a file each
        for name in files:
            spark.conf.set(f"spark.sql.files.{name}", str(1 << 62))
        lines = large.rdd
        parts = lines.getNumPartitions()
    finally:
        for name, size in files.items():
            spark.conf.set(f"spark.sql.files.{name}", size)
    if not parts:
        return {}
    firsts = lines.mapPartitions(lambda rows: islice(rows, 1))
    return {row.file: row.value for row in firsts.coalesce(min(parts, 4 * spark.sparkContext.defaultParallelism)).collect()}


def _fields(line: str) -> list[str]:
    return next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"), [])


def _columns(values: pa.Array, places: list[int], width: int) -> list[pa.Array]:
    """The fields at ``places`` of CSV lines; absent and empty ones are null, further ones are left out."""
    data = b"\n".join(value.as_buffer() for value in values.cast(pa.binary()))
    names = [str(place) for place in range(width)]
    try:
        table = arrow_csv.read_csv(
            pa.BufferReader(data), arrow_csv.ReadOptions(column_names=names, use_threads=False, block_size=max(1 << 20, len(data) + 1)),
            arrow_csv.ParseOptions(escape_char="\\", newlines_in_values=False),
            arrow_csv.ConvertOptions(
                include_columns=[str(place) for place in places], column_types={name: pa.string() for name in names},
                null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True))
        if table.num_rows == len(values):
            return [table.column(str(place)).combine_chunks() for place in places]
    except pa.ArrowInvalid:  # lines of other lengths than the header
        pass
    rows = [_fields(value) for value in values.to_pylist()]
    return [pa.array([row[place] or None if place < len(row) else None for row in rows], pa.string()) for place in places]


def read_by_name(spark: SparkSession, path: str, names: tuple[str, ...], infer: bool = False) -> DataFrame:
    """The named columns of CSV files with a header, each file by its own header, as text.

    Files may have further columns, and any order of them; a file without one of the names is an error when it
    is read.  Empty fields, quoted or not, are null, and so are those that a line lacks; a line is a
    record.  The files are read once: a task that reads the beginning of a file learns its header there, and
    for parts further on the first lines of large files are read when this is called.  ``infer`` gives each
    column the narrowest type that holds all its values, at the cost of another pass.
    """
    ship_package(spark)
    lines = spark.read.text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value").filter(F.trim("value") != "")
    large = spark.sparkContext.broadcast(_first_lines(spark, path))

    def layout(header: str) -> tuple[list[int], int]:
        fields = _fields(header)
        if missing := [name for name in names if name not in fields]:
            raise ValueError(f"no column {missing} in a file with the header {header!r}")
        return [fields.index(name) for name in names], len(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = None, None
        for batch in batches:
            file, start = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if (file[begin], start[begin]) != at:
                    at = file[begin], start[begin]
                    if start[begin] == 0:
                        known = layout(batch.column(2)[begin].as_py())
                        begin += 1
                    elif int(file[begin]) in large.value:
                        known = layout(large.value[int(file[begin])])
                    else:
                        raise ValueError("files are cut into smaller splits than when they were opened; open them anew")
                if begin < end:
                    yield pa.RecordBatch.from_arrays(_columns(batch.column(2).slice(begin, end - begin), *known), list(names))

    table = lines.mapInArrow(work, ", ".join(f"`{name}` string" for name in names))
    return _typed(table) if infer else table


#: Types that ``infer`` tries, narrowest first.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _typed(table: DataFrame) -> DataFrame:
    """Columns of text cast to the narrowest type that all their values have; text if none, or without values."""
    def fit(name: str, kind: str) -> str:
        return f"lower(trim(`{name}`)) IN ('true', 'false')" if kind == "boolean" else f"try_cast(trim(`{name}`) AS {kind}) IS NOT NULL"

    fits = {(name, kind): F.expr(f"bool_and(`{name}` IS NULL OR {fit(name, kind)}) AND count(`{name}`) > 0") for name in table.columns for kind in INFERRED}
    said = table.agg(*[whole.alias(f"{name} {kind}") for (name, kind), whole in fits.items()]).first()
    kinds = {name: next((kind for kind in INFERRED if said[f"{name} {kind}"]), None) for name in table.columns}
    return table.select([F.trim(name).cast(kind).alias(name) if kind else F.col(name) for name, kind in kinds.items()])


def read_climate(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Daily readings from CSV with a header: ``station, name, date, tmin, tmax``.

    Columns are found by name, in each file by its own header, and cast to fixed types.
    ``infer`` gives each the narrowest type that holds its values, at the cost of another pass.
    """
    table = read_by_name(spark, path, CLIMATE_COLUMNS, infer)
    if infer:
        return table.select(*[F.col(c).alias(c.lower()) for c in CLIMATE_COLUMNS])
    return table.select(
        F.col("STATION").alias("station"), F.col("NAME").alias("name"),
        F.col("DATE").cast("date").alias("date"),
        F.trim("TMIN").cast("double").alias("tmin"), F.trim("TMAX").cast("double").alias("tmax"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Named points from CSV with a header: ``label, vec`` with easting and northing."""
    table = read_by_name(spark, path, ("name", "easting", "northing"))
    return table.select(
        F.col("name").alias("label"),
        F.array(F.col("easting").cast("float"), F.col("northing").cast("float")).alias("vec"))


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Store a result as parquet, JSON lines or CSV with a header, in parallel."""
    if fmt not in SINK_FORMATS:
        raise ValueError(f"format must be one of {SINK_FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
