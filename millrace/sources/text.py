"""Text sources: corpora, graph lines, word vectors, query lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip_blanks
from millrace.session import materialise, scratch_dir
from millrace.sources.hidden import hidden_files, read_hidden


def read_corpus(spark: SparkSession, path: str, whole_files: bool = False, skip_hidden: bool = False) -> DataFrame:
    """All ``.txt`` files below a folder, or below the folders that a glob names: ``path, text``.

    One row per line, so that a large file is shared among tasks; counts per file group by ``path``.
    With ``whole_files`` one row per file.  Files whose names, or whose folders' names, begin with a dot or
    an underscore are read as well, unless ``skip_hidden`` says that they are to be left out.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
    lines = reader.text(path, wholetext=whole_files).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    if not skip_hidden and (hidden := hidden_files(spark, path)):
        lines = lines.unionByName(read_hidden(spark, hidden, whole_files))
    return lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``."""
    return spark.read.text(path)


def pinned(spark: SparkSession) -> SparkSession:
    """A session of the same application whose scans cut files as this one would now, whatever cores there are and
    settings become later."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    session = spark.newSession()
    # With both equal the size of a split does not depend on the number of cores.
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", size)
    return session


def number_rows(spark: SparkSession, path: str, keep: Column | None = None,
                number: str = "line") -> DataFrame:
    """Lines of a text source with their position from 0: ``line, value``.

    ``keep`` chooses lines before they are counted.  A file split is read in order by
    one task, so a line's position is the number of lines in the splits before plus
    its position in its own split.  The lines of each split are counted when this is called; the text is
    read a second time for the result, from the same splits, and not stored.  Files must not change in between.
    """
    lines = pinned(spark).read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    if keep is not None:
        lines = lines.filter(keep)
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    splits = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    in_order = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    # A row a split.
    offsets = splits.select("file", "start", "first", F.coalesce(F.sum("size").over(in_order), F.lit(0)).alias("before"))
    path = scratch_dir(spark, "offsets")
    offsets.write.parquet(path)
    # The caller's session stands on the left, so the result is one of its tables.
    known = spark.read.schema(offsets.schema).parquet(path)
    lost = F.raise_error(F.concat(F.lit("no offset for a split of "), F.col("file"))).cast("bigint")
    return known.join(lines, ["file", "start"], "right").select(
        (F.coalesce("before", lost) + F.col("at") - F.col("first")).alias(number), "value")


def _floats(parts: Column) -> Column:
    return parts.cast("array<float>")


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``word float float ...`` lines: ``id, label, vec``; id is the line number.

    No quoting, and no text stands for a missing value, so words such as ``null`` and
    ``NA`` are words.  Blank lines are not counted.
    """
    numbered = number_rows(spark, path, strip_blanks(F.col("value")) != "", "id")
    parts = F.split("value", " ")
    numbers = F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda x: x != "")
    return numbered.select("id", parts[0].alias("label"), _floats(numbers).alias("vec"))


def read_query_list(spark: SparkSession, path: str) -> DataFrame:
    """One label per line: ``qid, label``, with the position as ``qid``."""
    return number_rows(spark, path, number="qid").select("qid", F.col("value").alias("label"))


def read_query_matrix(spark: SparkSession, path: str) -> DataFrame:
    """One vector per line, numbers parted by blanks: ``qid, vec``."""
    numbered = number_rows(spark, path, strip_blanks(F.col("value")) != "", "qid")
    numbers = F.split(strip_blanks(F.col("value")), " +")
    return numbered.select("qid", _floats(numbers).alias("vec"))


def read_links(spark: SparkSession, path: str, separator: str = " ") -> DataFrame:
    """Files of ``user: id id ...`` lines as a links table: ``user, followed``, and a row with null for each line.

    Records are what stands between separators and not lines, so a line of any length is shared among
    tasks and never held.  What a split has before its first line end belongs to the user that the last
    split with a line's beginning ends with.  A line begins with its name, which has no separator in it; blank lines are left out, and a
    line without a colon is an error.  Runs when called: the links are stored with their split, as splits may be
    cut otherwise later.
    """
    records = spark.read.option("lineSep", separator).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, user, head = None, None, None

        def ends() -> pa.RecordBatch:
            """A split's last user, null if no line begins in it, a line feed if one has ended."""
            if head is not None and head.strip():
                raise ValueError(f"a line without a colon, or a name with a separator: {head[:80]!r}")
            return rows(["\n" if head is not None else user], [None], True)

        def rows(users: list, followed: list, last: bool) -> pa.RecordBatch:
            n = len(users)
            return pa.RecordBatch.from_arrays(
                [pa.array([int(at[0])] * n, pa.int64()), pa.array([int(at[1])] * n, pa.int64()), pa.array(users, pa.string()),
                 pa.array(followed, pa.string()), pa.array([last] * n, pa.bool_())], ["file", "start", "user", "followed", "last"])

        for batch in batches:
            file, start = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                text = separator.join(batch.column(2).slice(begin, end - begin).to_pylist())
                if (file[begin], start[begin]) != at:
                    if at is not None:
                        yield ends()
                    # The first split of a file begins with a line, the others within one, as far as is known.
                    at, user, head = (file[begin], start[begin]), None, "" if start[begin] == 0 else None
                elif head:
                    text = head + separator + text
                users, followed = [], []
                for place, piece in enumerate(re.split("\r\n|\r|\n", text)):
                    if place:
                        if head is not None and head.strip():
                            raise ValueError(f"a line without a colon: {head[:80]!r}")
                        head = ""
                    if head is not None:
                        name, colon, rest = piece.partition(":")
                        if not colon:
                            head = piece
                            continue
                        user, head, piece = name, None, rest
                        users.append(user)
                        followed.append(None)
                    ids = piece.split()
                    users += [user] * len(ids)
                    followed += ids
                if users:
                    yield rows(users, followed, False)
        if at is not None:
            yield ends()

    found = materialise(records.mapInArrow(work, "file long, start long, user string, followed string, last boolean"), "links")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A row a split.
    carried = found.filter("last").select("file", "start", F.last("user", ignorenulls=True).over(before).alias("carried"))
    links = found.filter("NOT last")
    known = links.filter("user IS NOT NULL").select("user", "followed")
    rest = links.filter("user IS NULL").join(carried, ["file", "start"])
    lost = F.raise_error(F.lit("a split begins before the colon of a line")).cast("string")
    return known.unionByName(rest.select(F.when(F.col("carried") != "\n", F.col("carried")).otherwise(lost).alias("user"), "followed"))
