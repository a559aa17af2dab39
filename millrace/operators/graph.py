"""Degrees in a follow graph.

Two shapes are understood.  An *adjacency* table has one row per line of a graph
file, ``user, follows array``.  A *links* table has one row per edge, ``user,
followed``, and a row with a null ``followed`` for a user who may follow no one.
The second has no array that grows with the busiest user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import split_words, strip_blanks


def parse_adjacency(lines: DataFrame, value: str = "value") -> DataFrame:
    """``user: id id ...`` lines to ``user, follows``.

    Blank lines are left out; a line without a colon is an error.
    """
    halves = F.split(F.col(value), ":", 2)
    follows = F.filter(split_words(halves[1]), lambda x: x != "")
    return lines.filter(strip_blanks(F.col(value)) != "").select(
        halves[0].alias("user"), follows.alias("follows")
    )


def links(adjacency: DataFrame) -> DataFrame:
    """One row per edge, and one with null for a line without any."""
    return adjacency.select("user", F.explode_outer("follows").alias("followed"))


def line_out_degree(adjacency: DataFrame) -> DataFrame:
    """Ids on each line, repeated ones included: ``user, degree``.  No exchange."""
    return adjacency.select("user", F.size("follows").cast("bigint").alias("degree"))


def out_degree(edges: DataFrame) -> DataFrame:
    """Edges leaving each user of a links table: ``user, degree``."""
    return edges.groupBy("user").agg(F.count("followed").alias("degree"))


def in_degree(edges: DataFrame) -> DataFrame:
    """Edges reaching each id that occurs on either end: ``user, degree``.

    Each link row stands for a zero for its user and a one for the id followed, so a
    single aggregation gives the union of both ends and the counts.
    """
    def mark(who: str, count: int) -> Column:
        return F.struct(F.col(who).alias("user"), F.lit(count).cast("bigint").alias("seen"))

    marks = edges.select(F.inline(F.array(mark("user", 0), mark("followed", 1))))
    return marks.filter(F.col("user").isNotNull()).groupBy("user").agg(F.sum("seen").alias("degree"))


def degree_summary(degrees: DataFrame) -> DataFrame:
    """One row: users, busiest user and its degree, mean degree, users with none.

    Among equals the user that is largest as text wins.
    """
    top = F.max(F.struct("degree", F.col("user").cast("string").alias("user")))
    row = degrees.agg(
        F.count(F.lit(1)).alias("users"),
        top.alias("top"),
        F.avg("degree").alias("mean_degree"),
        F.count_if(F.col("degree") == 0).alias("none_count"),
    )
    return row.select(
        "users", F.col("top.user").alias("max_user"), F.col("top.degree").alias("max_degree"),
        "mean_degree", "none_count",
    )
