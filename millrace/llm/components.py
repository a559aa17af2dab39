"""Connected components of a table of links, by stars that grow and shrink in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest one."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    others = down.join(least, "a").filter("b != _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return others.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of whole numbers, each node but the smallest of its component with that one,
    as (a, b).  Every round is a written table, so a lost executor costs one round at most."""
    def state(table: DataFrame) -> tuple[int, int]:
        row = table.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        return row["n"], row["sum"]

    current = materialise(_small_star(links.filter("a != b")), "links")
    before = state(current)
    for _ in range(MOST_ROUNDS):
        current = materialise(_small_star(_large_star(current)), "links")
        after = state(current)
        if after == before:
            return current
        before = after
    raise RuntimeError(f"links have not settled in {MOST_ROUNDS} rounds")
