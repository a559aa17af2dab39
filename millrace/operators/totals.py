"""Keyed sums over resource rows, and the k largest of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_name(constellation: Column, star: Column) -> Column:
    """The main star carries its constellation's name, any other its own before it."""
    return F.when(star == "Prime", constellation).otherwise(
        F.concat(star, F.lit(" "), constellation)
    )


def star_totals(resources: DataFrame) -> DataFrame:
    """Total ``units`` per star of ``constellation, star, units``: ``name, total``."""
    name = star_name(F.col("constellation"), F.col("star")).alias("name")
    return resources.groupBy(name).agg(F.sum(F.col("units").cast("bigint")).alias("total"))


def largest(totals: DataFrame, k: int = 0) -> DataFrame:
    """The k largest totals, ties by name from the end; all of them, unordered, for 0."""
    if k < 0:
        raise ValueError("k must not be negative")
    return totals if k == 0 else totals.orderBy(F.desc("total"), F.desc("name")).limit(k)
