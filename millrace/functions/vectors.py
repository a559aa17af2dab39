"""Arithmetic on ``array`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def squared_norm(a: Column) -> Column:
    return F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )


def euclidean(a: Column, b: Column) -> Column:
    def gap(x: Column, y: Column) -> Column:
        return x.cast("double") - y.cast("double")

    return F.sqrt(_total(F.zip_with(a, b, lambda x, y: gap(x, y) * gap(x, y))))


def squared_distance_from_norms(a: Column, b: Column, a_squared: Column, b_squared: Column) -> Column:
    """Squared distance by expansion, for when the squared norms are at hand.

    Rounding can make it slightly negative for vectors that nearly coincide.
    """
    return a_squared + b_squared - F.lit(2.0) * dot(a, b)


def normalise(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Scale every vector to unit length; the elements of a zero vector become null.

    The norm is a column of its own so that it is computed once per row, not once
    per element.
    """
    norm = f"__{vec}_norm"
    return (
        df.withColumn(norm, F.nullif(F.sqrt(squared_norm(F.col(vec))), F.lit(0.0)))
        .withColumn(vec, F.transform(F.col(vec), lambda x: x.cast("double") / F.col(norm)))
        .drop(norm)
    )
