"""Pipelines of several operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.functions.vectors import normalise
from millrace.operators import counting, trends
from millrace.operators.lsh import SignHash, lsh_index, lsh_nearest
from millrace.operators.lsh_store import StoredIndex
from millrace.operators.neighbours import nearest
from millrace.operators.sketches import hll_estimate, hll_registers
from millrace.session import materialise


def distinct_words(docs: DataFrame, registers: int = 1024, seed: int = 0, text: str = "text") -> DataFrame:
    """Estimated number of distinct words of a corpus: ``estimate``."""
    return hll_estimate(hll_registers(words(docs, text), "word", registers, seed), registers)


@dataclass(frozen=True)
class CorpusReport:
    checksum: DataFrame
    top: DataFrame


def corpus_report(docs: DataFrame, text: str = "text", k: int = 10) -> CorpusReport:
    """Checksum and most frequent words, from counts that are stored once."""
    counts = materialise(counting.word_count(docs, text), "counts")
    return CorpusReport(counting.checksum(counts), counting.top_words(counts, k))


@dataclass(frozen=True)
class ClimateReport:
    top_slopes: DataFrame
    slope_summary: DataFrame
    top_differences: DataFrame
    difference_summary: DataFrame


def climate_report(readings: DataFrame, early: int = 1910, late: int = 2010,
                   k: int = 5, error: float = 0.01) -> ClimateReport:
    """Steepest trends and largest changes, with the spread of both.

    The readings are scanned once, when called, into a stored profile of a few rows
    per station; everything else is computed from that.  Without any station that has
    both decades the difference summary is one row of nulls.
    """
    profile = materialise(trends.station_profile(trends.daily_means(readings), (early, late)), "profile")
    slopes = trends.slopes_of(profile)
    averages = trends.averages_of(profile)
    changes = trends.decade_change(*(averages.filter(F.col("decade") == decade) for decade in (early, late)))
    return ClimateReport(
        trends.top_by(slopes, "beta", k, "station"),
        trends.summary(slopes, "beta", error),
        trends.top_by(changes, "diff_c", k, "station"),
        trends.summary(changes, "diff_c", error),
    )


def look_up(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vectors of query labels: ``qid, label, skip, vec``, where ``skip`` is the row's id.

    A label that occurs in several rows means the last of them.  A label that occurs
    in none is an error, raised when the result is computed.
    """
    asked = queries.select("label").distinct()
    last = vectors.join(asked, "label", "left_semi").groupBy("label").agg(
        F.max_by(F.struct("id", "vec"), "id").alias("row"))
    unknown = F.raise_error(F.concat(F.lit("unknown query label: "), F.col("label")))
    return queries.join(last, "label", "left").select(
        "qid", "label", F.coalesce(F.col("row.id"), unknown.cast("bigint")).alias("skip"),
        F.col("row.vec").alias("vec"))


def with_labels(found: DataFrame, vectors: DataFrame) -> DataFrame:
    """Replace row ids by their labels: ``neighbour`` beside ``id``."""
    return found.join(vectors.select("id", F.col("label").alias("neighbour")), "id")


def cosine_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 3, **search) -> DataFrame:
    """Most similar words of each query word, itself left out, by cosine."""
    found = nearest(vectors, look_up(queries, vectors), k, "cosine", **search)
    return with_labels(found, vectors)


def lsh_neighbours(vectors: DataFrame, queries: DataFrame, scheme: SignHash, k: int = 3, index: StoredIndex | None = None,
                   **search) -> DataFrame:
    """The same among the candidates of sign-projection hashing; with ``index``, a stored index of the
    vectors at length one, nothing but the queries is hashed."""
    asked = normalise(look_up(queries, vectors))
    if index is not None:
        return with_labels(index.nearest(asked, k, **search), vectors)
    return with_labels(lsh_nearest(lsh_index(normalise(vectors), scheme), asked, scheme, k, **search), vectors)


def wrong_answers(found: DataFrame, vectors: DataFrame, expected: DataFrame) -> DataFrame:
    """Queries whose nearest row has another label: ``qid, got, expected``."""
    got = with_labels(found, vectors).select("qid", F.col("neighbour").alias("got"))
    return expected.join(got, "qid", "left").filter(~F.col("got").eqNullSafe(F.col("expected"))).select(
        "qid", "got", "expected")


def count_wrong(found: DataFrame, vectors: DataFrame, expected: DataFrame) -> DataFrame:
    """One row: how many queries were answered, and how many wrongly."""
    got = with_labels(found, vectors).select("qid", F.col("neighbour").alias("got"))
    return expected.join(got, "qid", "left").agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_if(~F.col("got").eqNullSafe(F.col("expected"))).alias("wrong"))
