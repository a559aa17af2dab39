"""Word counts, their merge, checksum and top list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import split_words, without_blanks, words


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each word: ``word, n``.  Counted before the exchange and after."""
    return words(docs, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_by(docs: DataFrame, keys: tuple[str, ...], text: str = "text") -> DataFrame:
    """Occurrences of each word within each file, or within any other key."""
    return words(docs, text, keys).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def word_count_in_rows(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Occurrences of each word within each row, where a row is a whole file.

    Same result as counting by a key that is unique per row, without any exchange:
    the words of a row are sorted, and the gaps between the places where a new word
    starts are the counts.
    """
    inner = F.sort_array(F.array_remove(split_words(F.col(text)), "")).alias("__sorted")
    ordered, starts = F.col("__sorted"), F.col("__starts")
    changes = F.transform(ordered, lambda word, i: F.when(~word.eqNullSafe(F.get(ordered, i - 1)), i))

    def run(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(starts, i + 1), F.size(ordered))
        return F.struct(F.get(ordered, start).alias("word"), (end - start).cast("bigint").alias("n"))

    # Each intermediate array is a column of its own: it is used more than once, and
    # written in place it would be computed anew for every element.
    rows = docs.select(*keep, inner).select(*keep, ordered, F.array_compact(changes).alias("__starts"))
    return rows.select(*keep, F.inline(F.transform(starts, run)))


def merge_counts(*tables: DataFrame) -> DataFrame:
    """Add up any number of count tables ``word, n``."""
    parts = [table.select("word", "n") for table in tables]
    together = reduce(DataFrame.unionByName, parts)
    return together.groupBy("word").agg(F.sum("n").alias("n"))


def checksum(counts: DataFrame) -> DataFrame:
    """Sum of word length (in code points) times count, from a count table."""
    total = F.sum(F.length("word").cast("bigint") * F.col("n"))
    return counts.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("checksum"))


def corpus_checksum(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same checksum straight from the text.

    Every occurrence adds its length, so the sum needs no grouping and no exchange
    of words: each task sends one number.
    """
    total = F.sum(F.length(without_blanks(F.col(text))).cast("bigint"))
    return docs.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("checksum"))


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent words; among equal counts the larger word wins."""
    return counts.orderBy(F.desc("n"), F.desc("word")).limit(k)
