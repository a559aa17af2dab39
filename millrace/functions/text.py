"""Splitting text into words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 29 characters that count as white space (Unicode White_Space
# plus the four ASCII separators).  Those below 256 are listed one by one, and the
# rest sit behind a range test, because that form is the fastest to match.
BLANKS = (
    r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
BLANK_RUN = f"[{BLANKS}]+"


def split_words(text: Column) -> Column:
    """Array of words; a leading or trailing blank leaves an empty string in it."""
    return F.split(text, BLANK_RUN)


def strip_blanks(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(text, f"^{BLANK_RUN}|{BLANK_RUN}$", "")


def without_blanks(text: Column) -> Column:
    """All words of the text run together."""
    return F.regexp_replace(text, BLANK_RUN, "")


def words(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per word of ``text``, with the columns in ``keep`` repeated.

    Case and punctuation stay.  Works on batch and streaming input.
    """
    exploded = docs.select(*keep, F.explode(split_words(F.col(text))).alias("word"))
    return exploded.filter(F.col("word") != "")
