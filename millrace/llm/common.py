"""Expressions and row helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: words are the runs between these characters, \x20 and \x09 to \x0D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


def whole_text(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once a row however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def narrow(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no further column can clash with an inner one."""
    return docs.select(*[F.col(f"`{name}`") for name in names])
