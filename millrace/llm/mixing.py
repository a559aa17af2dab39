"""Mix sources to target weights by subset-sum budget fitting.

Every source gets a target in words.  Whole passes over a source are taken while they fit;
the remaining budget is met by some of its documents once more, at most two in all.  Documents
are counted by exact length; shares of all lengths go first, and a bounded-knapsack dynamic
program over the counts that are left fits the last words.  Which documents of a length are
taken is decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import narrow, split_words, whole_text
from millrace.session import materialise, ship_package

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = 42
#: Words that the dynamic program fits; the budget beyond is met by shares of each length.
PROGRAM_WORDS = 1 << 16
#: Documents of one length and source that are ranked together.
RANKED = 1000


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """Per source: source_size, weight, target.  ``sizes`` has one row a source.

    Sources in order of code points, null last, take the weights in turn.  A target is the
    weight times a common level, but at most ``most`` times the source's size: the level at
    which the targets add up to ``share`` of all sizes, which is what resharing any excess by
    weight comes to.  Sorted by the level at which each source is full, the level that holds
    is the first which the sources not yet full can bear.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("_full", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(in_order) - 1) % len(weights))
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("_cap", F.col("source_size") * float(most))
        .withColumn("_full", F.col("_cap") / F.col("weight"))
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("_total", F.sum("source_size").over(every) * share)
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest))
        .withColumn("_place", F.when(F.col("_level") <= F.col("_full"), F.row_number().over(by_level)))
        .withColumn("_holds", F.min_by("_level", "_place").over(every))
    )
    target = F.least("_cap", F.coalesce(F.col("weight") * F.col("_holds"), F.col("_cap")))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, program: int = PROGRAM_WORDS) -> np.ndarray:
    """How many documents of each length to take, so that the words come nearest below ``budget``.

    Each length gives its share of the budget first; the longest that fit follow until the dynamic
    program can fit the rest.  All counts are bounded by ``counts``.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.astype(np.int64)
    if budget > program:
        taken = (counts * ((budget - program // 2) / whole)).astype(np.int64)
    left = budget - int((lengths * taken).sum())
    for i in order:
        if left <= program:
            break
        more = min(int(counts[i] - taken[i]), (left - program // 2) // int(lengths[i]))
        taken[i] += more
        left -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, left)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack over the sums that can be reached, each a bit of one integer.

    A length with n documents is split into parts of 1, 2, 4, ... and the rest.  Each part keeps
    the sums reached before it, and the way back asks whether the sum was there without it.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    reached, within, trail = 1, (1 << (budget + 1)) - 1, []
    for i in np.argsort(-lengths, kind="stable"):
        length, n, part = int(lengths[i]), int(min(counts[i], budget // max(int(lengths[i]), 1))), 1
        while n > 0 and not reached >> budget & 1:
            part = min(part, n)
            trail.append((int(i), part, reached))
            reached |= (reached << (length * part)) & within
            n, part = n - part, part * 2
    total = reached.bit_length() - 1
    for i, part, before in reversed(trail):
        if not before >> total & 1:
            taken[i] += part
            total -= int(lengths[i]) * part
    return taken


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's counts by length, with how many of each length are taken once more."""
    budget = int(round(float(pdf["target"].iloc[0]) - float(pdf["_passes"].iloc[0]) * float(pdf["source_size"].iloc[0])))
    pdf = pdf.sort_values("size", kind="stable")
    more = fit_counts(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), max(budget, 0))
    return pdf[["_source", "size", "n"]].assign(more=more)


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                most: int = MOST_COPIES, seed: int = SEED, size: Column | None = None) -> DataFrame:
    """Per document of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target,
    copies and taken, the words that the mix takes of it.

    A null text has size 0.  A null source is a source of its own, the last.  Documents without
    words are in no mix: copies is the number of whole passes, taken 0.  Repeated rows are documents
    of their own; where rows are equal in id, length and source, it makes no difference which is
    taken.  If the sources cannot hold the budget, every one is filled.  An empty table gives an
    empty result.  A source whose documents are all longer than the rest of its budget stays short
    of its target by that rest.

    Lengths with very many documents are cut into hash ranges of about ``RANKED`` documents before
    they are ranked, so no task ranks a hot length; ranges below the cut are taken whole.
    """
    ship_package(docs.sparkSession)
    sized = narrow(docs, "doc_id", "text", "source").select(
        "doc_id", "source",
        (F.size(split_words(whole_text())).cast("long") if size is None else size.cast("long")).alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("source"), F.lit(""))).alias("_draw"))
    sized = materialise(sized, "sizes")
    # A null source as a struct: it groups and joins like any other value.
    sized = sized.withColumn("_source", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    counted = materialise(sized.groupBy("_source", "size").agg(F.count("*").alias("n")), "lengths")
    per_source = counted.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).withColumn(
        "source", F.when(~F.col("_source.none"), F.col("_source.name")))
    targets = materialise(
        source_targets(per_source.select("source", "source_size"), weights, share, most)
        .withColumn("_source", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
        .withColumn("_passes", F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0)).cast("long"))
        .drop("source"), "targets")
    lengths = counted.filter("size > 0").join(targets, "_source").filter("_passes < " + str(int(most)))
    more = lengths.groupBy("_source").applyInPandas(
        _fit_source, "_source struct<none:boolean,name:string>, size long, n long, more long")
    more = materialise(more.withColumn("_ranges", F.ceil(F.col("n") / RANKED).cast("long")), "taken")

    keyed = sized.join(more.drop("n"), ["_source", "size"], "left").withColumn(
        "_range", F.floor((F.shiftrightunsigned("_draw", 1) / F.lit(float(1 << 63))) * F.coalesce("_ranges", F.lit(1))).cast("long"))
    some = keyed.filter("more > 0")
    below = Window.partitionBy("_source", "size").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        some.groupBy("_source", "size", "_range").agg(F.count("*").alias("_in"), F.first("more").alias("_more"))
        .withColumn("_room", F.col("_more") - F.coalesce(F.sum("_in").over(below), F.lit(0)))
        .select("_source", "size", "_range", "_room", "_in")
    )
    placed = keyed.join(ranges, ["_source", "size", "_range"], "left")
    cut = (F.col("_room") > 0) & (F.col("_room") < F.col("_in"))
    rank = F.row_number().over(Window.partitionBy("_source", "size", "_range").orderBy("_draw", "doc_id"))
    whole = placed.filter(~F.coalesce(cut, F.lit(False))).withColumn("_once", F.coalesce(F.col("_room") > 0, F.lit(False)))
    partly = placed.filter(F.coalesce(cut, F.lit(False))).withColumn("_once", rank <= F.col("_room"))
    result = whole.unionByName(partly).join(targets.select("_source", "source_size", "target", "_passes"), "_source")
    copies = F.col("_passes") + F.col("_once").cast("long")
    return result.select("doc_id", "source", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"))
