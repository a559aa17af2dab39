"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition under which a document is rejected.  Each rule's cost and the
share that it rejects are measured on a stored sample; the cascade is one CASE whose
branches stand in order of rejections per second, so that a dear rule is computed only
for what the cheaper ones let pass.  The order never changes which documents are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD_CHARACTER, let, split_words, whole_text
from millrace.session import materialise

WINDOW = 5
#: Rows of the sample on which cost and selectivity are measured, and its share.
SAMPLE_ROWS, SAMPLE_SHARE, SAMPLE_SEED = 2000, 0.05, 7
#: Times that a rule is evaluated on each row of the sample.
REPEATED = 8
#: Fixed by the contract: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``rejects`` may use the columns of ``features`` and ``text``."""
    name: str
    rejects: Callable[[], Column]


def _count(pattern: str) -> Column:
    return F.length(F.regexp_replace("text", pattern, ""))


#: Conditions in whole numbers, so that no rounding decides.
RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    # Over half of the characters are capitals.
    Rule("capitals", lambda: 2 * _count(r"[^\p{Lu}]") > F.col("word_chars")),
    # Over half of the characters are no letters.
    Rule("few_letters", lambda: 2 * _count(r"[^\p{L}]") < F.col("word_chars")),
    # Over a third of the words end in an exclamation or an ellipsis.
    Rule("shouting", lambda: 3 * F.regexp_count("text", F.lit(r"(?:!|\.\.\.|…)(?=[\x20\x09-\x0D]|\z)")) > F.col("n_words")),
    # Over nine of ten lines are list items.
    Rule("list_items", lambda: 10 * F.regexp_count("text", F.lit(r"(?m)^[\x20\x09]*[•‣*-][\x20\x09]")) > 9 * F.col("n_lines")),
    # A hundred words or more of which not one in twenty is new.
    Rule("few_different", lambda: (F.col("n_words") >= 100) & (20 * F.size(F.array_distinct("_words")) < F.col("n_words"))),
)


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside the windows of ``window`` words that occur twice or more.

    Only a text with some equal windows sorts them; the words are then the gaps from
    one such window's start to the next, ``window`` at most.
    """
    def hashes(of: Column) -> Column:
        every = F.transform(of, lambda _, i: F.xxhash64(F.slice(of, i + 1, window)))
        return F.slice(every, F.lit(1), F.greatest(F.size(of) - (window - 1), F.lit(0)))

    def covered(found: Column) -> Column:
        def by_hash(ordered: Column) -> Column:
            def own(i: Column) -> Column:
                return F.get(ordered, i)["h"]
            flagged = F.transform(ordered, lambda p, i: F.when(
                (p["h"] == own(i + 1)) | ((i > 0) & (p["h"] == own(i - 1))), p["at"]))
            return F.sort_array(F.array_compact(flagged))

        def lengths(starts: Column) -> Column:
            gaps = F.transform(starts, lambda at, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - at, F.lit(window))))
            return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return let(let(pairs, by_hash), lengths)

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found))

    return let(let(words, hashes), counted).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with text null as empty, and the counts that rules use.

    Adds n_words, word_chars (code points in words), n_symbols, n_lines (lines with a
    word), n_dup_lines (those equal to an earlier one), n_repeat_words and _words.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHARACTER))
    counted = docs.withColumn("text", whole_text()).withColumns({"_words": split_words(text), "_lines": lines})
    return counted.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_window_words(F.col("_words")),
    }).drop("_lines")


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def order_rules(docs: DataFrame, rules: Sequence[Rule], rows: int = SAMPLE_ROWS,
                share: float = SAMPLE_SHARE, seed: int = SAMPLE_SEED) -> list[Rule]:
    """The rules by rejections per second on a sample of at most ``rows`` documents.

    An empty sample leaves the order as given.  ``share`` of the documents is drawn, or less, so that about one and
    a half times ``rows`` are exchanged for the sample; counting them reads no text.  The sample is
    stored, then its counts, so that a rule's time is its own, and each rule sees every row ``REPEATED`` times, so that
    its time is not lost in that of a job.
    """
    total = docs.count()
    drawn = docs.sample(min(share, 1.5 * rows / max(total, 1)) if total > rows else 1.0, seed)
    sample = materialise(features(materialise(drawn.limit(rows), "sample")), "rules")
    repeated = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(REPEATED))))

    def seconds_and_rejected(condition: Column) -> tuple[float, int, int]:
        start = time.perf_counter()
        row = repeated.agg(F.count("*").alias("n"), F.count_if(condition).alias("rejected")).first()
        return time.perf_counter() - start, row["rejected"], row["n"]

    idle = min(seconds_and_rejected(F.lit(False))[0] for _ in range(3))
    worth = {}
    for rule in rules:
        first, rejected, n = seconds_and_rejected(rule.rejects())
        again = seconds_and_rejected(rule.rejects())[0]
        cost = max(min(first, again) - idle, 1e-4)
        worth[rule.name] = rejected / max(n, 1) / cost
    return sorted(rules, key=lambda rule: -worth[rule.name])


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, ordered: bool = False) -> DataFrame:
    """``docs`` with their counts, base_failed, failed_rule and kept.

    failed_rule is the first rule in the cascade's order that rejects the document, null
    if none does; several may, and which stands first depends on the measured order, while
    kept does not.  A null or empty text has no words and is rejected; repeated rows are
    judged each for itself; an empty table gives an empty result.  Columns of ``docs`` other
    than ``text`` pass through, except those named like an added one, which are replaced.
    """
    counted = features(docs)
    rules = list(rules) if ordered else order_rules(docs, rules)
    verdict = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects(), F.lit(rule.name))
    return counted.withColumns({"base_failed": base_failed(), "failed_rule": verdict}).withColumn(
        "kept", F.col("failed_rule").isNull()).drop("_words")
