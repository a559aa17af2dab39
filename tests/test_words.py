from __future__ import annotations

import sys
from collections import Counter

from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators import counting
from millrace.plans.reports import corpus_report
from millrace.sources.text import read_corpus

TEXTS = [
    "the cat  the dog", "", "  lead\ttrail \n", "a b c", "Cat cat, CAT", "wide em nel\x85fs\x1cend",
    "naïve 東京　大阪 \U0001f600", "the\r\nend",
]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def as_dict(counts):
    return {row.word: row.n for row in counts.collect()}


def expected(texts=TEXTS):
    return Counter(word for text in texts for word in text.split())


def test_every_python_blank_parts_words(spark):
    blanks = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert len(blanks) == 29
    texts = [f"x{blank}y" for blank in blanks] + [f"{blank}z{blank}" for blank in blanks]
    got = words(docs(spark, texts)).groupBy("word").count().collect()
    assert {row.word: row["count"] for row in got} == {"x": 29, "y": 29, "z": 29}


def test_characters_near_the_blanks_do_not_part(spark):
    joined = "a\x1bb\x20ᙿcᚁd῿e​f‧g‪h、i﻿j"
    assert [row.word for row in words(docs(spark, [joined])).collect()] == joined.split()


def test_word_count_matches_plain_python(spark):
    assert as_dict(counting.word_count(docs(spark))) == dict(expected())


def test_null_text_has_no_words(spark):
    frame = spark.createDataFrame([(0, None), (1, "a")], "doc_id long, text string")
    assert as_dict(counting.word_count(frame)) == {"a": 1}


def test_result_does_not_depend_on_partitions(spark):
    one = as_dict(counting.word_count(docs(spark).coalesce(1)))
    many = as_dict(counting.word_count(docs(spark).repartition(7)))
    assert one == many


def test_counting_within_rows_needs_no_exchange(spark):
    by_key = counting.word_count_by(docs(spark), ("doc_id",))
    in_rows = counting.word_count_in_rows(docs(spark), ("doc_id",))
    assert sorted(map(tuple, in_rows.collect())) == sorted(map(tuple, by_key.collect()))
    assert "Exchange" not in in_rows._jdf.queryExecution().executedPlan().toString()


def test_merging_counts_per_file_gives_the_global_count(spark):
    per_file = counting.word_count_by(docs(spark), ("doc_id",))
    assert as_dict(counting.merge_counts(per_file)) == dict(expected())
    halves = [per_file.filter(F.col("doc_id") % 2 == rest) for rest in (0, 1)]
    assert as_dict(counting.merge_counts(*halves)) == dict(expected())


def test_checksums_agree(spark):
    want = sum(len(word) * n for word, n in expected().items())
    assert counting.checksum(counting.word_count(docs(spark))).first().checksum == want
    assert counting.corpus_checksum(docs(spark)).first().checksum == want


def test_checksum_of_nothing_is_zero(spark):
    empty = docs(spark).limit(0)
    assert counting.checksum(counting.word_count(empty)).first().checksum == 0
    assert counting.corpus_checksum(empty).first().checksum == 0


def test_top_words_break_ties_from_the_end(spark):
    counts = counting.word_count(docs(spark, ["a b c d d", "e e e"]))
    assert [tuple(r) for r in counting.top_words(counts, 4).collect()] == [("e", 3), ("d", 2), ("c", 1), ("b", 1)]


def test_corpus_files_are_found_below_a_folder(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.txt").write_text("red red\nblue\n")
    (tmp_path / "a" / "b" / "two.txt").write_text("blue\x85green")
    (tmp_path / "a" / "three.md").write_text("black")
    (tmp_path / "a" / "empty.txt").write_text("")
    for whole in (False, True):
        corpus = read_corpus(spark, str(tmp_path), whole)
        assert as_dict(counting.word_count(corpus)) == {"red": 2, "blue": 2, "green": 1}
        per_file = counting.word_count_by(corpus, ("path",)).collect()
        assert {(row.path.rsplit("/", 1)[1], row.word): row.n for row in per_file} == {
            ("one.txt", "red"): 2, ("one.txt", "blue"): 1, ("two.txt", "blue"): 1, ("two.txt", "green"): 1}


def test_report_holds_checksum_and_top(spark):
    report = corpus_report(docs(spark), k=1)
    assert report.checksum.first().checksum == sum(len(w) * n for w, n in expected().items())
    assert report.top.first().word == "the"


def test_count_is_combined_before_the_exchange(spark):
    plan = counting.word_count(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
