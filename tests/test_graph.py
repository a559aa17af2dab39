from __future__ import annotations

import random
from collections import Counter

import pytest

from millrace.operators import graph
from millrace.sources.text import read_lines, read_links

LINES = ["12: 13 14 13", "13:", "14: ", "9: 12 13", "", "100: 9"]


@pytest.fixture()
def adjacency(spark, tmp_path):
    (tmp_path / "graph.txt").write_text("\n".join(LINES) + "\n")
    return graph.parse_adjacency(read_lines(spark, str(tmp_path / "graph.txt")))


def degrees(df):
    return {row.user: row.degree for row in df.collect()}


def test_out_degree_counts_repeated_ids(adjacency):
    want = {"12": 3, "13": 0, "14": 0, "9": 2, "100": 1}
    assert degrees(graph.line_out_degree(adjacency)) == want
    assert degrees(graph.out_degree(graph.links(adjacency))) == want


def test_in_degree_covers_both_ends(adjacency):
    want = {"12": 1, "13": 3, "14": 1, "9": 1, "100": 0}
    assert degrees(graph.in_degree(graph.links(adjacency))) == want


def test_an_id_without_a_line_of_its_own_counts(spark):
    edges = spark.createDataFrame([("a", "z"), ("b", None)], "user string, followed string")
    assert degrees(graph.in_degree(edges)) == {"a": 0, "b": 0, "z": 1}
    assert degrees(graph.out_degree(edges)) == {"a": 1, "b": 0}


def test_summaries(adjacency):
    row = graph.degree_summary(graph.line_out_degree(adjacency)).first()
    assert tuple(row) == (5, "12", 3, 6 / 5, 2)
    row = graph.degree_summary(graph.in_degree(graph.links(adjacency))).first()
    assert tuple(row) == (5, "13", 3, 6 / 5, 1)


def test_ties_go_to_the_largest_id_as_text(spark):
    frame = spark.createDataFrame([(9, 2), (100, 2), (7, 1)], "user long, degree long")
    assert graph.degree_summary(frame).first().max_user == "9"


def test_all_zero_and_empty(spark):
    frame = spark.createDataFrame([("a", 0), ("b", 0)], "user string, degree long")
    assert tuple(graph.degree_summary(frame).first()) == (2, "b", 0, 0.0, 2)
    assert tuple(graph.degree_summary(frame.limit(0)).first()) == (0, None, None, None, 0)


def test_a_line_without_colon_is_an_error(spark):
    lines = spark.createDataFrame([("12 13",)], "value string")
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        graph.parse_adjacency(lines).collect()


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name, size in zip(names, ("2000", "1")):
        spark.conf.set(name, size)
    yield
    for name, size in before.items():
        spark.conf.set(name, size)


def test_links_of_the_lines(spark, tmp_path, adjacency):
    (tmp_path / "graph.txt").write_text("\r\n".join(LINES) + "\n")
    found = read_links(spark, str(tmp_path / "graph.txt"))
    assert degrees(graph.out_degree(found)) == degrees(graph.line_out_degree(adjacency))
    assert degrees(graph.in_degree(found)) == degrees(graph.in_degree(graph.links(adjacency)))


@pytest.mark.parametrize("seed", range(3))
def test_a_line_longer_than_many_splits(spark, tmp_path, small_splits, seed):
    """Degrees of lines that are cut anywhere: within, at their beginning, at their end, and not at all."""
    rng, out, into = random.Random(seed), Counter(), Counter()
    for file in range(3):
        lines = []
        for user in range(40):
            ids = [str(rng.randint(0, 400)) for _ in range(9000 if user == 20 else rng.choice([0, 0, 1, 5, 20, 300]))]
            lines.append(f"u{file}-{user}:{rng.choice(['', ' '])}" + rng.choice([" ", "  "]).join(ids) if ids else f"u{file}-{user}:")
            out[f"u{file}-{user}"] = len(ids)
            into.update(ids)
        (tmp_path / f"{file}.txt").write_text("\n".join(lines) + "\n" * file)
    found = read_links(spark, str(tmp_path))
    assert spark.read.option("lineSep", " ").text(str(tmp_path)).rdd.getNumPartitions() > 15
    assert degrees(graph.out_degree(found)) == out
    assert degrees(graph.in_degree(found)) == into | {user: 0 for user in out}


def test_links_of_nothing_and_of_bad_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n \n")
    assert read_links(spark, str(tmp_path / "a.txt")).count() == 0
    for name, text in (("b.txt", "12 13\n1: 2"), ("c.txt", "1: 2\n7"), ("d.txt", "a b: 3")):
        (tmp_path / name).write_text(text)
        if name != "d.txt":
            with pytest.raises(Exception, match="without a colon"):
                read_links(spark, str(tmp_path / name)).collect()
