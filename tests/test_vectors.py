from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import vectors as vec
from millrace.operators.blocks import Best, to_matrix
from millrace.operators.lsh import SignHash, lsh_index, lsh_nearest, sign_bits
from millrace.operators.neighbours import nearest
from millrace.operators.pivots import pivot_search
from millrace.plans import reports
from millrace.session import materialise

PLANS = {"in place": {}, "cells": {"max_broadcast_bytes": 0, "slice_rows": 50}}


def frame(spark, matrix, ids=None, name="id"):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, f"{name} long, vec array<double>")


def answers(found):
    return {(r.qid, r["rank"]): (r["id"], r["score"]) for r in found.collect()}


def plain_ranking(matrix, ids, query, metric, skip=None):
    """Best first, by pairwise arithmetic; ties by smaller id."""
    if metric.startswith("l2"):
        scores = -((matrix - query) ** 2).sum(axis=1)
    elif metric == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            scores = matrix @ query / np.linalg.norm(matrix, axis=1) / np.linalg.norm(query)
    else:
        scores = matrix @ query
    scores = np.round(scores, 12)
    order = sorted((-s, i) for s, i in zip(scores, ids) if i != skip and np.isfinite(s))
    return [i for _, i in order]


@pytest.fixture(scope="module")
def matrix():
    """300 vectors, a third of them copies of one, and one all zero."""
    drawn = np.random.default_rng(3).normal(size=(300, 9))
    drawn[100:200] = drawn[5]
    drawn[250] = 0
    return drawn


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("metric", ["dot", "cosine", "l2", "l2_expanded"])
def test_nearest_against_brute_force(spark, matrix, metric, plan):
    asked = np.vstack([matrix[::17], np.random.default_rng(4).normal(size=(20, 9))])
    ids = np.random.default_rng(5).permutation(1000)[:300]
    found = nearest(
        frame(spark, matrix, ids).repartition(5), frame(spark, asked, name="qid"), 7, metric, **PLANS[plan])
    got = answers(found)
    for q, query in enumerate(asked):
        want = plain_ranking(matrix, ids.tolist(), query, metric)[:7]
        assert [got[q, rank][0] for rank in range(1, 8) if (q, rank) in got] == want


@pytest.mark.parametrize("plan", PLANS)
def test_copies_are_ranked_by_id_in_any_partitioning(spark, matrix, plan):
    asked = frame(spark, matrix[[5, 7]], name="qid")
    for parts in (1, 3, 16):
        got = answers(nearest(frame(spark, matrix).repartition(parts), asked, 4, "l2", **PLANS[plan]))
        assert [got[0, rank][0] for rank in (1, 2, 3, 4)] == [5, 100, 101, 102]
        assert got[1, 1] == (7, 0.0)


def test_query_block_does_not_change_results(spark, matrix):
    data, asked = frame(spark, matrix), frame(spark, matrix + 0.01, name="qid")
    results = [answers(nearest(data, asked, 2, "l2", query_block=b)) for b in (1, 7, 1024)]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("plan", PLANS)
def test_a_query_can_leave_itself_out(spark, matrix, plan):
    asked = frame(spark, matrix, name="qid").withColumn("skip", F.col("qid"))
    got = answers(nearest(frame(spark, matrix), asked, 1, "cosine", **PLANS[plan]))
    assert got[5, 1][0] == 100 and got[100, 1][0] == 5
    assert (250, 1) not in got and all(place[0] != hit[0] for place, hit in got.items())


def test_rows_without_vector_and_empty_sides(spark):
    data = spark.createDataFrame([(1, None), (2, [1.0, 0.0])], "id long, vec array<double>")
    asked = spark.createDataFrame([(0, [1.0, 1.0]), (1, None)], "qid long, vec array<double>")
    for plan in PLANS.values():
        assert answers(nearest(data, asked, 3, "dot", **plan)) == {(0, 1): (2, 1.0)}
        assert nearest(data, asked.limit(0), **plan).count() == 0
        assert nearest(data.limit(0), asked, **plan).count() == 0


def test_vectors_of_unequal_length_are_refused():
    with pytest.raises(ValueError):
        to_matrix(pa.array([[1.0, 2.0], [3.0]]))
    with pytest.raises(ValueError):
        to_matrix(pa.array([[1.0], [2.0, 3.0, 4.0]]))


def test_bad_arguments(spark, matrix):
    data, asked = frame(spark, matrix), frame(spark, matrix, name="qid")
    for wrong in ({"metric": "l1"}, {"k": 0}, {"query_block": 0}):
        with pytest.raises(ValueError):
            nearest(data, asked, **wrong)


def test_float32_data_is_computed_in_double(spark):
    data = spark.createDataFrame([(1, [0.1, 0.2])], "id long, vec array<float>")
    asked = spark.createDataFrame([(0, [0.1, 0.2])], "qid long, vec array<float>")
    want = float((np.array([0.1, 0.2], np.float32).astype(float) ** 2).sum())
    assert answers(nearest(data, asked, 1, "dot"))[0, 1] == (1, want)


def test_scalar_functions(spark):
    a, b = F.col("a"), F.col("b")
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 1.0])], "a array<float>, b array<double>").select(
        vec.dot(a, b).alias("dot"), vec.euclidean(a, b).alias("far"), vec.squared_norm(a).alias("sq"),
        vec.squared_distance_from_norms(a, b, vec.squared_norm(a), vec.squared_norm(b)).alias("ex")).first()
    assert (row.dot, row.far, row.sq, row.ex) == (4.0, pytest.approx(18**0.5), 25.0, pytest.approx(18.0))


def test_normalise(spark):
    data = frame(spark, [[3, 4], [0, 0], [0, -2]])
    got = {r["id"]: r["vec"] for r in vec.normalise(data).collect()}
    assert got == {0: [0.6, 0.8], 1: [None, None], 2: [0.0, -1.0]}


SCHEME = SignHash(planes=10, bits=3, tables=3, seed=8)


def plain_candidates(matrix, asked):
    rng = np.random.default_rng(SCHEME.seed)
    picks = rng.integers(0, SCHEME.planes, size=(SCHEME.tables, SCHEME.bits))
    planes = np.random.default_rng(SCHEME.seed).normal(size=(SCHEME.planes, matrix.shape[1]))
    planes /= np.linalg.norm(planes, axis=1, keepdims=True)
    x, q = (matrix @ planes.T > 0), (asked @ planes.T > 0)
    return [[i for i in range(len(matrix)) if any((x[i, p] == q[j, p]).all() for p in picks)] for j in range(len(q))]


def test_bits_and_buckets(spark, matrix):
    planes = SCHEME.draw_planes(9)
    assert np.allclose(np.linalg.norm(planes, axis=1), 1)
    got = {r["id"]: r["bits"] for r in sign_bits(frame(spark, matrix), planes).collect()}
    want = (matrix @ planes.T > 0).astype(int)
    assert all(got[i] == want[i].tolist() for i in range(len(matrix)))
    picks = SCHEME.draw_picks()
    rows = lsh_index(frame(spark, matrix), SCHEME).collect()
    assert len(rows) == 3 * len(matrix)
    assert all(r.bucket == "".join(str(b) for b in want[r["id"]][picks[r.tbl]]) for r in rows)


@pytest.mark.parametrize("plan", PLANS)
def test_lsh_ranks_exactly_the_candidates(spark, matrix, plan):
    asked = matrix[::13]
    index = lsh_index(frame(spark, matrix).repartition(4), SCHEME)
    got = answers(lsh_nearest(index, frame(spark, asked, name="qid"), SCHEME, 300, **PLANS[plan]))
    for q, candidates in enumerate(plain_candidates(matrix, asked)):
        scores = np.round((matrix[candidates] * asked[q]).sum(axis=1), 12)
        want = [i for _, i in sorted(zip(scores, candidates), reverse=True)]
        assert [got[q, rank][0] for rank in range(1, len(want) + 1)] == want
        assert (q, len(want) + 1) not in got


def test_lsh_with_null_vectors_and_no_queries(spark, matrix):
    data = frame(spark, matrix).withColumn("vec", F.when(F.col("id") != 3, F.col("vec")))
    index = lsh_index(data, SCHEME)
    assert index.filter("id = 3").count() == 0
    for plan in PLANS.values():
        assert lsh_nearest(index, frame(spark, matrix, name="qid").limit(0), SCHEME, **plan).count() == 0


def words_frame(spark):
    rows = [(0, "cat", [1.0, 0.0]), (1, "dog", [0.9, 0.1]), (2, "NA", [0.0, 1.0]), (3, "cat", [0.0, 2.0])]
    return spark.createDataFrame(rows, "id long, label string, vec array<double>")


def test_a_repeated_label_means_its_last_row(spark):
    asked = spark.createDataFrame([(0, "cat"), (1, "NA")], "qid long, label string")
    got = {r.qid: (r.skip, r.vec) for r in reports.look_up(asked, words_frame(spark)).collect()}
    assert got == {0: (3, [0.0, 2.0]), 1: (2, [0.0, 1.0])}


def test_an_unknown_label_is_an_error(spark):
    asked = spark.createDataFrame([(0, "horse")], "qid long, label string")
    with pytest.raises(Exception, match="unknown query label: horse"):
        reports.look_up(asked, words_frame(spark)).collect()


def test_cosine_neighbours_carry_labels(spark):
    asked = spark.createDataFrame([(0, "cat")], "qid long, label string")
    got = reports.cosine_neighbours(words_frame(spark), asked, 2).orderBy("rank").collect()
    assert [(r["neighbour"], round(r["score"], 6)) for r in got] == [("NA", 1.0), ("dog", 0.110432)]


def test_wrong_answers_are_counted_and_listed(spark):
    vectors = words_frame(spark)
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.1])], "qid long, vec array<double>")
    expected = spark.createDataFrame([(0, "cat"), (1, "dog")], "qid long, expected string")
    found = nearest(vectors, asked)
    assert tuple(reports.count_wrong(found, vectors, expected).first()) == (2, 1)
    assert [tuple(r) for r in reports.wrong_answers(found, vectors, expected).collect()] == [(1, "NA", "dog")]


def clustered(spark, rows, queries, centres=30, dims=12, seed=3):
    """Vectors in tight clusters, and queries near other clusters' members."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 20
    data = middle[rng.integers(centres, size=rows)] + rng.normal(size=(rows, dims))
    data[: rows // 3] = data[0]  # a third is one vector
    asked = middle[rng.integers(centres, size=queries)] + rng.normal(size=(queries, dims))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id bigint, vec array<double>")
    ask = spark.createDataFrame([(i, row.tolist(), i) for i, row in enumerate(asked)], "qid bigint, vec array<double>, skip bigint")
    return data, asked, frame, ask


@pytest.mark.parametrize("metric", ["l2", "l2_expanded", "cosine", "dot"])
@pytest.mark.parametrize("slice_rows", [7, 400])
def test_pivots_lose_nothing_and_skip_most(spark, metric, slice_rows):
    """More than a hundred slices; every query's best rows are those of a full comparison."""
    data, asked, frame, ask = clustered(spark, 1500, 200)
    got = {}
    for r in nearest(frame, ask, 3, metric, max_broadcast_bytes=0, slice_rows=slice_rows).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.id
    a, b = (m / np.linalg.norm(m, axis=1, keepdims=True) if metric == "cosine" else m for m in (data, asked))
    for q in range(len(b)):
        scores = (a * b[q]).sum(axis=1) if metric in ("dot", "cosine") else -((a - b[q]) ** 2).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(a)), -np.round(scores, 9))) if i != q][:3]
        assert [got[q][rank] for rank in (1, 2, 3)] == order
    stored = materialise(ask.select("qid", "skip", "vec"), "asked")
    search = pivot_search(frame, stored, len(data), 12, slice_rows, lambda block, most: Best(block, most, metric, False, 64), metric, 3)
    share = search.skipped().first()
    assert share.pairs == len(data) * len(asked) and share.met < share.pairs
    if metric != "dot" and slice_rows == 7:
        assert search.slices.count() > 100 and share.share > 0.5
    assert "CartesianProduct" in plan_of(search.found()) or "BroadcastNestedLoopJoin" in plan_of(search.found())


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_queries_are_not_copied_through_an_exchange(spark):
    """After the tables are stored, only what is found is exchanged."""
    _, _, frame, ask = clustered(spark, 600, 100)
    search = pivot_search(frame, materialise(ask, "asked"), 600, 12, 5, lambda block, most: Best(block, most, "l2", False, 64), "l2", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(search.found())
        assert "CartesianProduct" in plan and "Exchange" not in plan
        assert search.slices.count() >= 100 and search.found().select("qid").distinct().count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slices_do_not_multiply_the_work(spark):
    """However few rows a slice may have, slices and blocks stay some hundred, and each query meets a leaf or two."""
    rng = np.random.default_rng(8)
    data = rng.random(size=(20_000, 2))
    frame_of = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id bigint, vec array<double>")
    stored = materialise(frame_of.select(F.col("id").alias("qid"), F.lit(None).cast("bigint").alias("skip"), "vec"), "asked")
    search = pivot_search(frame_of, stored, 20_000, 2, 5, lambda block, most: Best(block, most, "l2", False, 64), "l2", 1)
    assert 96 <= search.slices.count() < 400 and search.blocks.count() < 600
    assert search.skipped().first().share > 0.9
    assert search.found().groupBy("qid").agg(F.max_by("id", "score").alias("id")).filter("id = qid").count() == 20_000


def test_a_bucket_copies_its_queries_a_few_times(spark, monkeypatch):
    from millrace.operators import lsh

    copies, search_cells = [], lsh.search_cells
    monkeypatch.setattr(lsh, "search_cells", lambda data, queries, *rest: copies.append(queries.count()) or search_cells(data, queries, *rest))
    drawn = np.random.default_rng(9).normal(size=(400, 6))
    scheme = SignHash(planes=4, bits=2, tables=2, seed=5)
    unit = vec.normalise(frame(spark, drawn))
    found = {limit: answers(lsh_nearest(lsh_index(unit, scheme), unit.select(F.col("id").alias("qid"), "vec"), scheme, 3, max_broadcast_bytes=limit, slice_rows=2)) for limit in (0, 1 << 20)}
    assert found[0] == found[1 << 20] and copies == [400 * 2 * lsh.FEW_SLICES]


def test_many_pairs_are_never_all_compared(spark, matrix, monkeypatch):
    """Queries that could be broadcast go by cells when they make many pairs."""
    from millrace.operators import neighbours

    data, asked = frame(spark, matrix), frame(spark, matrix[::3], name="qid")
    want = answers(nearest(data, asked, 2))
    monkeypatch.setattr(neighbours, "FEW_PAIRS", 1000)
    monkeypatch.setattr(neighbours, "FEW_QUERIES", 10)
    monkeypatch.setattr(neighbours, "_search_in_place", None)
    assert answers(nearest(data, asked, 2)) == want
