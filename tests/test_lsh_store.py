from __future__ import annotations

import os

import numpy as np
import pytest

from millrace.operators.lsh import SignHash, lsh_index, lsh_nearest
from millrace.operators.lsh_store import StoredIndex

SCHEME = SignHash(planes=12, bits=4, tables=5, seed=1)
PLANS = {"in place": {}, "cells": {"max_broadcast_bytes": 0, "slice_rows": 20}}


def frame(spark, matrix, first=0, name="id"):
    return spark.createDataFrame([(first + i, row.tolist()) for i, row in enumerate(matrix)], f"{name} bigint, vec array<double>")


@pytest.fixture(scope="module")
def matrix():
    rows = np.random.default_rng(4).normal(size=(300, 8))
    rows[100:200] = rows[100]  # a third is one vector
    return rows


def rows(found):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in found.collect())


def files(path):
    return sorted((os.path.join(d, f), os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(path) for f in names)


@pytest.mark.parametrize("plan", PLANS)
def test_as_the_index_that_is_made_anew(spark, matrix, tmp_path, plan):
    data, asked = frame(spark, matrix), frame(spark, matrix[::7], name="qid").withColumnRenamed("id", "qid")
    want = rows(lsh_nearest(lsh_index(data, SCHEME), asked, SCHEME, 4))
    StoredIndex.build(data, SCHEME, f"{tmp_path}/i", buckets=4)
    index = StoredIndex.open(spark, f"{tmp_path}/i")
    before = files(f"{tmp_path}/i")
    assert rows(index.nearest(asked, 4, **PLANS[plan])) == want
    assert rows(index.nearest(asked, 4, **PLANS[plan])) == want
    assert files(f"{tmp_path}/i") == before  # a search writes nothing
    assert index.vectors().count() == 300 and index.entries().count() == 300 * SCHEME.tables


@pytest.mark.parametrize("plan", PLANS)
def test_appended_rows_are_found(spark, matrix, tmp_path, plan):
    asked = frame(spark, matrix[:30], name="qid")
    index = StoredIndex.build(frame(spark, matrix[:120]), SCHEME, f"{tmp_path}/i", buckets=4)
    index.append(frame(spark, matrix[120:250], 120))
    StoredIndex.open(spark, f"{tmp_path}/i").append(frame(spark, matrix[250:], 250))
    want = rows(lsh_nearest(lsh_index(frame(spark, matrix), SCHEME), asked, SCHEME, 300))
    assert rows(index.nearest(asked, 300, **PLANS[plan])) == want


@pytest.mark.parametrize("plan", PLANS)
def test_an_append_that_failed_shows_nothing_and_can_be_repeated(spark, matrix, tmp_path, plan, monkeypatch):
    index = StoredIndex.build(frame(spark, matrix[:200]), SCHEME, f"{tmp_path}/i", buckets=4)
    asked = frame(spark, matrix[150:250], name="qid")
    want = rows(index.nearest(asked, 5, **PLANS[plan]))
    monkeypatch.setattr("millrace.operators.lsh_store.one_row_per_table", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.append(frame(spark, matrix[200:], 200))
    monkeypatch.undo()
    assert rows(index.nearest(asked, 5, **PLANS[plan])) == want
    index.append(frame(spark, matrix[200:], 200))
    assert rows(index.nearest(asked, 5, **PLANS[plan])) == rows(lsh_nearest(lsh_index(frame(spark, matrix), SCHEME), asked, SCHEME, 5))


def test_neither_vectors_nor_entries_are_exchanged(spark, matrix, tmp_path):
    index = StoredIndex.build(frame(spark, matrix), SCHEME, f"{tmp_path}/i", buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = index.nearest(frame(spark, matrix[:9], name="qid"), 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # By qid for the ranks, by id for the candidates; each without a vector.
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2 and sum("hashpartitioning(id" in line for line in exchanges) == 1
        assert rows(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_index_and_null_vectors(spark, matrix, tmp_path):
    none = frame(spark, matrix).limit(0)
    index = StoredIndex.build(none, SCHEME, f"{tmp_path}/i", buckets=2)
    asked = frame(spark, matrix[:3], name="qid")
    assert index.nearest(asked).count() == 0
    index.append(frame(spark, matrix[:5]).selectExpr("id", "if(id = 2, null, vec) AS vec"))
    assert index.vectors().count() == 4
    assert {r.id for r in StoredIndex.open(spark, f"{tmp_path}/i").nearest(asked, 9, max_broadcast_bytes=1 << 20).collect()} <= {0, 1, 3, 4}
    assert index.nearest(asked.limit(0)).count() == 0
