from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Makes a table of documents from (doc_id, text) or (doc_id, text, source) rows, with further columns."""
    def make(rows, extra: bool = True):
        rows = [(*row, "web")[:3] for row in rows]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return frame.selectExpr("*", "'en' AS lang", "1L AS n_words", "'x' AS spans", "7 AS block") if extra else frame

    return make
