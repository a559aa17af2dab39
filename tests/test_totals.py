from __future__ import annotations

import pytest

from millrace.operators.totals import largest, star_totals
from millrace.sources.tables import read_resources, write_result

FILE = """Constellation,Star,Kind,Mass,Age,Resource Units
Orion,Prime,x,1,1,10
Orion,Beta,x,1,1,5
Orion,Beta,x,1,1,7
Lyra,Prime,"x,1,1,12
Constellation,Star,Kind,Mass,Age,Resource Units
Lyra,Alpha,x,1,1,2
"""


@pytest.fixture()
def totals(spark, tmp_path):
    (tmp_path / "resources.csv").write_text(FILE)
    return star_totals(read_resources(spark, str(tmp_path / "resources.csv")))


def pairs(df):
    return [tuple(row) for row in df.collect()]


def test_totals_by_composed_name(totals):
    assert dict(pairs(totals)) == {"Orion": 10, "Beta Orion": 12, "Lyra": 12, "Alpha Lyra": 2}


def test_largest_breaks_ties_by_name_from_the_end(totals):
    assert pairs(largest(totals, 3)) == [("Lyra", 12), ("Beta Orion", 12), ("Orion", 10)]


def test_zero_keeps_all_and_more_than_there_are_is_fine(totals):
    assert len(pairs(largest(totals, 0))) == 4
    assert len(pairs(largest(totals, 99))) == 4
    with pytest.raises(ValueError):
        largest(totals, -1)


def test_units_must_be_numbers(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("Orion,Prime,x,1,1,many\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        star_totals(read_resources(spark, str(tmp_path / "bad.csv"))).collect()


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_results_can_be_stored(spark, totals, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_result(totals, path, fmt)
    back = spark.read.schema(totals.schema).option("header", True).format(fmt).load(path)
    assert sorted(pairs(back)) == sorted(pairs(totals))


def test_unknown_sink_is_refused(totals, tmp_path):
    with pytest.raises(ValueError):
        write_result(totals, str(tmp_path / "x"), "xml")
