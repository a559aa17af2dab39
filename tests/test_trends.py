from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.dates import decade, julian_day
from millrace.operators import trends
from millrace.plans.reports import climate_report
from millrace.sources.tables import read_climate

READINGS = "station string, name string, date date, tmin double, tmax double"
START = dt.date(1950, 1, 1)


def readings(spark, rows):
    """Rows (station, name, day after the start, temperature or None)."""
    return spark.createDataFrame(
        [(s, n, START + dt.timedelta(days=d), t, t) for s, n, d, t in rows], READINGS)


def slopes(spark, rows, missing="all_days"):
    frame = trends.station_slopes(trends.daily_means(readings(spark, rows)), missing)
    return {row["station"]: (row["name"], row["beta"]) for row in frame.collect()}


def test_julian_day_and_decade_over_many_centuries(spark):
    days = [dt.date.fromordinal(n) for n in range(1, dt.date(9999, 12, 31).toordinal(), 997)]
    days += [dt.date(2000, 2, 29), dt.date(1900, 2, 28), dt.date(1999, 12, 31), dt.date(2010, 1, 1)]
    frame = spark.createDataFrame([(day,) for day in days], "day date")
    for row in frame.select("day", julian_day(F.col("day")).alias("jdn"), decade(F.col("day")).alias("dec")).collect():
        assert row.jdn == row.day.toordinal() + 1721425
        assert row.dec == row.day.year // 10 * 10


def test_null_dates_stay_null(spark):
    row = spark.createDataFrame([(None,)], "day date").select(julian_day(F.col("day")), decade(F.col("day"))).first()
    assert tuple(row) == (None, None)


def test_slope_with_gaps(spark):
    rows = [("a", "A", 1, 2.0), ("a", "A", 2, None), ("a", "A", 4, 5.0)]
    assert slopes(spark, rows)["a"][1] == pytest.approx(0.9642857, abs=1e-6)
    assert slopes(spark, rows, "pairwise")["a"][1] == pytest.approx(1.0)


def test_slope_without_temperatures_or_with_one_day(spark):
    rows = [("none", "N", 1, None), ("none", "N", 5, None), ("one", "O", 3, 1.0), ("one", "O", 3, 2.0)]
    got = slopes(spark, rows)
    assert got["none"] == ("N", 0.0)
    assert got["one"] == ("O", None)


def test_renamed_station_keeps_its_first_name(spark):
    rows = [("s", "new", 9, 3.0), ("s", "old", 1, 1.0), ("s", "mid", 5, 2.0)]
    name, beta = slopes(spark, rows)["s"]
    assert name == "old" and beta == pytest.approx(0.25)


def test_slope_against_a_pandas_group_function(spark):
    rng = random.Random(5)
    rows = [
        (f"s{rng.randrange(20)}", "x", rng.randrange(20000), None if rng.random() < 0.3 else rng.uniform(-30, 110))
        for _ in range(3000)
    ]
    daily = trends.daily_means(readings(spark, rows))

    def by_pandas(key, group: pd.DataFrame) -> pd.DataFrame:
        x = group["jdn"] - group["jdn"].mean()
        y = group["avg_t"] - group["avg_t"].mean()
        return pd.DataFrame({"station": [key[0]], "twin": [(x * y).sum() / (x * x).sum()]})

    twin = daily.groupBy("station").applyInPandas(by_pandas, "station string, twin double")
    both = trends.station_slopes(daily).join(twin, "station").collect()
    assert len(both) == 20
    for row in both:
        assert row.beta == pytest.approx(row.twin, rel=1e-9)


def test_slopes_stay_hash_aggregated_on_the_big_side(spark):
    daily = trends.daily_means(readings(spark, [("a", "A", 1, 1.0)]))
    plan = trends.station_slopes(daily)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    deepest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in deepest


def decade_rows():
    d = dt.date
    return [
        ("a", "A", d(1915, 1, 1), 50.0, 50.0), ("a", "A", d(1919, 12, 31), 32.0, 32.0),
        ("a", "A", d(2010, 1, 1), 59.0, 59.0), ("a", "A", d(2020, 1, 1), 0.0, 0.0),
        ("early", "E", d(1911, 1, 1), 1.0, 1.0),
        ("r", "old", d(1912, 1, 1), 32.0, 32.0), ("r", "older", d(1913, 1, 1), 41.0, 41.0),
        ("r", "new", d(2012, 1, 1), 50.0, 50.0),
        ("gap", "G", d(1912, 1, 1), None, 32.0), ("gap", "G", d(2012, 1, 1), 50.0, 50.0),
    ]


def test_decade_difference(spark):
    daily = trends.daily_means(spark.createDataFrame(decade_rows(), READINGS))
    got = {(r["station"], r["name"]): r["diff_c"] for r in trends.decade_difference(daily).collect()}
    assert set(got) == {("a", "A"), ("r", "old"), ("r", "older"), ("gap", "G")}
    assert got["a", "A"] == pytest.approx((59 - 41) * 5 / 9)
    assert got["r", "old"] == pytest.approx(10.0) and got["r", "older"] == pytest.approx(5.0)
    assert got["gap", "G"] is None


def test_one_scan_gives_the_same_as_separate_ones(spark):
    daily = trends.daily_means(spark.createDataFrame(decade_rows(), READINGS))
    profile = trends.station_profile(daily, (1910, 2010))

    def rows(df):
        return sorted(tuple(row) for row in df.fillna(-99.0).collect())

    assert rows(trends.slopes_of(profile)) == rows(trends.station_slopes(daily))
    assert rows(trends.averages_of(profile)) == rows(trends.decade_averages(daily, (1910, 2010)))
    averages = trends.averages_of(profile)
    change = trends.decade_change(averages.filter("decade = 1910"), averages.filter("decade = 2010"))
    assert rows(change) == rows(trends.decade_difference(daily))


def test_fraction_counts_nulls_below_the_line(spark):
    frame = spark.createDataFrame([(1.0,), (-1.0,), (None,), (2.0,)], "v double")
    assert trends.positive_fraction(frame, "v").first().fraction == 0.5
    assert trends.positive_fraction(frame.limit(0), "v").first().fraction is None


def test_five_numbers_are_elements_and_skip_nulls(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(1, 9)] + [(None,)], "v double")
    assert tuple(trends.five_numbers(frame, "v", 1e-6).first()) == (1.0, 2.0, 4.0, 6.0, 8.0)
    assert tuple(trends.summary(frame, "v", 1e-6).first())[1:] == (1.0, 2.0, 4.0, 6.0, 8.0)


def test_top_puts_nulls_last(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 1.0), ("d", 2.0)], "k string, v double")
    assert [r.k for r in trends.top_by(frame, "v", 3, "k").collect()] == ["d", "b", "c"]


CSV = '''"STATION","DATE","LATITUDE","NAME","TMAX","TMIN"
"US1","1915-03-01","1.0","CRESTON, WY US","50","32"
"US1","1916-03-01","1.0","CRESTON, WY US","","32"
"US1","2015-03-01","1.0","CRESTON, WY US","  70","52"
'''


def test_climate_file(spark, tmp_path):
    (tmp_path / "climate.csv").write_text(CSV)
    for infer in (False, True):
        got = read_climate(spark, str(tmp_path / "climate.csv"), infer).orderBy("date").collect()
        assert [r["name"] for r in got] == ["CRESTON, WY US"] * 3
        assert [r["date"] for r in got] == [dt.date(1915, 3, 1), dt.date(1916, 3, 1), dt.date(2015, 3, 1)]
    got = read_climate(spark, str(tmp_path / "climate.csv")).orderBy("date").collect()
    assert [(r["tmin"], r["tmax"]) for r in got] == [(32.0, 50.0), (32.0, None), (52.0, 70.0)]


def test_climate_report(spark):
    report = climate_report(spark.createDataFrame(decade_rows(), READINGS), error=1e-6)
    assert report.top_differences.first()["station"] == "a" or report.top_differences.first()["diff_c"] == 10.0
    assert report.difference_summary.first().fraction == 0.75
    assert report.slope_summary.count() == 1 and report.top_slopes.count() == 4


def test_climate_report_without_matching_decades(spark):
    report = climate_report(spark.createDataFrame(decade_rows(), READINGS), 1930, 1940)
    assert tuple(report.difference_summary.first()) == (None,) * 6
    assert report.top_differences.count() == 0


def test_a_busy_station_is_combined_before_it_moves(spark, tmp_path):
    """A third of all rows on one station, broadcasts off: no exchange moves raw rows."""
    from millrace.plans.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    busy = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey"))
    orders.withColumn("o_custkey", busy).write.parquet(str(tmp_path / "orders.parquet"))
    spark.read.parquet(f"{folder}/customer.parquet").write.parquet(str(tmp_path / "customer.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("decade_avg", "decade_diff", "group_slope", "climate_profile"):
            lines = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString().splitlines()
            depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
            scans = [at for at, line in enumerate(lines) if "Scan" in line and "o_custkey" in line]
            assert scans
            for at in scans:
                above, seen = depth[at], ""
                for line, own in zip(lines[at::-1], depth[at::-1]):
                    if own < above:
                        above, seen = own, seen + line
                        if "Exchange" in line:
                            break
                assert "partial_" in seen, (name, seen)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("values", [
    [1.0], [None, 3.0, None], [2.0] * 50, [float(i % 7) for i in range(500)], [10.0 ** (i - 150) for i in range(300)],
    [-(1.5 ** i) for i in range(200)] + [0.0] * 150, [1.0] * 400 + [float(i) for i in range(100)]])
def test_exact_quantiles_of_any_values(spark, values, monkeypatch):
    monkeypatch.setattr(trends, "GATHERED", 4)
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    known, ranks = sorted(v for v in values if v is not None), [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = [known[max(1, math.ceil(p * len(known))) - 1] for p in ranks]
    assert trends.exact_quantiles(frame, "v", ranks) == want


def test_exact_quantiles_of_many_rows(spark):
    """Skewed values, a third of them equal, more than are ever gathered."""
    frame = spark.range(300_000).selectExpr("if(id % 3 = 0, 7.5, pow(1.0001, id)) AS v").repartition(5)
    known = sorted(7.5 if i % 3 == 0 else 1.0001 ** i for i in range(300_000))
    got = tuple(trends.exact_five_numbers(frame, "v").first())
    assert got == pytest.approx([known[0], known[74_999], known[149_999], known[224_999], known[-1]], rel=1e-9)
    assert tuple(trends.exact_five_numbers(frame.limit(0), "v").first()) == (None,) * 5
