"""Trends of dated station measurements.

``readings`` holds ``station, name, date, tmin, tmax``; ``daily`` adds the day
number, the decade and the mean temperature.
"""

from __future__ import annotations

import math

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import decade, fahrenheit_gap_in_celsius, julian_day, midpoint

# Later than any day number, for rows without a date.
UNDATED = 2**31 - 1


def daily_means(readings: DataFrame) -> DataFrame:
    return readings.select(
        "station", "name", "date",
        julian_day(F.col("date")).alias("jdn"),
        decade(F.col("date")).alias("decade"),
        midpoint(F.col("tmin"), F.col("tmax")).alias("avg_t"),
    )


def station_profile(daily: DataFrame, decades: tuple[int, ...] = (), missing: str = "all_days") -> DataFrame:
    """All that slopes and decade averages need, from one scan.

    One row per station with its slope, one per station and name with the first day,
    and one per station, name and decade asked for (or none of them) with the mean
    temperature; ``level`` is 'station', 'name' or 'decade'.  All buffers are numbers,
    so the big aggregation stays a hash aggregation; text would make it a sorted one.
    """
    if missing not in ("all_days", "pairwise"):
        raise ValueError("missing must be 'all_days' or 'pairwise'")
    x, y = F.col("jdn").cast("double"), F.col("avg_t").cast("double")
    if missing == "all_days":
        cross, spread = F.coalesce(F.regr_sxy(y, x), F.lit(0.0)), F.var_pop(x) * F.count(x)
    else:
        cross, spread = F.regr_sxy(y, x), F.regr_sxx(y, x)
    chosen = F.col("decade").isin(*decades) if decades else F.lit(False)
    rows = daily.select("station", "name", "jdn", "avg_t", F.when(chosen, F.col("decade")).alias("decade"))
    levels = [["station"], ["station", "name"]] + ([["station", "name", "decade"]] if decades else [])
    keys = levels[-1]
    level = F.when(F.grouping("name") == 1, "station")
    if decades:
        level = level.when(F.grouping("decade") == 0, "decade")
    return rows.groupingSets(levels, *keys).agg(
        level.otherwise("name").alias("level"),
        F.min("jdn").alias("first_day"),
        (cross / F.nullif(spread, F.lit(0.0))).alias("beta"),
        F.avg("avg_t").alias("mean_t"),
    )


def slopes_of(profile: DataFrame) -> DataFrame:
    """``station, name, beta`` from a profile; the name is that of the earliest day."""
    whole = F.col("level") == "station"
    dated = F.struct(F.coalesce("first_day", F.lit(UNDATED)).alias("day"), "name")
    earliest = F.min(F.when(F.col("level") == "name", dated))
    return profile.filter(F.col("level") != "decade").groupBy("station").agg(
        earliest["name"].alias("name"), F.max(F.when(whole, F.col("beta"))).alias("beta")
    )


def averages_of(profile: DataFrame) -> DataFrame:
    """``station, name, decade, decade_avg`` from a profile."""
    rows = profile.filter((F.col("level") == "decade") & F.col("decade").isNotNull())
    return rows.select("station", "name", "decade", F.col("mean_t").alias("decade_avg"))


def station_slopes(daily: DataFrame, missing: str = "all_days") -> DataFrame:
    """Least-squares slope of ``avg_t`` on ``jdn`` per station: ``station, name, beta``.

    With ``missing='all_days'`` the spread of days counts all rows of the station,
    also those without a temperature, so gaps pull the slope towards zero, and a
    station without any temperature has slope 0.  ``'pairwise'`` counts complete
    rows only.  A station with a single day has a null slope.
    """
    return slopes_of(station_profile(daily, (), missing))


def within_decades(day: Column, decades: tuple[int, ...]) -> Column:
    """True for dates in the decades, as date ranges that a scan can skip by."""
    chosen = F.lit(False)
    for start in decades:
        after = F.lit(date(start + 10, 1, 1))
        chosen = chosen | ((day >= F.lit(date(start, 1, 1))) & (day < after))
    return chosen


def decade_averages(daily: DataFrame, decades: tuple[int, ...]) -> DataFrame:
    """Mean temperature by station, name and decade, for the decades asked for."""
    chosen = daily.filter(within_decades(F.col("date"), decades)).filter(F.col("decade").isin(*decades))
    return chosen.groupBy("station", "name", "decade").agg(F.avg("avg_t").alias("decade_avg"))


def decade_change(early: DataFrame, late: DataFrame) -> DataFrame:
    """Change in degrees Celsius between the averages of two decades, where there are both.

    Averages are per name but joined by station, so a renamed station has a row per
    pair of names.
    """
    before = early.select("station", "name", F.col("decade_avg").alias("early_avg"))
    after = late.select("station", F.col("decade_avg").alias("late_avg"))
    change = fahrenheit_gap_in_celsius(F.col("early_avg"), F.col("late_avg"))
    return before.join(after, "station").withColumn("diff_c", change)


def decade_difference(daily: DataFrame, early: int = 1910, late: int = 2010) -> DataFrame:
    """The same from daily means.

    The dates of each decade reach the scan of its side, and each side is reduced to
    one row per name before it meets the other.
    """
    return decade_change(decade_averages(daily, (early,)), decade_averages(daily, (late,)))


def top_by(df: DataFrame, value: str, k: int = 5, *ties: str) -> DataFrame:
    """The k rows with the largest value, nulls last, ties in the order of ``ties``."""
    return df.orderBy(F.desc_nulls_last(value), *ties).limit(k)


def positive_share(value: str) -> Column:
    """Share of rows above zero; rows without a value count below the line."""
    rows = F.nullif(F.count(F.lit(1)), F.lit(0).cast("bigint"))
    return F.count_if(F.col(value) > 0) / rows


def positive_fraction(df: DataFrame, value: str) -> DataFrame:
    return df.agg(positive_share(value).alias("fraction"))


# The names and ranks of the five-number summary.
FIVE_RANKS = {"min_value": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max_value": 1.0}


#: Values that are gathered once no more than these lie where a rank is, and the width of a step around it.
GATHERED, STEP = 10_000, 0.002


def exact_quantiles(df: DataFrame, value: str, ranks: list[float]) -> list[object]:
    """For each rank p the value at place ceil(p * n) of the n values in order, nulls left out; None without values.

    Each round draws the borders of a narrow step around each rank from a sketch of the values that are left,
    and counts exactly what lies below, in and on them, so that the next round looks only where the rank is.  That
    is a thousandth of the values a round, until few are left or all are equal; the state of a pass is
    bounded whatever the values are.  Runs when called.
    """
    column = F.col(value)
    whole = df.agg(F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).first()
    if not whole.n:
        return [None] * len(ranks)
    places = {p: min(max(1, math.ceil(p * whole.n)), whole.n) for p in ranks}
    found = {p: whole.low if at == 1 else whole.high for p, at in places.items() if at in (1, whole.n)}
    # Per rank: what may hold it, and how many values lie before that and in it.
    left = {p: (whole.low, whole.high, 0, whole.n) for p in ranks if p not in found}

    def within(low: object, high: object) -> Column:
        return (column >= F.lit(low)) & (column <= F.lit(high))

    while left:
        for p in [p for p, (low, high, _, _) in left.items() if low == high]:
            found[p] = left.pop(p)[0]
        few = {p: part for p, part in left.items() if part[3] <= GATHERED}
        if few:
            row = df.agg(*[F.sort_array(F.collect_list(F.when(within(low, high), column))).alias(f"v{i}") for i, (low, high, _, _) in enumerate(few.values())]).first()
            for i, (p, (_, _, before, _)) in enumerate(few.items()):
                found[p] = row[i][places[p] - before - 1]
                del left[p]
        if not left:
            break
        # The borders, from a sketch of each part ...
        asked = [F.percentile_approx(F.when(within(low, high), column), [max(0.0, (places[p] - before) / n - STEP), min(1.0, (places[p] - before) / n + STEP)], round(2 / STEP)).alias(f"s{i}")
                 for i, (p, (low, high, before, n)) in enumerate(left.items())]
        borders = df.agg(*asked).first()
        # ... and exact counts of what lies before, on, between and on them.
        counts = []
        for i, (low, high, _, _) in enumerate(left.values()):
            a, b = borders[i]
            here = within(low, high)
            counts += [F.count_if(here & test).alias(f"c{i}_{k}") for k, test in enumerate((column < F.lit(a), column == F.lit(a), (column > F.lit(a)) & (column < F.lit(b)), column == F.lit(b) if a != b else F.lit(False)))]
            counts += [F.max(F.when(here & (column < F.lit(a)), column)).alias(f"m{i}"), F.min(F.when(here & (column > F.lit(a)) & (column < F.lit(b)), column)).alias(f"l{i}"),
                       F.max(F.when(here & (column > F.lit(a)) & (column < F.lit(b)), column)).alias(f"h{i}"), F.min(F.when(here & (column > F.lit(b)), column)).alias(f"o{i}")]
        row = df.agg(*counts).first()
        for i, (p, (low, high, before, n)) in enumerate(list(left.items())):
            (a, b), at = borders[i], places[p] - before
            sizes = [row[f"c{i}_{k}"] for k in range(4)]
            parts = [(low, row[f"m{i}"]), (a, a), (row[f"l{i}"], row[f"h{i}"]), (b, b), (row[f"o{i}"], high)]
            for (first, last), size in zip(parts, [*sizes, n - sum(sizes)]):
                if at <= size:
                    left[p] = first, last, before, size
                    break
                at, before = at - size, before + size
    return [found[p] for p in ranks]


def exact_five_numbers(df: DataFrame, value: str) -> DataFrame:
    """Least value, quartiles and greatest value, exact for any number of rows.  Runs when called."""
    names = list(FIVE_RANKS)
    row = exact_quantiles(df, value, list(FIVE_RANKS.values()))
    kind = df.schema[value].dataType.simpleString()
    return df.sparkSession.createDataFrame([tuple(row)], ", ".join(f"{name} {kind}" for name in names))


def five_numbers(df: DataFrame, value: str, error: float = 0.01) -> DataFrame:
    """Least value, quartiles and greatest value, each an element of the data.

    Ranks are off by at most ``error`` times the rows; nulls are skipped.  The state
    is a sketch whose size depends on ``error`` only; ``exact_five_numbers`` has no error.
    """
    sketch = F.percentile_approx(F.col(value), list(FIVE_RANKS.values()), round(1 / error))
    row = df.agg(sketch.alias("q"))
    return row.select(*[F.col("q")[i].alias(name) for i, name in enumerate(FIVE_RANKS)])


def summary(df: DataFrame, value: str, error: float = 0.01) -> DataFrame:
    """Positive fraction and five numbers together, in one pass."""
    sketch = F.percentile_approx(F.col(value), list(FIVE_RANKS.values()), round(1 / error))
    row = df.agg(positive_share(value).alias("fraction"), sketch.alias("q"))
    return row.select("fraction", *[F.col("q")[i].alias(name) for i, name in enumerate(FIVE_RANKS)])
