"""Calendar and temperature expressions for dated measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Julian day number of 1970-01-01.
EPOCH_JULIAN_DAY = 2440588


def julian_day(date: Column) -> Column:
    """Julian day number of a Gregorian date; null for null."""
    return (F.unix_date(date) + F.lit(EPOCH_JULIAN_DAY)).cast("int")


def decade(date: Column) -> Column:
    """First year of the decade of a date."""
    return (F.floor(F.year(date) / 10) * 10).cast("int")


def midpoint(low: Column, high: Column) -> Column:
    """Mean of two readings, null when either is missing."""
    return (low + high) / F.lit(2)


def fahrenheit_gap_in_celsius(early: Column, late: Column) -> Column:
    """How many degrees Celsius ``late`` lies above ``early``, both in Fahrenheit."""
    def to_celsius(reading: Column) -> Column:
        return (reading - F.lit(32)) * F.lit(5.0 / 9.0)

    return to_celsius(late) - to_celsius(early)
