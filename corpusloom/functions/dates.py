"""Partial dates: any of year, month and day may be missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_in_month(year: Column, month: Column) -> Column:
    """Days of a month in the proleptic calendar; a missing year counts as 2000."""
    y = F.coalesce(year, F.lit(2000))
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def valid_date(year: Column, month: Column, day: Column) -> Column:
    """Whether a partial date can be: one part at least, each in its range, the day within its month."""
    some = year.isNotNull() | month.isNotNull() | day.isNotNull()
    ranges = F.coalesce(month.between(1, 12), F.lit(True)) & F.coalesce(day.between(1, 31), F.lit(True))
    fits = F.when(month.isNotNull() & day.isNotNull(), day <= days_in_month(year, month)).otherwise(True)
    return some & ranges & fits


def odd_year(year: Column) -> Column:
    """A year that isn't written with four digits."""
    return F.coalesce(~year.between(1000, 9999), F.lit(False))


def display_date(year: Column, month: Column, day: Column) -> Column:
    """The parts that are there, each with its sign."""
    part = lambda c, sign: F.when(c.isNotNull(), F.concat(c.cast("string"), F.lit(sign))).otherwise("")
    return F.concat(part(year, "年"), part(month, "月"), part(day, "日"))


def local_date(when: Column, offset: str = "+08:00") -> Column:
    """The date of a UTC time at a fixed offset, as text."""
    return F.date_format(F.from_utc_timestamp(when, offset), "yyyy-MM-dd")
