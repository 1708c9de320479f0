"""Date keys, calendar parts and durations. All take dates or timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(c: Column) -> Column:
    """Calendar smart key, the int yyyymmdd."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def weekday_name(c: Column, short: bool = False) -> Column:
    """Sunday, or Sun when short."""
    return F.date_format(c, "E" if short else "EEEE")


def is_weekend(c: Column) -> Column:
    """True on Saturday and Sunday, False otherwise and for NULL."""
    return F.when(F.dayofweek(c).isin(1, 7), True).otherwise(False)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 3600
