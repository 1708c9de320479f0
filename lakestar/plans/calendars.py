"""Calendar dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestar.functions.dates import date_key, is_weekend, weekday_name
from lakestar.operators.keys import stable_key
from lakestar.operators.unions import explode_dates, observed_dates

DateSources = Iterable[tuple[DataFrame, Sequence[str]]]


def _day_month_year() -> list[Column]:
    date = F.col("date")
    return [F.dayofmonth(date).alias("day"), F.month(date).alias("month"), F.year(date).alias("year")]


def observed_calendar(sources: DateSources) -> DataFrame:
    """Dates seen in the sources, with the smart key yyyymmdd and the full weekday name."""
    date = F.col("date")
    return observed_dates(sources).select(
        date, date_key(date).alias("date_sk"), *_day_month_year(), weekday_name(date).alias("weekday")
    )


def week_calendar(sources: DateSources) -> DataFrame:
    """Dates seen in the sources, with a generated key, ISO week, quarter and day of week (Sunday is 1)."""
    date = F.col("date")
    return observed_dates(sources).select(
        stable_key("date").alias("date_sk"),
        date,
        *_day_month_year(),
        F.weekofyear(date).alias("week"),
        F.quarter(date).alias("quarter"),
        F.dayofweek(date).alias("day_of_week"),
    )


def weekend_calendar(df: DataFrame, column: str) -> DataFrame:
    """Dates seen in one column, with a generated key, the short weekday name and a weekend flag."""
    date = F.col("date")
    return observed_dates([(df, [column])]).select(
        date,
        stable_key("date").alias("date_sk"),
        *_day_month_year(),
        weekday_name(date, short=True).alias("weekday"),
        is_weekend(date).alias("is_weekend"),
    )


def range_calendar(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Every date between the two columns of a one-row frame, with the smart key and the short weekday name."""
    date = F.col("date")
    return explode_dates(bounds.select(start, end), start, end).select(
        date_key(date).alias("date_sk"), date, *_day_month_year(), weekday_name(date, short=True).alias("weekday")
    )


def extreme_dates(spark: SparkSession, sources: DateSources, start: str | None = None, end: str | None = None) -> DataFrame:
    """(start, end), one row: the first and the last date in any of the columns, and no later or earlier than those given.

    Each source is reduced to its extremes by a scan of its date columns alone; one without dates adds nothing.
    """
    least, greatest = ([dt.date.fromisoformat(d)] if d else [] for d in (start, end))
    for df, columns in sources:
        dates = [F.col(c).cast("date") for c in columns]
        found = list(df.agg(*[F.min(d) for d in dates], *[F.max(d) for d in dates]).first())
        least += [d for d in found[: len(dates)] if d]
        greatest += [d for d in found[len(dates) :] if d]
    return spark.createDataFrame([(min(least, default=None), max(greatest, default=None))], "start date, end date")
