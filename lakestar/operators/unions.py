"""Unions and the dates that occur in tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def observed_dates(sources: Iterable[tuple[DataFrame, Sequence[str]]], name: str = "date") -> DataFrame:
    """Distinct dates in the given columns, NULL left out. Each table is scanned once, whatever its number of columns."""
    frames = []
    for df, columns in sources:
        dates = [F.col(c).try_cast("date") for c in columns]
        one = dates[0] if len(dates) == 1 else F.explode(F.array(*dates))
        frames.append(df.select(one.alias(name)))
    if not frames:
        raise ValueError("no source of dates is left")
    return union_all(frames).dropna().distinct()


def explode_dates(df: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included; none where either is NULL or the range is reversed."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return df.withColumn(name, F.explode(days))
