"""Helpers for tables in which one key, or one group of copies, holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot if it holds more rows than this, whatever the size of the table: fewer fit into one task.
HOT_ROWS = 1_000_000

# Copies written out per generated array.
_CHUNK = 65_536


def hash_of(*columns: str | Column) -> Column:
    """64-bit hash of the columns. NULL counts as a value of its own in each place."""
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """(h, rows): the hash of every key with more than ``min_rows`` rows, and its exact number of rows.

    Rows are counted per task before the shuffle, so a hot key costs no more than another. The result has less than
    one row for every ``min_rows`` rows of the frame.
    """
    return df.select(hash_of(*keys).alias("h")).groupBy("h").agg(F.count("*").alias("rows")).where(F.col("rows") > min_rows)


def count_copies(df: DataFrame, name: str = "copies") -> DataFrame:
    """One row per distinct row with its number of copies; copies are merged before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias(name))


def expand_copies(df: DataFrame, count: str, number: str) -> DataFrame:
    """Write each row out ``count`` times, numbered from 1. NULL counts as one.

    Two generators in a row, so that no array grows with the number of copies.
    """
    total = F.coalesce(F.col(count), F.lit(1)).cast("long")
    start = F.col("_chunk") * _CHUNK
    return (
        df.withColumn(count, total)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / _CHUNK))))
        .withColumn(number, F.explode(F.sequence(start + 1, F.least(start + _CHUNK, F.col(count)))))
        .drop(count, "_chunk")
    )
