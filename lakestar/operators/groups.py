"""First row, first value and next value within groups; distinct rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, Window, functions as F

from lakestar.operators.keys import PART, POS, by_part, last_positions, sorted_table, total_order
from lakestar.operators.skew import HOT_ROWS, hash_of, hot_keys

# Hot groups that a plan names one by one.
MAX_LITERALS = 2000


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Literal["first", "all"] = "first") -> DataFrame:
    """The first row of each group.

    ``ties="first"`` keeps one row: NULL sorts first, and further columns settle ties. Spark cuts each group down to
    one row per task before the shuffle, so a hot group costs no more than another.

    ``ties="all"`` keeps every row that holds the least value of the one order column; NULL is no value and a group
    with a NULL key is left out. The minimum is joined back rather than ranked in a window, as a join can split a
    hot group.
    """
    if ties == "all":
        (column,) = order
        least = df.groupBy(*keys).agg(F.min(column).alias(column))
        return df.join(least, [*keys, column]).select(*df.columns)
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first in ``order``, then in the order of the other columns."""
    return first_by(df, keys, order)


def first_value(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per group the values of the row that comes first in ``order``; ties go to the least values."""
    picked = [*order, *[v for v in values if v not in order]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*picked)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The value in the next row of the group, NULL in the last row. ``order`` should be total within a group.

    Ordinary groups go through a window. Groups of more than ``hot_rows`` rows are sorted over many tasks instead; where
    those are more than ``MAX_LITERALS``, all rows are.
    """

    def in_window(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)))

    hot = [row["h"] for row in hot_keys(df, keys, hot_rows).limit(MAX_LITERALS + 1).collect()]
    if not hot:
        return in_window(df)
    if len(hot) > MAX_LITERALS:
        return _next_across_ranges(df, keys, order, value, name)
    is_hot = hash_of(*keys).isin(hot)
    return in_window(df.filter(~is_hot)).unionByName(_next_across_ranges(df.filter(is_hot), keys, order, value, name))


def _next_across_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    table = sorted_table(df, [*keys, *order])
    parts = sorted(last_positions(table))
    following = F.struct(F.struct(*keys).alias("key"), F.col(value).alias("value"))
    # The last row of a range is followed by the first row of the next one: one row per range, safe to broadcast.
    heads = table.filter(F.col(POS) == 0).select(
        by_part(dict(zip(parts[1:], parts, strict=False))).alias("_before"), PART, following.alias("_head")
    )
    heads = heads.filter(F.col(PART) != parts[0]).select(F.col("_before").alias(PART), "_head")
    in_range = F.lead(following).over(Window.partitionBy(PART).orderBy(POS))
    joined = table.withColumn("_next", in_range).join(F.broadcast(heads), PART, "left")
    after = F.coalesce("_next", "_head")
    same_group = after["key"].eqNullSafe(F.struct(*keys))
    return joined.withColumn(name, F.when(same_group, after["value"])).select(*df.columns, name)
