"""Lookups of dimension rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from lakestar.operators.keys import require_unique, staged, total_order
from lakestar.operators.skew import hash_of, hot_keys


# The most a hinted broadcast may hold, by the count that goes before it.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if a count of rows and bytes shows the frame to be small; else leave the join to Spark.

    The count is an aggregate over all tasks. A frame with nested columns, whose size it does not see, gets no hint.
    """
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            return df
        else:
            width = width + 8
    size = df.agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).first()
    return F.broadcast(df) if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes else df


@dataclass(frozen=True)
class DimRef:
    """A dimension to look up.

    ``on`` pairs a fact column, or an expression of fact columns, with a dimension column; ``take`` names the columns
    to add, output name to dimension column. NULL matches NULL only if ``null_safe``. ``broadcast_rows`` asks for a
    broadcast when the dimension has at most so many rows, and bytes within bounds; without it Spark decides by size.

    Spark splits a hot fact key by itself where both sides are shuffled for the join. Where the dimension comes straight
    out of a grouping on the same key it cannot: ``hot_rows`` then spreads the fact keys with more rows than that.
    """

    dim: DataFrame
    on: Sequence[tuple[str | Column, str]]
    take: Mapping[str, str]
    null_safe: bool = False
    broadcast_rows: int | None = None
    hot_rows: int | None = None


def _spread(
    fact: DataFrame, narrow: DataFrame, names: Sequence[str], keys: Sequence[str], hot: DataFrame, hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Deal the rows of each hot key over one salt for every ``hot_rows`` of them, and repeat its dimension rows for each.

    The salt follows from the row and the task that holds it, so copies of one row are dealt out as well.
    """
    numbers = broadcast_if_small(hot.select("h", F.ceil(F.col("rows") / hot_rows).alias("_salts")))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in total_order(fact, names)], F.spark_partition_id()), F.col("_salts"))
    dealt = fact.withColumn("_h", hash_of(*names)).join(numbers.withColumnRenamed("h", "_h"), "_h", "left")
    dealt = dealt.withColumn("_fact_salt", F.coalesce(salt, F.lit(0).cast("long"))).drop("_h", "_salts")
    same_type = [F.col(key).cast(fact.schema[name].dataType) for key, name in zip(keys, names, strict=True)]
    repeated = narrow.withColumn("_h", hash_of(*same_type)).join(numbers.withColumnRenamed("h", "_h"), "_h", "left")
    each = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1).cast("long")) - 1)
    return dealt, repeated.withColumn("_dim_salt", F.explode(each)).drop("_h", "_salts")


def lookup(fact: DataFrame, ref: DimRef, how: Literal["left", "inner"] = "left") -> DataFrame:
    """Add the columns a dimension row gives to each fact row."""
    keys = [f"_dim_key_{i}" for i in range(len(ref.on))]
    narrow = ref.dim.select(
        *[F.col(column).alias(key) for key, (_, column) in zip(keys, ref.on, strict=True)],
        *[F.col(column).alias(out) for out, column in ref.take.items()],
    )
    if ref.broadcast_rows:
        narrow = broadcast_if_small(narrow, ref.broadcast_rows)
    salted, made = False, []
    names = [left for left, _ in ref.on]
    if ref.hot_rows is not None:
        # Expressions become columns, as keys are hashed and counted by name.
        made = [f"_fact_key_{i}" for i, left in enumerate(names) if not isinstance(left, str)]
        names = [left if isinstance(left, str) else f"_fact_key_{i}" for i, left in enumerate(names)]
        fact = fact.withColumns({name: left for name, (left, _) in zip(names, ref.on, strict=True) if name in made})
        hot = staged(hot_keys(fact, names, ref.hot_rows))
        if hot.first():
            fact, narrow = _spread(fact, narrow, names, keys, hot, ref.hot_rows)
            salted = True
    condition = fact["_fact_salt"] == narrow["_dim_salt"] if salted else None
    for key, left in zip(keys, names, strict=True):
        side = fact[left] if isinstance(left, str) else left
        equal = side.eqNullSafe(narrow[key]) if ref.null_safe else side == narrow[key]
        condition = equal if condition is None else condition & equal
    return fact.join(narrow, condition, how).drop(*keys, *made, "_fact_salt", "_dim_salt")


def star_join(fact: DataFrame, refs: Sequence[DimRef], strict: bool = False, check_unique: bool = False) -> DataFrame:
    """Look up several dimensions in turn.

    Strict drops the fact rows that miss one. ``check_unique`` first makes sure that no dimension multiplies rows.
    """
    for ref in refs:
        if check_unique:
            require_unique(ref.dim, [column for _, column in ref.on])
        fact = lookup(fact, ref, "inner" if strict else "left")
    return fact
