"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from lakestar.operators.skew import count_copies, expand_copies, hash_of
from lakestar.session import scratch_path

# Columns of a sorted table: the range partition a row lies in and its place there.
PART, POS = "_part", "_pos"
_ROW, _COPY = "_row", "_copy"
# monotonically_increasing_id keeps the partition number above these bits and the place in it below.
_POS_BITS = 33


def stable_key(*natural: str) -> Column:
    """64-bit key that follows from the natural key alone, so that lazy plans and reruns agree on it.

    One int, long or date column cannot collide. For other keys use ``duplicates`` on the result, or ``dense_key``.
    """
    return hash_of(*natural)


def unique_id() -> Column:
    """64-bit row id for rows that nothing else refers to; needs no shuffle. It is fixed once the rows are written."""
    return F.monotonically_increasing_id()


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The frame itself, or an error if a key occurs twice."""
    found = duplicates(df, key).first()
    if found:
        raise ValueError(f"key {', '.join(key)} is not unique, e.g. {found.asDict()}")
    return df


def missing_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, rows, missing): how many rows of a fact have found no dimension row, key by key, in one pass."""
    counts = fact.agg(F.count("*").alias("rows"), *[F.count_if(F.col(k).isNull()).alias(f"_{i}") for i, k in enumerate(keys)])
    each = [F.struct(F.lit(k).alias("key"), F.col("rows").alias("rows"), F.col(f"_{i}").alias("missing")) for i, k in enumerate(keys)]
    return counts.select(F.explode(F.array(*each)).alias("_k")).select("_k.*")


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def total_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """``order`` followed by every other column that can be sorted, so that only exact copies tie."""
    return [*order, *[f.name for f in df.schema.fields if f.name not in order and _sortable(f.dataType)]]


def staged(df: DataFrame) -> DataFrame:
    """Write the frame to the shared scratch folder and read it back, so that what it took is done once.

    Worth it before a sort over all tasks, which runs its input twice: once to find the ranges, once to sort.
    """
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_table(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort the whole frame over all tasks and write it to the shared scratch folder.

    The table read back has two more columns: PART, a number that rises with the sort order, and POS, which counts
    from 0 within each PART. As they are stored, a lost executor cannot change them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    cols = [F.col(f"`{name}`") for name in order]
    numbered = df.orderBy(*cols).withColumn(_ROW, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    row = F.col(_ROW)
    return (
        spark.read.schema(numbered.schema)
        .parquet(path)
        .withColumn(PART, F.shiftright(row, _POS_BITS))
        .withColumn(POS, row.bitwiseAND((1 << _POS_BITS) - 1))
        .drop(_ROW)
    )


def last_positions(table: DataFrame) -> dict[int, int]:
    """Highest POS of each part of a sorted table: one entry per range partition, however large the table is."""
    return {r[PART]: r["last"] for r in table.groupBy(PART).agg(F.max(POS).alias("last")).collect()}


def by_part(values: dict[int, int]) -> Column:
    """Look a number up by PART in an array constant."""
    texts = [str(values.get(part, 0)) for part in range(max(values, default=0) + 1)]
    return F.element_at(F.split(F.lit(",".join(texts)), ",").cast("array<bigint>"), F.col(PART).cast("int") + 1)


def dense_key(df: DataFrame, order: Sequence[str], name: str, copies: bool = False) -> DataFrame:
    """Number the rows 1..n in the given order, as ``row_number() over (order by ...)`` does, without its single task.

    The rows are sorted over all tasks; each gets its place in its range plus the size of the ranges before. Ties
    are broken by the other columns, so a hot value of the first column is spread as well. Set ``copies`` where many
    rows may be equal in every column: they are merged before the sort and numbered apart.
    """
    columns = df.columns
    if copies:
        df = expand_copies(count_copies(df, "_copies"), "_copies", _COPY)
    table = sorted_table(df, total_order(df, order))
    offsets, before = {}, 0
    for part, last in sorted(last_positions(table).items()):
        offsets[part] = before
        before += last + 1
    return table.select(*[F.col(f"`{c}`") for c in columns], (by_part(offsets) + F.col(POS) + 1).alias(name))
