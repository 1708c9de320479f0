"""Surrogate keys that last: a key table gives every natural key its key once, whatever is added later.

A key table is a folder of batches, one per call that found new natural keys. A batch counts once it is fully written, so a
call that dies leaves the keys as they were and is simply made again. One writer at a time may add to a key table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakestar.operators.keys import dense_key, staged
from lakestar.operators.skew import hash_of
from lakestar.sources.tables import is_complete, write_new

Hasher = Callable[[int, Sequence[str]], Column]


def salted_key(attempt: int, natural: Sequence[str]) -> Column:
    """The hashed key of a natural key, ``stable_key`` at the first attempt and another hash at each later one."""
    return hash_of(*natural) if attempt == 0 else F.xxhash64(F.lit(attempt), hash_of(*natural), *[F.col(f"`{c}`") for c in natural])


def _batches(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    return sorted(f"{path.rstrip('/')}/{n}" for n in names if n.startswith("batch-") and is_complete(spark, f"{path.rstrip('/')}/{n}"))


def read_keys(spark: SparkSession, path: str, natural: Sequence[StructField], key: str) -> DataFrame:
    """(natural keys, key) of all batches."""
    schema = StructType([*natural, StructField(key, LongType())])
    batches = _batches(spark, path)
    return spark.read.schema(schema).parquet(*batches) if batches else spark.createDataFrame([], schema)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], suffix: str) -> Column:
    """NULL is a value like others here."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{c}{suffix}"]) for c in columns])


def _without_collisions(new: DataFrame, known: DataFrame, natural: Sequence[str], key: str, hasher: Hasher) -> DataFrame:
    """Give each row a hash that no other one and no known key has: the least natural key keeps a hash, the others try the
    next one. Keys that collide are few, so all rounds but the first are small."""
    attempt, given = 0, known.select(key)
    rest, found = new, None
    while True:
        tried = rest.withColumn(key, hasher(attempt, natural))
        first = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(f"`{c}`") for c in natural])) == 1
        taken = given.withColumnRenamed(key, "_taken")
        judged = tried.withColumn("_first", first).join(taken, F.col(key) == F.col("_taken"), "left")
        judged = staged(judged.select(*natural, key, (F.col("_first") & F.col("_taken").isNull()).alias("_ok")))
        good = judged.where("_ok").select(*natural, key)
        found = good if found is None else found.unionByName(good)
        rest = judged.where("NOT _ok").select(*natural)
        if rest.isEmpty():
            return found
        given, attempt = given.union(good.select(key)), attempt + 1


def lasting_keys(
    df: DataFrame, path: str, natural: Sequence[str], key: str, hashed: bool = False, hasher: Hasher = salted_key
) -> DataFrame:
    """(natural keys, key) for every natural key of ``df`` and all that the key table at ``path`` had before.

    New natural keys are those that an anti-join with the table leaves. They get the next numbers, in their order, or with
    ``hashed`` the hash of the natural key, and where that is taken already another one. Keys once given never change.
    """
    spark = df.sparkSession
    fields = [df.schema[c] for c in natural]
    known = read_keys(spark, path, fields, key)
    old = known.select(*[F.col(f"`{c}`").alias(f"{c}__known") for c in natural])
    wanted = df.select(*natural).distinct()
    new = staged(wanted.join(old, _same(wanted, old, natural, "__known"), "left_anti"))
    if new.isEmpty():
        return known
    if hashed:
        numbered = _without_collisions(new, known, natural, key, hasher)
    else:
        last = known.agg(F.max(key)).first()[0] or 0
        numbered = dense_key(new, natural, key).withColumn(key, F.col(key) + last)
    batches = _batches(spark, path)
    number = int(batches[-1].rpartition("-")[2]) + 1 if batches else 1
    write_new(numbered.select(*natural, F.col(key).cast("long")), f"{path.rstrip('/')}/batch-{number:06d}", repair=True)
    return read_keys(spark, path, fields, key)


def with_lasting_key(dim: DataFrame, path: str, natural: Sequence[str], key: str, hashed: bool = False, hasher: Hasher = salted_key) -> DataFrame:
    """A dimension with its key column from the key table at ``path``, columns in the same order."""
    rows = dim.drop(key)
    keys = lasting_keys(rows, path, natural, key, hashed, hasher)
    keys = keys.select(*[F.col(f"`{c}`").alias(f"{c}__key") for c in natural], key)
    joined = rows.join(keys, _same(rows, keys, natural, "__key"))
    return joined.select(*[F.col(f"`{c}`") for c in dim.columns])
