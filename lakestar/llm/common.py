"""Helpers that several operators share: staged tables, word positions and word hashes of whole texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lakestar.session import scratch_path

# Multiplier of the rolling hash (odd, so that it has an inverse modulo 2^64) and mixing constants.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# One random 64-bit value per byte, so that byte strings of small numbers don't cancel out.
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Powers of BASE and of its inverse, kept between calls.
_powers = _inverse = np.ones(1, dtype=np.uint64)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it again: later steps neither recompute it nor depend on
    the executors that made it. The shuffle files behind it are of no use any more and are freed."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    # Spark drops shuffle files once the driver's JVM has collected the plan that made them.
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(df: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that other columns are never read and can't clash; NULL text becomes empty."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(modulus: int, remainder: int) -> Column:
    """True where crc32 of the doc_id as text leaves ``remainder``; a NULL id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** 0 .. BASE ** n and the same of its inverse."""
    global _powers, _inverse
    if len(_powers) <= n:
        more = np.full(max(n + 1, 2 * len(_powers), 1 << 16), BASE, dtype=np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
        more[1:] = pow(int(BASE), -1, 1 << 64)
        _inverse = np.multiply.accumulate(more)
    return _powers, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Hash of data[:i] for every i, as polynomial sums with rising powers (uint64 arithmetic wraps)."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] whatever the place: the sum is scaled back to power 0."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


# The bytes that end a word (blank and 0x09-0x0D), and A-Z to a-z.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not white space."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One hash per word of the bytes, A-Z lower-cased."""
    start, end = word_bounds(data)
    return range_hash(prefix_hash(LOWER[data]), start, end)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash per window of ``n`` words; the whole sequence as one window if it is shorter; none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    count = len(words) - n + 1
    out = np.full(count, n, dtype=np.uint64)
    for i in range(n):
        out = out * BASE + words[i : i + count]
    return mix(out)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)


def bytes_of(column, i: int) -> np.ndarray:
    """The UTF-8 bytes of row ``i`` of an Arrow string or binary column without a copy; NULL is empty."""
    value = column[i]
    if not value.is_valid:
        return np.empty(0, dtype=np.uint8)
    return np.frombuffer(value.as_buffer(), dtype=np.uint8)
