from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestar.operators import skew
from lakestar.operators.keys import dense_key, duplicates, require_unique, sorted_table, stable_key, unique_id
from lakestar.operators.skew import count_copies, expand_copies, hot_keys
from tests.helpers import plan, rows


@pytest.fixture
def many_ranges(spark):
    """Keep small sorts in several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def numbered(values):
    """Brute force: values in order, NULL first, numbered from 1."""
    ordered = sorted(values, key=lambda t: tuple((v is not None, v) for v in t))
    return [(i + 1, *t) for i, t in enumerate(ordered)]


def test_dense_key_equals_row_number(spark, many_ranges):
    data = [(i * 7919 % 1000, f"v{i}") for i in range(1000)] + [(None, "n1"), (None, "n2"), (5, None)]
    df = spark.createDataFrame(data, "k int, v string").repartition(5)
    out = dense_key(df, ["k"], "sk")
    assert out.columns == ["k", "v", "sk"]
    assert rows(out, "sk", "k", "v") == numbered(data)


def test_dense_key_spreads_a_hot_first_column(spark, many_ranges):
    data = [(1 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, id int")
    table = sorted_table(df, ["k", "id"])
    hot_parts = table.filter("k = 1").select("_part").distinct().count()
    assert hot_parts > 1
    assert rows(dense_key(df, ["k"], "sk"), "sk", "k", "id") == numbered(data)


def test_dense_key_spreads_copies(spark, many_ranges, monkeypatch):
    monkeypatch.setattr(skew, "_CHUNK", 100)
    data = [("same", 1)] * 1000 + [("other", i) for i in range(500)] + [(None, None)] * 3
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(dense_key(df, ["k"], "sk", copies=True), "sk", "k", "v") == numbered(data)


def test_dense_key_of_nothing_and_of_one_row(spark):
    assert dense_key(spark.createDataFrame([], "k int"), ["k"], "sk").collect() == []
    assert rows(dense_key(spark.createDataFrame([(9,)], "k int"), ["k"], "sk")) == [(9, 1)]


def test_dense_key_has_no_window_and_no_single_task(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    text = plan(dense_key(df, ["k"], "sk"))
    assert "Window" not in text and "SinglePartition" not in text and "Exchange" not in text


def test_stable_key(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    keys = [r[0] for r in df.select(stable_key("x", "y")).collect()]
    assert len(set(keys)) == 4 and None not in keys
    again = [r[0] for r in df.repartition(3).orderBy("x", "y").select(stable_key("x", "y")).collect()]
    assert sorted(keys) == sorted(again)


def test_stable_key_of_one_number_never_collides(spark):
    df = spark.range(200_000).select((F.col("id") * 1_000_003 - 7).alias("id")).select(stable_key("id").alias("k"))
    assert df.distinct().count() == 200_000


def test_unique_id(spark):
    assert spark.range(1000).repartition(7).select(unique_id().alias("k")).distinct().count() == 1000


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(duplicates(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError, match="not unique"):
        require_unique(df, ["k"])
    require_unique(df.distinct(), ["k"])


def test_copies_come_back(spark, monkeypatch):
    monkeypatch.setattr(skew, "_CHUNK", 4)
    data = [("a", 1)] * 10 + [("b", 2)] * 4 + [("c", None)]
    df = spark.createDataFrame(data, "k string, v int")
    counted = count_copies(df)
    assert rows(counted) == [("a", 1, 10), ("b", 2, 4), ("c", None, 1)]
    out = expand_copies(counted, "copies", "number")
    assert rows(out, "k", "number") == [("a", i) for i in range(1, 11)] + [("b", i) for i in range(1, 5)] + [("c", 1)]


def test_hot_keys_are_found(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    assert rows(hot_keys(df, ["k"])) == []
    null_hash = df.filter("k is null").limit(1).select(skew.hash_of("k")).first()[0]
    assert rows(hot_keys(df, ["k"], 100)) == [(null_hash, 3000)]
