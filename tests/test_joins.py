from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestar.operators.joins import DimRef, broadcast_if_small, lookup, star_join
from tests.helpers import executed_plan, plan, rows


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "y"), (4, "c", "x")], "id int, k string, v string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(10, "a"), (20, "b"), (30, None)], "sk int, name string")


def test_left_lookup_keeps_every_fact(fact, dim):
    out = lookup(fact, DimRef(dim, [("k", "name")], {"dim_sk": "sk"}))
    assert out.columns == ["id", "k", "v", "dim_sk"]
    assert rows(out, "id", "dim_sk") == [(1, 10), (2, 20), (3, None), (4, None)]


def test_null_safe_lookup(fact, dim):
    out = lookup(fact, DimRef(dim, [("k", "name")], {"dim_sk": "sk"}, null_safe=True))
    assert rows(out, "id", "dim_sk") == [(1, 10), (2, 20), (3, 30), (4, None)]


def test_lookup_by_expression_and_same_names(spark, fact):
    dim = spark.createDataFrame([(7, "A")], "id int, k string")
    out = lookup(fact, DimRef(dim, [(F.upper("k"), "k")], {"dim_id": "id"}))
    assert rows(out, "id", "k", "dim_id") == [(1, "a", 7), (2, "b", None), (3, None, None), (4, "c", None)]


def test_strict_star_drops_what_misses_a_dimension(spark, fact, dim):
    other = spark.createDataFrame([(1, "x")], "osk int, o string")
    refs = [DimRef(dim, [("k", "name")], {"sk": "sk"}), DimRef(other, [("v", "o")], {"osk": "osk"})]
    assert rows(star_join(fact, refs, strict=True), "id", "sk", "osk") == [(1, 10, 1)]
    assert star_join(fact, refs).count() == 4


def test_one_dimension_in_two_roles(fact, dim):
    refs = [DimRef(dim, [("k", "name")], {"first": "sk"}), DimRef(dim, [("v", "name")], {"second": "sk"})]
    assert rows(star_join(fact, refs), "id", "first", "second") == [
        (1, 10, None), (2, 20, None), (3, None, None), (4, None, None),
    ]


def test_star_refuses_a_dimension_with_duplicates(fact, dim):
    with pytest.raises(ValueError, match="not unique"):
        star_join(fact, [DimRef(dim.union(dim), [("k", "name")], {"sk": "sk"})], check_unique=True)


def test_broadcast_only_after_a_count(spark, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).withColumn("k", F.col("id").cast("string"))
        small = DimRef(dim, [("k", "name")], {"sk": "sk"}, broadcast_rows=3)
        large = DimRef(dim, [("k", "name")], {"sk": "sk"}, broadcast_rows=2)
        assert "BroadcastHashJoin" in plan(lookup(facts, small))
        assert "SortMergeJoin" in plan(lookup(facts, large))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert rows(broadcast_if_small(dim, 1)) == rows(dim)


def test_broadcast_counts_bytes_too(spark, dim):
    hinted = "ResolvedHint"

    def logical(df):
        return df._jdf.queryExecution().analyzed().toString()

    assert hinted in logical(broadcast_if_small(dim))
    assert hinted not in logical(broadcast_if_small(dim, max_bytes=10))
    assert hinted not in logical(broadcast_if_small(dim.withColumn("nested", F.array("name"))))
    assert hinted in logical(broadcast_if_small(dim.limit(0)))


def test_a_hot_key_is_split_in_a_chain_of_lookups(spark, tmp_path):
    """Two dimensions on one key: the second needs the partitioning that splitting the first takes away."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000)
        path = str(tmp_path / "facts")
        spark.range(60_000).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(16).write.parquet(path)
        facts = spark.read.parquet(path)
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("sk"))
        refs = [DimRef(dim, [("k", "k")], {"a": "sk"}), DimRef(dim, [("k", "k")], {"b": "sk"})]
        out = star_join(facts, refs)
        found = out.collect()
        assert len(found) == 60_000 and all(r["a"] == r["b"] == 2 * r["k"] for r in found)
        assert "isSkewJoin=true" in executed_plan(out) or "skew=true" in executed_plan(out)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_hot_keys_are_spread_over_salts(spark):
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id") % 1000)
    facts = spark.range(6000).select("id", key.alias("k"))
    counts = spark.range(500).groupBy((F.col("id") % 250).cast("int").alias("k")).agg(F.count("*").alias("n"))
    expected = rows(lookup(facts, DimRef(counts, [("k", "k")], {"n": "n"})))
    spread = lookup(facts, DimRef(counts, [("k", "k")], {"n": "n"}, hot_rows=100))
    assert "_fact_salt" in plan(spread) and rows(spread) == expected
    assert "_fact_salt" not in plan(lookup(facts, DimRef(counts, [("k", "k")], {"n": "n"}, hot_rows=10_000)))


def test_hot_keys_may_be_expressions_and_copies(spark):
    """A hot key given as an expression, whose rows are all copies of each other, and more hot keys than a few."""
    facts = spark.range(6000).select((F.col("id") % 20).alias("k"))
    counts = spark.range(500).groupBy((F.col("id") % 250).alias("k")).agg(F.count("*").alias("n"))
    on = [((F.col("k") + 1).cast("long"), "k")]
    expected = rows(lookup(facts, DimRef(counts, on, {"n": "n"})))
    spread = lookup(facts, DimRef(counts, on, {"n": "n"}, hot_rows=30))
    assert spread.columns == ["k", "n"] and "_fact_salt" in plan(spread) and rows(spread) == expected
