from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from lakestar.operators import groups
from lakestar.operators.groups import dedupe, first_by, first_value, next_value
from lakestar.operators.unions import explode_dates, observed_dates, union_all, union_distinct
from tests.helpers import plan, rows


def test_first_by_one_row(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-02", "b"), (1, "2020-01-01", "c"), (1, "2020-01-01", "a"), (2, None, "z"), (2, "2020-01-01", "y"), (None, "2020-01-01", "n")],
        "k int, t string, v string",
    )
    assert rows(first_by(df, ["k"], ["t"])) == [
        (None, "2020-01-01", "n"), (1, "2020-01-01", "a"), (2, None, "z"),
    ]


def test_first_by_with_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 3, "c"), (1, 3, "a"), (1, 3, "a"), (2, None, "z"), (2, 7, "y"), (3, None, "x"), (None, 1, "n")],
        "k int, t int, v string",
    )
    assert rows(first_by(df, ["k"], ["t"], ties="all")) == [(1, 3, "a"), (1, 3, "a"), (1, 3, "c"), (2, 7, "y")]


def test_first_by_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    text = plan(first_by(df, ["k"], ["id"]))
    before, after = text.split("Exchange", 1)
    assert "Partial" in after and "Final" in before


def test_dedupe_takes_the_least_row(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (1, "a", 2), (2, None, 1), (2, "a", 0)], "k int, v string, w int")
    assert rows(dedupe(df, ["k"])) == [(1, "a", 2), (2, None, 1)]
    assert rows(dedupe(df, ["k"], ["w"])) == [(1, "b", 1), (2, "a", 0)]


def test_first_value(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "z"), (1, 1, "y"), (2, 1, None), (2, 2, "q")], "k int, o int, v string")
    assert rows(first_value(df, ["k"], ["v"], ["o"])) == [(1, "y"), (2, None)]


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_next_value_equals_a_window(spark, hot_rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # A third of the rows share one key, another third has none; order values repeat.
        key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50)
        df = spark.range(3000).select(key.alias("k"), (F.col("id") * 37 % 100).alias("t"), F.col("id"))
        out = next_value(df, ["k"], ["t", "id"], "t", "nxt", hot_rows=hot_rows)
        expected = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
        assert out.columns == expected.columns
        assert rows(out) == rows(expected)
        assert ("Union" in plan(out)) == (hot_rows == 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_next_value_with_null_values_and_empty_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([("a", i, None if i % 2 else i) for i in range(40)], "k string, t int, v int")
        expected = df.withColumn("nxt", F.lead("v").over(Window.partitionBy("k").orderBy("t")))
        assert rows(next_value(df, ["k"], ["t"], "v", "nxt", hot_rows=1)) == rows(expected)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    assert rows(union_all([a, b])) == [(1, "x"), (1, "x"), (1, "x"), (2, "y")]
    assert rows(union_distinct([a, b])) == [(1, "x"), (2, "y")]


def test_observed_dates_scans_each_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("2020-01-01", "2020-01-03"), (None, "2020-01-01"), ("bad", None)], "a string, b string").write.parquet(path)
    df = spark.read.parquet(path)
    out = observed_dates([(df, ["a", "b"])])
    assert plan(out).count("FileScan") == 1
    assert [str(d) for (d,) in rows(out)] == ["2020-01-01", "2020-01-03"]
    with pytest.raises(ValueError, match="no source"):
        observed_dates([])


def test_explode_dates(spark):
    df = spark.createDataFrame([(1, "2020-02-28", "2020-03-01"), (2, "2020-01-01", "2020-01-01")], "k int, a string, b string")
    assert [(k, str(d)) for k, d in rows(explode_dates(df, "a", "b"), "k", "date")] == [
        (1, "2020-02-28"), (1, "2020-02-29"), (1, "2020-03-01"), (2, "2020-01-01"),
    ]


def test_next_value_with_more_hot_groups_than_a_plan_names(spark, monkeypatch):
    monkeypatch.setattr(groups, "MAX_LITERALS", 5)
    df = spark.range(2000).select((F.col("id") % 40).alias("k"), F.col("id").alias("t"))
    out = next_value(df, ["k"], ["t"], "t", "nxt", hot_rows=20)
    # No group is left in a window of its own.
    assert "Union" not in plan(out) and "_part" in plan(out)
    assert rows(out) == rows(df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t"))))
