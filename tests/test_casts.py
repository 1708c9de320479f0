from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakestar.functions.casts import lenient_date, lenient_double, lenient_int, prefix_int, recode, strict_date
from lakestar.operators.conform import conform, fill_null, not_null
from tests.helpers import rows


def cast_one(spark, cast, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", cast(F.col("v")).alias("out")).orderBy("i").collect()]


INTS = {
    "3.7": 3, "-3.7": -3, "5.": 5, " 12 ": 12, "007": 7, "+4": 4, "1e3": None, "abc": None, "": None, " ": None,
    "99999999999": None, "2147483647": 2147483647, "2147483648": None, "-2147483648": -2147483648,
    "00000000000000000012": 12, "2147483647.9": 2147483647, ".5": 0, "-.5": 0, ".": 0, "-": None, "1 2": None,
    "\t8\n": 8, "1.2.3": None, None: None,
}


def test_lenient_int(spark):
    assert cast_one(spark, lenient_int, INTS) == list(INTS.values())


def test_lenient_int_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert cast_one(spark, lenient_int, INTS) == list(INTS.values())
        # The cast of the tolerant mode is what the rule stands for.
        plain = cast_one(spark, lambda c: c.cast("int"), INTS)
        assert plain == list(INTS.values())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_lenient_double(spark):
    values = {
        "1.5": 1.5, " -2 ": -2.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "2d": 2.0, "Infinity": float("inf"),
        "abc": None, "": None, "1,5": None, None: None,
    }
    assert cast_one(spark, lenient_double, values) == list(values.values())
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert cast_one(spark, lambda c: c.cast("double"), values) == list(values.values())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_dates(spark):
    day = dt.date(2180, 5, 6)
    values = ["2180-05-06", "2180-05-06 22:23:00", "2180-05-06T22:23:00", "bad", "", "2180-02-30", None]
    assert cast_one(spark, lenient_date, values) == [day, day, day, None, None, None, None]
    assert cast_one(spark, strict_date, values) == [day, None, None, None, None, None, None]
    other = cast_one(spark, lambda c: strict_date(c, "dd.MM.yyyy"), ["06.05.2180", "2180-05-06", None])
    assert other == [day, None, None]


def test_prefix_int(spark):
    assert cast_one(spark, prefix_int, ["10000032-10", "10000032-11", "abc", "12345678", None]) == [
        10000032, 10000032, None, 12345678, None,
    ]


def test_recode(spark):
    assert cast_one(spark, lambda c: recode(c, {"M": "Male", "F": "Female"}), ["M", "F", "X", None]) == [
        "Male", "Female", None, None,
    ]


def test_conform_replaces_in_place_and_passes_the_rest_through(spark):
    df = spark.createDataFrame([("1.9", "x", "2020-01-02 03:04:05", "7")], "a string, b string, c string, d string")
    out = conform(df, {"c": "date", "a": "int", "d": "double"})
    assert out.columns == ["a", "b", "c", "d"]
    assert [f.dataType.typeName() for f in out.schema] == ["integer", "string", "date", "double"]
    assert rows(out) == [(1, "x", dt.date(2020, 1, 2), 7.0)]
    assert rows(conform(out, {"a": "int", "c": "date"})) == rows(out)
    with pytest.raises(ValueError, match="nothing"):
        conform(df, {"nothing": "int"})


def test_null_rows_and_defaults(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (2, "b")], "k int, v string")
    assert rows(not_null(df)) == [(2, "b")]
    assert rows(not_null(df, ["k"])) == [(1, None), (2, "b")]
    assert rows(fill_null(df, {"v": "unknown"})) == [(None, "a"), (1, "unknown"), (2, "b")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. e\t", max_size=14), min_size=30, max_size=60))
def test_lenient_int_equals_the_tolerant_cast(spark, values):
    ours = cast_one(spark, lenient_int, values)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert ours == cast_one(spark, lambda c: c.cast("int"), values)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
