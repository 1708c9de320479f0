from __future__ import annotations

import logging

import pytest
from pyspark.sql import SparkSession

from lakestar import session
from lakestar.sources.catalog import create_database, register_table
from lakestar.sources.tables import (
    ingest,
    is_complete,
    preview,
    read_available,
    read_csv,
    read_table,
    write_new,
    write_replace,
)
from tests.helpers import plan, rows


def test_csv_is_all_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,"x, ""y""",\n2.50,,2020-01-01\n')
    df = read_csv(spark, str(path))
    assert [f.dataType.typeName() for f in df.schema] == ["string"] * 3
    # A quote inside quotes is read the way Spark reads it by default.
    assert df.columns == ["a", "b", "c"] and df.count() == 2
    assert rows(df, "a", "c") == [("1", None), ("2.50", "2020-01-01")]
    assert rows(read_csv(spark, str(path), ["a", "b", "c"]), "a", "c") == rows(df, "a", "c")


def test_write_new_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_new(spark.range(3), path)
    assert not write_new(spark.range(9), path)
    assert rows(read_table(spark, path)) == [(0,), (1,), (2,)]


def test_write_new_repairs_a_failed_write(spark, tmp_path):
    path = tmp_path / "t"
    write_new(spark.range(9), str(path))
    (path / "_SUCCESS").unlink()
    assert not is_complete(spark, str(path))
    with pytest.raises(FileExistsError, match="repair=True"):
        write_new(spark.range(3), str(path))
    assert read_table(spark, str(path)).count() == 9
    assert write_new(spark.range(3), str(path), repair=True)
    assert read_table(spark, str(path)).count() == 3


def test_write_new_takes_what_a_failed_job_left_hidden(spark, tmp_path):
    path = tmp_path / "t"
    (path / "_temporary").mkdir(parents=True)
    assert write_new(spark.range(3), str(path))
    assert read_table(spark, str(path)).count() == 3


def test_write_replace_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_replace(spark.range(9), path)
    write_replace(spark.range(4).selectExpr("id", "id % 2 AS part"), path, partition_by=["part"])
    assert rows(read_table(spark, path)) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    assert "part#" in plan(read_table(spark, path).filter("part = 1")).split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    assert write_new(spark.range(3), path, fmt) and not write_new(spark.range(4), path, fmt)
    assert rows(read_table(spark, path, ["id"], fmt)) == [(0,), (1,), (2,)]


def test_scan_is_pruned_and_filtered_at_the_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(9).selectExpr("id", "id AS b", "id AS c").write.parquet(path)
    text = plan(read_table(spark, path, ["id", "b"]).filter("b > 3"))
    assert "GreaterThan(b,3)" in text and "ReadSchema: struct<id:bigint,b:bigint>" in text


def test_ingest_copies_every_table_once(spark, tmp_path):
    for name, text in {"hosp/a": "x,y\n1,2\n", "hosp/b": "z\nq\n", "icu/c": "w\n7\n"}.items():
        path = tmp_path / "raw" / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    tables = {"hosp": ["a", "b"], "icu": ["c"]}
    ingest(spark, tables, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    assert rows(read_table(spark, str(tmp_path / "bronze/hosp/a"))) == [("1", "2")]
    (tmp_path / "raw/icu/c.csv").write_text("w\n8\n")
    ingest(spark, tables, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    assert rows(read_table(spark, str(tmp_path / "bronze/icu/c"))) == [("7",)]


def test_unreadable_sources_are_named(spark, tmp_path, caplog):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    sources = {"good": ["id"], "absent": ["id"], "good/": ["no_such_column"]}
    with caplog.at_level(logging.WARNING):
        found = read_available(spark, sources, root=f"{tmp_path}/")
    assert list(found.used) == ["good"] and set(found.skipped) == {"absent", "good/"}
    assert len([r for r in caplog.records if r.name == "lakestar.sources.tables"]) == 2


def test_damaged_sources_are_no_absent_ones(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception):  # noqa: B017
        read_available(spark, {"broken": ["id"]}, root=f"{tmp_path}/")


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "it's here")
    spark.range(3).write.parquet(path)
    for _ in range(2):
        create_database(spark, "catalog_test")
        register_table(spark, "catalog_test", "numbers", path)
    assert spark.sql("SELECT sum(id) FROM catalog_test.numbers").first()[0] == 3
    spark.sql("DROP TABLE catalog_test.numbers")
    assert read_table(spark, path).count() == 3


def test_preview(spark):
    assert [r[0] for r in preview(spark.range(100).orderBy("id", ascending=False), ["id"]).collect()] == [0, 1, 2, 3, 4]


def test_scratch_follows_the_session(spark, monkeypatch, tmp_path):
    here = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_path(spark, "x")
    if here:
        assert path.startswith(here)
    assert path != session.scratch_path(spark, "x")

    class Unset:
        def get(self, *_):
            return None

    class Cluster:
        master, applicationId = "spark://somewhere:7077", "app"

        def getConf(self):
            return Unset()

    class Session:
        conf, sparkContext = Unset(), Cluster()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_drop_scratch(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    other = SparkSession.getActiveSession()
    assert read_table(other, path).count() == 3
    session.drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, path)
