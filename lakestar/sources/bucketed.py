"""Bucketed tables: what is joined and grouped by one key again and again lies dealt by it already.

A bucketed table is a catalog table; reading it by path loses its buckets. Tables with the same number of buckets join and group
on their key without a shuffle. A bucket is read by one task, so a key with a large part of all rows belongs in no such
table: ``write_bucketed`` counts first and refuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestar.operators.skew import HOT_ROWS, hot_keys


def write_bucketed(
    df: DataFrame, table: str, columns: Sequence[str], buckets: int, path: str, sort: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Create an external table at ``path``, bucketed by ``columns`` and sorted by them and by ``sort`` in each bucket, unless it is
    there, and return it. A key with more than ``hot_rows`` rows is an error; NULL keys are a key like others.

    Rows are dealt once, by the bucket's own hash, so each bucket is one file.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        hot = hot_keys(df, columns, hot_rows).first()
        if hot:
            raise ValueError(f"a key of {table} holds {hot['rows']} rows; leave the table unbucketed or raise hot_rows")
        dealt = df.repartition(buckets, *[F.col(f"`{c}`") for c in columns])
        writer = dealt.write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns, *sort)
        writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Take a table out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")

