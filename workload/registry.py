"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestar.session import apply_sql_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor, by attribute."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        # Kept as an attribute, so that each table's schema is read once per query.
        table = self.spark.read.parquet(self.path(name))
        setattr(self, name, table)
        return table


def register_typed(name: str, build: Callable[[Tables], DataFrame], sql: str) -> None:
    """Register a function that has no name of its own."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(apply_sql_conf(spark), sf_dir))

    QUERIES[name], ORACLES[name] = run, sql


def query(sql: str | None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under its name, with the SQL to compare it with, if there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(apply_sql_conf(spark), sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register
