"""Databases and external tables in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from lakestar.sources.tables import DEFAULT_FORMAT


def _quoted(*parts: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts)


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")


def register_table(spark: SparkSession, database: str, table: str, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """External table over an existing path: dropping it later leaves the files in place."""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(database, table)} USING {fmt} LOCATION '{location}'")


def register_all(spark: SparkSession, databases: Mapping[str, Mapping[str, str]], fmt: str = DEFAULT_FORMAT) -> None:
    """Register ``{database: {table: path}}``."""
    for database, tables in databases.items():
        create_database(spark, database)
        for table, path in tables.items():
            register_table(spark, database, table, path, fmt)
