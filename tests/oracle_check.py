"""Compare every query with its SQL: column names, types, rows and values, order ignored."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(table: pa.Table) -> pa.Table:
    """Columns by name; text as plain strings, so that only values and kinds of types count."""
    names = sorted(table.column_names)
    table = table.select(names)
    for i, field in enumerate(table.schema):
        if pa.types.is_large_string(field.type) or str(field.type) == "string_view":
            table = table.set_column(i, field.name, table.column(i).cast(pa.string()))
    return table


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None if the query and its SQL agree, else what differs."""
    found = _plain(entry.queries()[name](spark, sf_dir).toArrow())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if found.num_rows else "no rows"
    expected = _plain(con.sql(sql).to_arrow_table())
    if found.column_names != expected.column_names:
        return f"columns {found.column_names} / {expected.column_names}"
    types = [(f.name, str(f.type), str(e.type)) for f, e in zip(found.schema, expected.schema, strict=True) if f.type != e.type]
    if types:
        return f"types {types}"
    if found.num_rows != expected.num_rows:
        return f"rows {found.num_rows} / {expected.num_rows}"
    con.register("found_rows", found)
    con.register("expected_rows", expected)
    for sides in (("found_rows", "expected_rows"), ("expected_rows", "found_rows")):
        extra = con.execute("SELECT * FROM {} EXCEPT ALL SELECT * FROM {} LIMIT 3".format(*sides)).fetchall()
        if extra:
            return f"values only in {sides[0]}: {extra}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, bad = make_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
