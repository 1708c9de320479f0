"""Queries on sources, sinks, columns, filters, joins, aggregates, keys and dates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakestar.functions.casts import prefix_int, recode, strict_date
from lakestar.functions.dates import date_key, hours_between, is_weekend, weekday_name
from lakestar.operators.conform import conform, fill_null, not_null
from lakestar.operators.groups import dedupe, first_by, first_value, next_value
from lakestar.operators.joins import BROADCAST_ROWS, DimRef, broadcast_if_small, lookup, star_join
from lakestar.operators.keys import dense_key, stable_key
from lakestar.operators.unions import explode_dates, observed_dates, union_all, union_distinct
from lakestar.session import scratch_path
from lakestar.sources.catalog import register_all
from lakestar.sources.tables import ingest, preview, read_available, read_table, write_new, write_replace
from workload.registry import Tables, query

CENTS = "decimal(18,2)"


def _bigint(c):
    return c.try_cast("bigint")


# Sources, sinks, catalog


@query("""
SELECT event_id, CAST(ts AS DATE) AS ts, user_id, event_type, value, props FROM events
""")
def raw_csv_roundtrip(t: Tables) -> DataFrame:
    """Events as a CSV file, ingested to a columnar table of strings and typed from there."""
    root = scratch_path(t.spark, "csv")
    t.events.write.option("header", True).csv(f"{root}/raw/hosp/events.csv")
    ingest(t.spark, {"hosp": ["events"]}, f"{root}/raw", f"{root}/bronze")
    rules = {"event_id": _bigint, "ts": "date", "user_id": _bigint, "value": "double"}
    return conform(read_table(t.spark, f"{root}/bronze/hosp/events"), rules)


@query("SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderpriority AS admission_type FROM orders")
def table_scan_project(t: Tables) -> DataFrame:
    orders = read_table(t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])
    renamed = orders.select(F.col("o_custkey").alias("subject_id"), "o_orderkey", "o_orderpriority", "o_totalprice")
    return renamed.withColumnsRenamed({"o_orderkey": "hadm_id", "o_orderpriority": "admission_type"}).drop("o_totalprice")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_ignore(t: Tables) -> DataFrame:
    """The second write finds the table there and leaves it alone."""
    path = scratch_path(t.spark, "sink")
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    write_new(customers, path)
    write_new(customers.withColumn("c_name", F.lit("second")), path)
    return read_table(t.spark, path)


@query("SELECT c_custkey, upper(c_mktsegment) || '!' AS c_mktsegment FROM customer")
def sink_overwrite(t: Tables) -> DataFrame:
    """The second write replaces the first; the table is partitioned by segment."""
    path = scratch_path(t.spark, "sink")
    customers = t.customer.select("c_custkey", "c_mktsegment")
    write_replace(customers, path, partition_by=["c_mktsegment"])
    write_replace(customers.withColumn("c_mktsegment", F.concat(F.upper("c_mktsegment"), F.lit("!"))), path, partition_by=["c_mktsegment"])
    return read_table(t.spark, path).select("c_custkey", "c_mktsegment")


@query("""
SELECT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate IS NOT NULL
UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_shipdate IS NOT NULL
UNION SELECT CAST(ts AS DATE) FROM events WHERE ts IS NOT NULL
""")
def tolerant_union_dates(t: Tables) -> DataFrame:
    """Dates of three tables; a missing path and a missing column are skipped."""
    sources = {
        "orders.parquet": ["o_orderdate"],
        "absent.parquet": ["anything"],
        "lineitem.parquet": ["l_shipdate"],
        "customer.parquet": ["no_such_column"],
        "events.parquet": ["ts"],
    }
    found = read_available(t.spark, sources, root=f"{t.root}/")
    return observed_dates((df, df.columns) for df in found.used.values())


@query("""
SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def catalog_register(t: Tables) -> DataFrame:
    """SQL over two tables registered in the catalog."""
    database = f"registered_{uuid.uuid4().hex}"
    register_all(t.spark, {database: {name: t.path(name) for name in ("orders", "customer")}})
    return t.spark.sql(f"""
        SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM {database}.orders JOIN {database}.customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def preview_limit(t: Tables) -> DataFrame:
    return preview(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


# Columns


@query("""
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice, l_discount,
       CAST(NULL AS INTEGER) AS l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate,
       CAST(l_tax AS VARCHAR) AS l_tax, l_quantity >= 25 AS is_large
FROM lineitem
""")
def silver_conform(t: Tables) -> DataFrame:
    """Lines as text, typed by rules: decimals cut to ints, letters to NULL, datetime text to dates."""
    names = [
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
        "l_linestatus", "l_shipdate", "l_tax",
    ]
    raw = t.lineitem.select(*[F.col(name).cast("string").alias(name) for name in names])
    rules = {
        "l_orderkey": "int", "l_partkey": "int", "l_linenumber": "int", "l_quantity": "int", "l_extendedprice": "int",
        "l_discount": "double", "l_returnflag": "int", "l_shipdate": "date", "l_tax": "string",
    }
    return conform(raw, rules).withColumn("is_large", F.col("l_quantity") >= 25)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS strict_day,
       CAST(o_orderdate AS DATE) AS any_day
FROM orders
""")
def strict_date_pattern(t: Tables) -> DataFrame:
    """Half-typed text: with a time of day behind it a date does not follow the pattern."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit(" 22:23:00"))).otherwise(day)
    return t.orders.select("o_orderkey", strict_date(text).alias("strict_day"), text.try_cast("date").alias("any_day"))


@query("""
SELECT CAST(o_custkey AS INTEGER) AS poe_id, count(*) AS n_ids, min(o_orderkey) AS least FROM orders GROUP BY o_custkey
""")
def prefix_key(t: Tables) -> DataFrame:
    """Composite ids cut to their first eight characters: the ids of one customer become equal."""
    full = F.concat_ws("-", F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.col("o_orderkey").cast("string"))
    ids = t.orders.select(prefix_int(full).alias("poe_id"), "o_orderkey")
    return ids.groupBy("poe_id").agg(F.count("*").alias("n_ids"), F.min("o_orderkey").alias("least"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS status FROM orders
""")
def recode_status(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", recode(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}).alias("status"))


# Filters


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity - l_linenumber AS gap FROM lineitem
WHERE l_discount = l_tax AND l_linestatus = 'O' AND l_returnflag IN ('A', 'R') AND abs(l_quantity - l_linenumber) <= 20
""")
def filters_mixed(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_returnflag"
    )
    gap = F.col("l_quantity") - F.col("l_linenumber")
    kept = lines.filter(
        (F.col("l_discount") == F.col("l_tax"))
        & (F.col("l_linestatus") == "O")
        & F.col("l_returnflag").isin("A", "R")
        & (F.abs(gap) <= 20)
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", gap.alias("gap"))


@query("""
WITH j AS (
  SELECT o_orderkey, o_custkey, l_linenumber, l_returnflag, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
)
SELECT status, coalesce(l_returnflag, 'none') AS l_returnflag, count(*) AS n, count(l_linenumber) AS n_lines
FROM j WHERE status IS NOT NULL GROUP BY 1, 2
""")
def dropna_fill(t: Tables) -> DataFrame:
    """Orders with their lines, if any: rows of unknown status go, a missing flag gets a default."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), status.alias("status"))
    joined = orders.join(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey", "left")
    kept = fill_null(not_null(joined, ["status"]), {"l_returnflag": "none"})
    return kept.groupBy("status", "l_returnflag").agg(F.count("*").alias("n"), F.count("l_linenumber").alias("n_lines"))


@query("""
SELECT o_orderkey, status FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders
) WHERE status IS NOT NULL
""")
def dropna_any(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return not_null(t.orders.select("o_orderkey", status.alias("status")))


# Joins


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey").join(customers, "o_custkey", "inner").drop("o_custkey")


@query("""
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_left(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return t.orders.select("o_orderkey").join(lines, "o_orderkey", "left")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def join_left_expr(t: Tables) -> DataFrame:
    ref = DimRef(t.part, [("l_partkey", "p_partkey")], {"p_name": "p_name", "p_brand": "p_brand"})
    return lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ref)


@query("""
WITH pairs AS (SELECT p_brand, p_type, count(*) AS n_parts FROM part GROUP BY 1, 2)
SELECT p_partkey, p_brand, p_type, n_parts FROM part LEFT JOIN pairs USING (p_brand, p_type)
""")
def join_composite(t: Tables) -> DataFrame:
    pairs = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n_parts"))
    return t.part.select("p_partkey", "p_brand", "p_type").join(pairs, ["p_brand", "p_type"], "left")


@query("""
WITH used AS (
  SELECT l_orderkey, l_linenumber, l_partkey, p_name, CASE WHEN p_size >= 10 THEN p_brand END AS brand, p_type
  FROM lineitem JOIN part ON l_partkey = p_partkey
), drugs AS (
  SELECT p_name AS d_name, CASE WHEN p_size >= 10 THEN p_brand END AS d_brand, p_type AS d_type, min(p_partkey) AS drug
  FROM part GROUP BY 1, 2, 3
)
SELECT u.l_orderkey, u.l_linenumber, u.l_partkey, a.drug AS drug, b.drug AS null_safe_drug
FROM used u
LEFT JOIN drugs a ON p_name = a.d_name AND brand = a.d_brand AND p_type = a.d_type
LEFT JOIN drugs b ON p_name = b.d_name AND brand IS NOT DISTINCT FROM b.d_brand AND p_type = b.d_type
""")
def join_three_key_broadcast(t: Tables) -> DataFrame:
    """Three-column lookup with NULL in one of them, once as a plain and once as a NULL-safe match."""
    brand = F.when(F.col("p_size") >= 10, F.col("p_brand")).alias("brand")
    drugs = t.part.select("p_name", brand, "p_type", "p_partkey").groupBy("p_name", "brand", "p_type")
    drugs = drugs.agg(F.min("p_partkey").alias("drug"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", brand, "p_type")
    used = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(parts, "l_partkey")
    on = [("p_name", "p_name"), ("brand", "brand"), ("p_type", "p_type")]
    refs = [
        DimRef(drugs, on, {"drug": "drug"}, broadcast_rows=BROADCAST_ROWS),
        DimRef(drugs, on, {"null_safe_drug": "drug"}, null_safe=True, broadcast_rows=BROADCAST_ROWS),
    ]
    return star_join(used, refs).select("l_orderkey", "l_linenumber", "l_partkey", "drug", "null_safe_drug")


@query("""
WITH d AS (
  SELECT date, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS sk
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
)
SELECT l_orderkey, l_linenumber, l_partkey, a.sk AS order_date_sk, b.sk AS ship_date_sk
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN d a ON CAST(o_orderdate AS DATE) = a.date LEFT JOIN d b ON CAST(l_shipdate AS DATE) = b.date
""")
def role_playing_dates(t: Tables) -> DataFrame:
    """One calendar of order dates looked up for the order and for the ship date."""
    calendar = observed_dates([(t.orders, ["o_orderdate"])]).withColumn("date_sk", date_key(F.col("date")))
    calendar = broadcast_if_small(calendar)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").join(orders, "l_orderkey", "left")
    rows = star_join(
        lines,
        [
            DimRef(calendar, [(F.col("o_orderdate").cast("date"), "date")], {"order_date_sk": "date_sk"}),
            DimRef(calendar, [(F.col("l_shipdate").cast("date"), "date")], {"ship_date_sk": "date_sk"}),
        ],
    )
    return rows.drop("l_shipdate", "o_orderdate")


@query("""
SELECT l_orderkey, l_returnflag, CAST(l_shipdate AS DATE) AS first_day FROM lineitem
JOIN (SELECT l_orderkey, min(l_shipdate) AS m FROM lineitem GROUP BY 1) USING (l_orderkey) WHERE l_shipdate = m
""")
def argmin_with_ties(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("first_day"))
    return first_by(lines, ["l_orderkey"], ["first_day"], ties="all")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority, p_name, c_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_suppkey = p_partkey JOIN customer ON l_partkey = c_custkey
""")
def strict_fact(t: Tables) -> DataFrame:
    """Lines that resolve in all three tables; a part number beyond the customers finds none."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    refs = [
        DimRef(t.orders, [("l_orderkey", "o_orderkey")], {"o_orderpriority": "o_orderpriority"}),
        DimRef(t.part, [("l_suppkey", "p_partkey")], {"p_name": "p_name"}),
        DimRef(t.customer, [("l_partkey", "c_custkey")], {"c_name": "c_name"}),
    ]
    return star_join(lines, refs, strict=True).drop("l_suppkey")


@query("""
WITH codes AS (SELECT DISTINCT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
texts AS (SELECT p_brand, p_type, min(p_name) AS title FROM part GROUP BY 1, 2)
SELECT p_brand, title FROM codes LEFT JOIN texts USING (p_brand)
""")
def code_lookup_fanout(t: Tables) -> DataFrame:
    """Codes in use with every description their code has, whatever its version."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    codes = t.lineitem.select("l_partkey").join(parts, "l_partkey").select("p_brand").distinct()
    texts = t.part.groupBy("p_brand", "p_type").agg(F.min("p_name").alias("title")).drop("p_type")
    return codes.join(texts, "p_brand", "left")


# Aggregates


@query("""
SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_day, count(*) AS n FROM lineitem GROUP BY l_orderkey
""")
def group_min(t: Tables) -> DataFrame:
    days = t.lineitem.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"))
    return days.groupBy("l_orderkey").agg(F.min("day").alias("first_day"), F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem
) WHERE rn = 1
""")
def group_first(t: Tables) -> DataFrame:
    return first_value(t.lineitem, ["l_orderkey"], ["l_partkey"], ["l_linenumber"])


@query("""
SELECT user_id,
  CAST(sum(CASE WHEN event_type IN ('click', 'view') THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
    / count(CASE WHEN event_type IN ('click', 'view') THEN value END) AS avg_look,
  CAST(sum(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
    / count(CASE WHEN event_type IN ('purchase', 'signup') THEN value END) AS avg_act
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY user_id
""")
def conditional_avg(t: Tables) -> DataFrame:
    """Two means over two sets of items, in one scan that reads only those items."""
    look, act = ["click", "view"], ["purchase", "signup"]
    kept = t.events.select("user_id", "event_type", "value").filter(F.col("event_type").isin(look + act))

    def mean(items):
        value = F.when(F.col("event_type").isin(items), F.col("value").cast(CENTS))
        return F.try_divide(F.sum(value).cast("double"), F.count(value))

    return kept.groupBy("user_id").agg(mean(look).alias("avg_look"), mean(act).alias("avg_act"))


@query("""
WITH e AS (SELECT user_id AS k, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1),
l AS (SELECT l_orderkey AS k, count(*) AS n_lines FROM lineitem GROUP BY 1),
c AS (SELECT o_custkey AS k, count(o_orderkey) AS n_orders FROM orders GROUP BY 1)
SELECT c_custkey, total, n_lines, n_orders FROM customer
LEFT JOIN e ON c_custkey = e.k LEFT JOIN l ON c_custkey = l.k LEFT JOIN c ON c_custkey = c.k
""")
def sum_count_per_entity(t: Tables) -> DataFrame:
    """Each source reduced to one row per key before the join."""
    key = "c_custkey"
    totals = t.events.groupBy(F.col("user_id").alias(key)).agg(F.sum(F.col("value").cast(CENTS)).cast("double").alias("total"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias(key)).agg(F.count("*").alias("n_lines"))
    orders = t.orders.groupBy(F.col("o_custkey").alias(key)).agg(F.count("o_orderkey").alias("n_orders"))
    return t.customer.select(key).join(totals, key, "left").join(lines, key, "left").join(orders, key, "left")


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem
) WHERE rn = 1
""")
def dedupe_key(t: Tables) -> DataFrame:
    return dedupe(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])


# Keys and windows


@query("""
SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS sk, o_orderkey, o_custkey FROM orders
""")
def dense_key_orders(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return dense_key(orders, ["o_custkey", "o_orderdate"], "sk").select("sk", "o_orderkey", "o_custkey")


@query("""
SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus, l_linenumber) AS sk, l_returnflag, l_linestatus, l_linenumber
FROM lineitem
""")
def dense_key_copies(t: Tables) -> DataFrame:
    """Rows with very many copies: they are merged, sorted and numbered apart."""
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber")
    return dense_key(rows, ["l_returnflag"], "sk", copies=True)


@query("""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS rn FROM orders
) WHERE rn = 1
""")
def first_row_per_group(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return first_by(orders, ["o_custkey"], ["day"])


_LEAD = """
SELECT o_custkey, o_orderkey, CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE)
  AS next_day FROM orders
"""


def _lead(t: Tables, **options) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return next_value(orders, ["o_custkey"], ["day", "o_orderkey"], "day", "next_day", **options).drop("day")


@query(_LEAD)
def lead_next(t: Tables) -> DataFrame:
    return _lead(t)


@query("""
SELECT l_linestatus, l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST(lead(l_orderkey) OVER (
  PARTITION BY l_linestatus ORDER BY l_orderkey, l_partkey, l_linenumber, l_suppkey) AS BIGINT) AS next_order
FROM lineitem
""")
def lead_next_hot(t: Tables) -> DataFrame:
    """Groups of half the table each: they are sorted over many tasks."""
    lines = t.lineitem.select("l_linestatus", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    order = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
    return next_value(lines, ["l_linestatus"], order, "l_orderkey", "next_order", hot_rows=1)


@query("SELECT count(*) AS n_rows, count(DISTINCT (p_name, p_brand, p_type)) AS n_keys, 0 AS n_collisions FROM part")
def stable_key_unique(t: Tables) -> DataFrame:
    """Keys hashed from three columns: as many as there are distinct values."""
    keyed = t.part.select("p_name", "p_brand", "p_type", stable_key("p_name", "p_brand", "p_type").alias("sk"))
    per_key = keyed.groupBy("p_name", "p_brand", "p_type", "sk").agg(F.count("*").alias("n"))
    counts = per_key.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.countDistinct("sk").alias("n_sk"))
    return counts.select("n_rows", "n_keys", (F.col("n_keys") - F.col("n_sk")).cast("int").alias("n_collisions"))


# Unions


@query("""
SELECT o_custkey AS k, 'order' AS source FROM orders
UNION ALL SELECT l_partkey, 'line' FROM lineitem UNION ALL SELECT user_id, 'event' FROM events
""")
def union_all_sources(t: Tables) -> DataFrame:
    frames = [
        t.orders.select(F.col("o_custkey").alias("k"), F.lit("order").alias("source")),
        t.lineitem.select(F.lit("line").alias("source"), F.col("l_partkey").alias("k")),
        t.events.select(F.col("user_id").alias("k"), F.lit("event").alias("source")),
    ]
    return union_all(frames)


@query("SELECT o_custkey AS k FROM orders UNION SELECT l_partkey FROM lineitem UNION SELECT user_id FROM events")
def union_distinct_keys(t: Tables) -> DataFrame:
    frames = [(t.orders, "o_custkey"), (t.lineitem, "l_partkey"), (t.events, "user_id")]
    return union_distinct(df.select(F.col(column).alias("k")) for df, column in frames)


# Dates


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk FROM orders
""")
def smart_date_key(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_sk"))


@query("""
SELECT event_id, CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
  CAST(weekofyear(ts) AS INTEGER) AS week, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, strftime(ts, '%A') AS weekday, strftime(ts, '%a') AS weekday_short,
  dayofweek(ts) IN (0, 6) AS is_weekend
FROM events
""")
def calendar_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.dayofmonth(ts).alias("day"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        F.weekofyear(ts).alias("week"),
        F.quarter(ts).alias("quarter"),
        F.dayofweek(ts).alias("day_of_week"),
        weekday_name(ts).alias("weekday"),
        weekday_name(ts, short=True).alias("weekday_short"),
        is_weekend(ts).alias("is_weekend"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days,
  (epoch(l_shipdate) - epoch(o_orderdate)) / 3600 AS hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def durations(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").join(orders, "l_orderkey")
    days = F.datediff("l_shipdate", "o_orderdate").alias("days")
    hours = hours_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("hours")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", days, hours)


@query("""
SELECT o_orderkey, CAST(unnest(generate_series(o_orderdate, o_orderdate + to_days(CAST(o_orderkey % 15 - 3 AS INTEGER)),
  INTERVAL 1 DAY)) AS DATE) AS day FROM orders WHERE o_orderkey % 7 <> 0
""")
def date_range(t: Tables) -> DataFrame:
    """One row per day of each order's time in house; some end before they start, some have no end."""
    end = F.date_add("o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 15).cast("int") - 3))
    stays = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("start"), end.alias("end"))
    return explode_dates(stays, "start", "end", "day").drop("start", "end")
