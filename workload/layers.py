"""Queries on what surrounds the tables: clustered and replaced files, rejected lines, losses, lasting keys, saved models.

They write to the scratch folder and read back what they wrote.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, functions as F

from lakestar.operators.keys import missing_keys, staged
from lakestar.operators.lasting import lasting_keys, with_lasting_key
from lakestar.plans import calendars, facts, scoring
from lakestar.plans.silver import SILVER_TABLES
from lakestar.session import scratch_path, side_session, together
from lakestar.sources.bucketed import drop_bucketed, write_bucketed
from lakestar.sources.tables import ingest_checked, read_checked, read_table, split_rejects, write_clustered, write_replace
from workload import standins as s
from workload.registry import QUERIES, Tables, query, register_typed
from workload.standins import with_tables

# Clustered tables


@query("""
SELECT user_id AS stay_id,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click') AS DOUBLE) / nullif(count(value) FILTER (event_type = 'click'), 0) AS clicks,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'error') AS DOUBLE) / nullif(count(value) FILTER (event_type = 'error'), 0) AS errors
FROM events WHERE event_type IN ('click', 'error') GROUP BY 1
""")
def clustered_signs(t: Tables) -> DataFrame:
    """Two items per stay from events written by item and stay."""
    path = scratch_path(t.spark, "clustered")
    write_clustered(s.chartevents(t), path, ["itemid", "stay_id"])
    signs = facts.vital_signs(read_table(t.spark, path), ["click"], ["error"])
    return signs.select("stay_id", F.col("avg_heart_rate").alias("clicks"), F.col("avg_spo2").alias("errors"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_suppkey <= 3")
def clustered_scan(t: Tables) -> DataFrame:
    """Lines of a few suppliers from a table written by supplier and order."""
    path = scratch_path(t.spark, "clustered")
    write_clustered(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), path, ["l_suppkey", "l_orderkey"])
    return read_table(t.spark, path).where("l_suppkey <= 3")


# Replaced tables


@query("""
SELECT c_custkey, CAST(c_nationkey AS BIGINT) + 1 AS c_nationkey FROM customer WHERE c_custkey % 2 = 0
""")
def staged_replace(t: Tables) -> DataFrame:
    """A table replaced by a part of itself."""
    path = scratch_path(t.spark, "replaced")
    write_replace(t.customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey")), path)
    write_replace(read_table(t.spark, path).where("c_custkey % 2 = 0").withColumn("c_nationkey", F.col("c_nationkey") + 1), path)
    return read_table(t.spark, path)


# Rejected lines

# Every so many orders a line is cut short, has a field more, or opens a quote that it never closes.
_DAMAGE = "CASE o_orderkey % 11 WHEN 3 THEN 'number of fields' WHEN 5 THEN 'number of fields' WHEN 7 THEN 'unclosed quote' END"


def _damaged_lines(t: Tables) -> str:
    """The orders as text with a header per file."""
    key, quoted = F.col("o_orderkey"), F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', said ""x"""'))
    fields = F.concat_ws(",", key.cast("string"), F.col("o_custkey").cast("string"), quoted, F.col("o_orderstatus"))
    line = (
        F.when(key % 11 == 3, F.concat_ws(",", key.cast("string"), F.col("o_custkey").cast("string")))
        .when(key % 11 == 5, F.concat(fields, F.lit(",more")))
        .when(key % 11 == 7, F.concat_ws(",", key.cast("string"), F.col("o_custkey").cast("string"), F.concat(F.lit('"'), F.col("o_orderpriority")), F.lit("x")))
        .otherwise(fields)
    )
    path = scratch_path(t.spark, "lines")
    header = t.spark.createDataFrame([("o_orderkey,o_custkey,o_orderpriority,o_orderstatus",)], "value string")
    header.unionByName(t.orders.select(line.alias("value"))).coalesce(1).write.text(path)
    return path


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus
FROM orders WHERE ({_DAMAGE}) IS NULL
""")
def checked_lines(t: Tables) -> DataFrame:
    """The good lines of a damaged file, written as a table."""
    target = scratch_path(t.spark, "checked")
    ingest_checked(t.spark, _damaged_lines(t), target, scratch_path(t.spark, "rejects"))
    return read_table(t.spark, target, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(f"SELECT o_orderkey, {_DAMAGE} AS reason FROM orders WHERE ({_DAMAGE}) IS NOT NULL")
def rejected_lines(t: Tables) -> DataFrame:
    """The other lines, each with its reason."""
    bad = split_rejects(read_checked(t.spark, _damaged_lines(t)))[1]
    return bad.select(F.substring_index("line", ",", 1).cast("long").alias("o_orderkey"), "reason")


# Typed layer: every table from text of good and bad values. The text is the same in Spark and in SQL; what becomes of it is not
# taken from the rules in SQL, but from its own casts.

_INT_TEXT = "CASE (k + {i}) % 8 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL WHEN 2 THEN k || '.9' WHEN 3 THEN ' ' || k || ' ' WHEN 4 THEN '-' || k WHEN 5 THEN '99999999999' WHEN 6 THEN '+' || k ELSE '' || k END"
_TEXT = {
    "int": _INT_TEXT,
    "double": "CASE (k + {i}) % 7 WHEN 0 THEN '--' WHEN 1 THEN NULL WHEN 2 THEN k || '.25' WHEN 3 THEN '.5' WHEN 4 THEN k || 'e-2' WHEN 5 THEN '1.2.3' ELSE '' || k END",
    "date": "CASE (k + {i}) % 6 WHEN 0 THEN '2150-02-30' WHEN 1 THEN NULL WHEN 2 THEN d || ' 10:11:12' WHEN 3 THEN 'soon' ELSE '' || d END",
    "string": "CASE (k + {i}) % 5 WHEN 0 THEN NULL ELSE 'v' || k END",
    "gender": "CASE (k + {i}) % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' END",
    "strict_date": "CASE (k + {i}) % 5 WHEN 0 THEN '2150-02-30' WHEN 1 THEN NULL WHEN 2 THEN d || ' 10:11:12' ELSE '' || d END",
}
_TYPED = {
    "int": "CAST(CASE WHEN abs(trunc(TRY_CAST(trim({c}) AS DOUBLE))) < 2147483648 THEN trunc(TRY_CAST(trim({c}) AS DOUBLE)) END AS INTEGER)",
    "double": "TRY_CAST({c} AS DOUBLE)",
    "date": "TRY_CAST(left({c}, 10) AS DATE)",
    "string": "{c}",
    "gender": "CASE {c} WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' END",
    "strict_date": "CASE WHEN length({c}) = 10 THEN TRY_CAST({c} AS DATE) END",
}


def _raw_sql(table: str) -> str:
    """Text columns of a raw table, in SQL that Spark and DuckDB read alike; ``note`` has no rule."""
    rules = SILVER_TABLES[table].rule_names()
    texts = [_TEXT[kind].format(i=i) + f" AS {name}" for i, (name, kind) in enumerate(rules)]
    return f"SELECT {', '.join([*texts, "k || '-' || k AS note"])} FROM base"


_BASE_SQL = "base AS (SELECT o_orderkey AS k, strftime(DATE '2100-01-01' + CAST(o_orderkey % 999 AS INTEGER), '%Y-%m-%d') AS d FROM orders)"


def _raw(t: Tables, table: str) -> DataFrame:
    base = t.orders.selectExpr("o_orderkey AS k", "CAST(date_add(DATE'2100-01-01', CAST(o_orderkey % 999 AS INT)) AS STRING) AS d")
    return t.spark.sql(_raw_sql(table).replace("FROM base", "FROM {base}"), base=base)


def _typed_sql(table: str) -> str:
    typed = [_TYPED[kind].format(c=name) + f" AS {name}" for name, kind in SILVER_TABLES[table].rule_names()]
    return f"WITH {_BASE_SQL}, raw AS ({_raw_sql(table)}) SELECT {', '.join([*typed, 'note'])} FROM raw"


def _typed(table: str, t: Tables) -> DataFrame:
    return SILVER_TABLES[table].build(_raw(t, table))


for _table in SILVER_TABLES:
    if f"silver_{_table}" not in QUERIES:
        register_typed(f"silver_{_table}", partial(_typed, _table), _typed_sql(_table))


def _losses_sql() -> str:
    parts = []
    for table, spec in SILVER_TABLES.items():
        for name, kind in spec.rule_names():
            lost = f"count(*) FILTER ({name} IS NOT NULL AND ({_TYPED[kind].format(c=name)}) IS NULL)"
            parts.append(f"SELECT '{table}' AS \"table\", '{name}' AS \"column\", count(*) AS \"rows\", {lost} AS lost FROM raw_{table}")
    raws = ", ".join(f"raw_{table} AS ({_raw_sql(table)})" for table in SILVER_TABLES)
    return f"WITH {_BASE_SQL}, {raws} {' UNION ALL '.join(parts)}"


@query(_losses_sql())
def silver_losses(t: Tables) -> DataFrame:
    """How many values each rule of each of the 31 tables loses, counted while the tables are written."""
    # Observed jobs get a session of their own.
    side = Tables(side_session(t.spark), t.root)

    def written(table: str) -> list[tuple]:
        spec = SILVER_TABLES[table]
        typed, lost = spec.build_counted(_raw(side, table))
        # Every row is typed and counted; nothing reads the typed rows afterwards, so they are not stored.
        typed.write.format("noop").mode("overwrite").save()
        found = lost.get
        return [(table, name, found["rows"], found[str(i)]) for i, (name, _) in enumerate(spec.rule_names())]

    rows = together(*[partial(written, table) for table in SILVER_TABLES])
    return t.spark.createDataFrame([r for part in rows for r in part], "table string, column string, rows long, lost long")


# Lasting keys


@query("""
WITH first AS (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 2 = 0 AND p_brand < 'Brand#3'),
  later AS (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM first))
SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS brand_sk FROM first
UNION ALL SELECT p_brand, row_number() OVER (ORDER BY p_brand) + (SELECT count(*) FROM first) FROM later
""")
def lasting_dense_keys(t: Tables) -> DataFrame:
    """Brands numbered in two calls: those of the first call keep their numbers, the others come after them."""
    path = scratch_path(t.spark, "keys")
    lasting_keys(t.part.where("p_partkey % 2 = 0 AND p_brand < 'Brand#3'"), path, ["p_brand"], "brand_sk")
    return lasting_keys(t.part, path, ["p_brand"], "brand_sk")


@query("SELECT c_custkey, c_mktsegment, c_custkey IS NOT NULL AS found FROM customer")
def lasting_hashed_keys(t: Tables) -> DataFrame:
    """A hash with eight values for more segments and names than that: every customer gets a key of its own."""
    path, natural = scratch_path(t.spark, "keys"), ["c_custkey", "c_mktsegment"]
    few = lambda attempt, columns: F.pmod(F.xxhash64(*columns), F.lit(8 * 4**attempt)) + 10_000_000 * attempt
    rows = t.customer.select(F.lit(0).cast("long").alias("customer_sk"), *natural)
    with_lasting_key(rows.where("c_custkey % 3 = 0"), path, natural, "customer_sk", hashed=True, hasher=few)
    keyed = staged(with_lasting_key(rows, path, natural, "customer_sk", hashed=True, hasher=few))
    alone = keyed.groupBy("customer_sk").agg(F.count("*").alias("n")).where("n = 1").withColumnRenamed("customer_sk", "_sk")
    return keyed.join(alone, F.col("customer_sk") == F.col("_sk"), "left").select(*natural, F.col("n").isNotNull().alias("found"))


@query(f"""{with_tables("patients", "transfers", "dim_patient")}
SELECT 'patient_sk' AS key, count(*) AS "rows", count(*) FILTER (patient_sk IS NULL) AS missing
FROM transfers LEFT JOIN dim_patient USING (subject_id)
UNION ALL SELECT 'intime', count(*), count(*) FILTER (intime IS NULL) FROM transfers
""")
def key_report(t: Tables) -> DataFrame:
    """Transfers without a patient and without a time."""
    patient = s.patients(t).select("subject_id", F.col("subject_id").alias("patient_sk"))
    return missing_keys(s.transfers(t).join(patient, "subject_id", "left"), ["patient_sk", "intime"])


@query("""
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_sk, CAST(day AS DATE) AS date, CAST(day(day) AS INTEGER) AS day,
  CAST(month(day) AS INTEGER) AS month, CAST(year(day) AS INTEGER) AS year, strftime(day, '%a') AS weekday
FROM (SELECT unnest(generate_series(least(DATE '1995-01-01', min(CAST(o_orderdate AS DATE)), (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)), greatest(DATE '1995-12-31', max(CAST(o_orderdate AS DATE)),
  (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)), INTERVAL 1 DAY)) AS day FROM orders)
""")
def dim_date_extremes(t: Tables) -> DataFrame:
    """Every day of a year, and on to the first and the last date of two tables."""
    sources = [(t.orders, ["o_orderdate"]), (t.lineitem, ["l_shipdate"])]
    bounds = calendars.extreme_dates(t.spark, sources, "1995-01-01", "1995-12-31")
    return calendars.range_calendar(bounds, "start", "end")


# Saved models and the quality of scores


def _sizes(t: Tables) -> DataFrame:
    quantity = F.sum(F.col("l_quantity").cast(s.CENTS)).cast("double")
    return staged(t.lineitem.groupBy("l_orderkey").agg(quantity.alias("quantity"), F.count("*").cast("double").alias("lines")))


@query("""
WITH sizes AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(count(*) AS DOUBLE) AS lines
  FROM lineitem GROUP BY 1),
model AS (
  SELECT avg(quantity) AS mq, stddev_samp(quantity) AS sq, avg(lines) AS ml, stddev_samp(lines) AS sl FROM sizes WHERE l_orderkey % 2 = 0)
SELECT l_orderkey, round(abs((quantity - mq) / sq + (lines - ml) / sl) / sqrt(2), 4) AS pc1,
  round(abs((quantity - mq) / sq - (lines - ml) / sl) / sqrt(2), 4) AS pc2
FROM sizes, model
""")
def ml_loaded_projection(t: Tables) -> DataFrame:
    """Scaler and components fitted on half of the orders, saved, loaded and applied to all: a linear score of two columns."""
    rows, names, path = _sizes(t), ["quantity", "lines"], scratch_path(t.spark, "model")
    model = scoring.fit_once(t.spark, path, names, lambda: scoring.fit_clusters(rows.where("l_orderkey % 2 = 0"), names))
    placed = scoring.assign_clusters(model, rows)
    return placed.select("l_orderkey", *[F.round(F.abs(c), 4).alias(c) for c in ("pc1", "pc2")])


# A label that gets likelier with the number of a stratum: a share of it, told apart by the key.
_STRATUM, _DIED = "o_orderkey % 8", "CASE WHEN (o_orderkey // 8) % 10 <= o_orderkey % 8 THEN 1 ELSE 0 END"


def _strata(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    died = (F.floor(key / 8) % 10 <= key % 8).cast("double")
    return staged(t.orders.select("o_orderkey", (key % 8).cast("double").alias("stratum"), died.alias("died")))


def _scored_strata(t: Tables) -> DataFrame:
    """Risk of each order by a saved and loaded tree, on the strata."""
    rows, path = _strata(t), scratch_path(t.spark, "model")
    model = scoring.fit_once(t.spark, path, ["stratum"], lambda: scoring.fit_risk(rows, ["stratum"], "died", trees=1))
    return scoring.score_risk(model, rows)


@query(f"""
WITH strata AS (SELECT o_orderkey, {_DIED} AS died, avg({_DIED}) OVER (PARTITION BY {_STRATUM}) > 0.5 AS likely FROM orders)
SELECT o_orderkey, round(avg(died) OVER (PARTITION BY likely), 6) AS death_probability, CAST(likely AS INTEGER) AS death FROM strata
""")
def ml_loaded_risk(t: Tables) -> DataFrame:
    """The risk is the share of deaths in all strata of the order's class, as Spark joins leaves of one class."""
    return _scored_strata(t).select("o_orderkey", F.round("death_probability", 6).alias("death_probability"), "death")


@query(f"""
WITH strata AS (SELECT sum({_DIED}) AS p, sum(1 - {_DIED}) AS n FROM orders GROUP BY {_STRATUM}),
rates AS (SELECT p > n AS rate, sum(p) AS p, sum(n) AS n FROM strata GROUP BY 1)
SELECT CAST(sum(DISTINCT tp) AS BIGINT) AS positives, CAST(sum(DISTINCT tn) AS BIGINT) AS negatives,
  round(sum(a.p * CASE WHEN a.rate > b.rate THEN b.n WHEN a.rate = b.rate THEN b.n / 2 ELSE 0 END) / (max(tp) * max(tn)), 6) AS area
FROM rates a, rates b, (SELECT sum(p) AS tp, sum(n) AS tn FROM rates)
""")
def ml_risk_area(t: Tables) -> DataFrame:
    """Area under the curve of that risk; in SQL every class meets every other."""
    found = scoring.area_under_curve(_scored_strata(t), "death_probability", "died")
    return found.select("positives", "negatives", F.round("area", 6).alias("area"))


@query("""
WITH points AS (SELECT c_custkey, c_nationkey % 3 AS cluster, CAST(c_nationkey AS DOUBLE) AS x, CAST(c_custkey % 50 AS DOUBLE) AS y FROM customer),
far AS (
  SELECT a.c_custkey, a.cluster, b.cluster AS other, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, count(*) AS n
  FROM points a, points b GROUP BY ALL),
sides AS (
  SELECT c_custkey, cluster, max(CASE WHEN other = cluster THEN d / (n - 1) END) AS a, min(CASE WHEN other <> cluster THEN d / n END) AS b
  FROM far GROUP BY ALL)
SELECT cluster, count(*) AS members, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM sides GROUP BY 1
""")
def ml_cluster_quality(t: Tables) -> DataFrame:
    """Silhouette of a given grouping of the customers; in SQL every customer meets every other."""
    rows = t.customer.select(
        (F.col("c_nationkey") % 3).alias("cluster"), F.col("c_nationkey").cast("double").alias("x"), (F.col("c_custkey") % 50).cast("double").alias("y")
    )
    found = scoring.cluster_quality(rows, ["x", "y"])
    return found.select("cluster", "members", F.round("silhouette", 6).alias("silhouette"))


# Bucketed tables


@query("""
SELECT o_orderkey, o_custkey, count(l_linenumber) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
""")
def bucketed_star(t: Tables) -> DataFrame:
    """Orders and their lines from tables bucketed by order: neither the grouping nor the join shuffles."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_quantity").cast(s.CENTS).alias("quantity"))
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    frames = [t.orders.select("o_orderkey", "o_custkey"), lines]
    orders, lines = [write_bucketed(df, n, ["o_orderkey"], 8, scratch_path(t.spark, n)) for df, n in zip(frames, names, strict=True)]
    per = lines.groupBy("o_orderkey").agg(F.count("l_linenumber").alias("lines"), F.sum("quantity").alias("quantity"))
    rows = orders.join(per, "o_orderkey", "left")
    joined = staged(rows.select("o_orderkey", "o_custkey", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"), "quantity"))
    for name in names:
        drop_bucketed(t.spark, name)
    return joined
