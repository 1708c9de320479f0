"""The given tables under the names and columns the builders expect, in Spark and as SQL.

Customers stand for patients, orders for admissions and stays, lines for services, diagnoses, procedures and
administrations, parts for codes and drugs, events for chart values and transfers. All are plain projections, so column
pruning and pushdown reach the files. Where a number is summed it is a decimal, so that its sum does not depend on order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from workload.registry import Tables

CENTS = "decimal(18,2)"


def _date(column: str):
    return F.col(column).cast("date")


def patients(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_mktsegment") < "F", "Male").when(F.col("c_mktsegment") < "M", "Female").alias("gender"),
        F.date_add(F.lit("2100-01-01").cast("date"), F.col("c_nationkey")).alias("dod"),
        F.col("c_nationkey").alias("anchor_age"),
        (F.col("c_nationkey") + 2100).alias("anchor_year"),
        F.col("c_mktsegment").alias("anchor_year_group"),
    )


def admissions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        _date("o_orderdate").alias("admittime"),
        F.date_add("o_orderdate", (F.col("o_orderkey") % 15).cast("int")).alias("dischtime"),
        F.col("o_orderpriority").alias("admission_type"),
        F.col("o_orderstatus").alias("insurance"),
        F.substring("o_orderpriority", 1, 1).alias("language"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("marital_status"),
        F.concat("o_orderstatus", "o_orderpriority").alias("race"),
        F.lower("o_orderpriority").alias("admission_location"),
        F.lower("o_orderstatus").alias("discharge_location"),
        F.col("o_custkey").cast("string").alias("admit_provider_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("hospital_expire_flag"),
    )


def services(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("hadm_id"),
        _date("l_shipdate").alias("transfertime"),
        F.col("l_returnflag").alias("curr_service"),
    )


def coded(t: Tables) -> DataFrame:
    """Diagnoses and procedures. The part number stands for the patient too, so some patients are unknown."""
    codes = t.part.select(
        F.col("p_partkey").alias("subject_id"), F.col("p_brand").alias("icd_code"), F.col("p_type").alias("icd_version")
    )
    lines = t.lineitem.select(
        F.col("l_partkey").alias("subject_id"),
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_linenumber").alias("seq_num"),
        _date("l_shipdate").alias("chartdate"),
    )
    return lines.join(codes, "subject_id")


def descriptions(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_brand").alias("icd_code"), F.col("p_type").alias("icd_version"), F.col("p_name").alias("long_title")
    )


def transfers(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("subject_id"),
        F.floor("value").alias("hadm_id"),
        F.col("event_id").alias("transfer_id"),
        F.col("ts").alias("intime"),
        F.col("event_type").alias("careunit"),
    )


def icustays(t: Tables) -> DataFrame:
    """A stay per order. It ends at, or 600 seconds, 601 seconds or a day after the discharge."""
    late = F.element_at(F.array(F.lit(0), F.lit(600), F.lit(601), F.lit(86400)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    length = F.make_dt_interval(days=(F.col("o_orderkey") % 15).cast("int"), secs=late.cast("decimal(18,6)"))
    return t.orders.select(
        F.col("o_orderkey").alias("stay_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("intime"),
        (F.col("o_orderdate") + length).alias("outtime"),
    )


def chartevents(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("stay_id"),
        F.col("user_id").alias("subject_id"),
        F.col("event_type").alias("itemid"),
        F.col("value").cast(CENTS).alias("value"),
        F.col("value").cast(CENTS).alias("valuenum"),
    )


def inputevents(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("stay_id"), F.col("l_quantity").cast(CENTS).alias("amount"))


def outputevents(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("stay_id"), F.col("l_extendedprice").cast(CENTS).alias("value"))


def procedureevents(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("stay_id"))


def prescriptions(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_suppkey").alias("subject_id"))


def emar(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("emar_id"), F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("charttime")
    )


def emar_lines(t: Tables) -> DataFrame:
    """An administration per order line: ids repeat, only id and number together are a key. The supplier stands for the patient."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("emar_id"), F.col("l_linenumber").alias("emar_seq"),
        F.col("l_suppkey").alias("subject_id"), _date("l_shipdate").alias("charttime"),
    )


def emar_detail(t: Tables) -> DataFrame:
    drugs = t.part.select(
        F.col("p_partkey").alias("drug"),
        F.col("p_name").alias("product_description"),
        F.when(F.col("p_size") >= 10, F.col("p_brand")).alias("route"),
        F.when(F.col("p_size") <= 40, F.col("p_type")).alias("product_unit"),
    )
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("emar_id"),
        F.col("l_linenumber").alias("emar_seq"),
        F.col("l_partkey").alias("drug"),
        F.col("l_quantity").alias("dose_given"),
        F.col("l_returnflag").alias("administration_type"),
    )
    return lines.join(drugs, "drug")


# The same tables as common table expressions.
CTE = {
    "patients": """
        SELECT c_custkey AS subject_id,
          CASE WHEN c_mktsegment < 'F' THEN 'Male' WHEN c_mktsegment < 'M' THEN 'Female' END AS gender,
          CAST(DATE '2100-01-01' + c_nationkey AS DATE) AS dod, c_nationkey AS anchor_age,
          c_nationkey + 2100 AS anchor_year, c_mktsegment AS anchor_year_group FROM customer""",
    "admissions": """
        SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, CAST(o_orderdate AS DATE) AS admittime,
          CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS dischtime,
          o_orderpriority AS admission_type, o_orderstatus AS insurance, substring(o_orderpriority, 1, 1) AS language,
          CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS marital_status,
          o_orderstatus || o_orderpriority AS race, lower(o_orderpriority) AS admission_location,
          lower(o_orderstatus) AS discharge_location, CAST(o_custkey AS VARCHAR) AS admit_provider_id,
          CAST(o_orderstatus = 'F' AS INTEGER) AS hospital_expire_flag FROM orders""",
    "services": """
        SELECT l_orderkey AS hadm_id, CAST(l_shipdate AS DATE) AS transfertime, l_returnflag AS curr_service FROM lineitem""",
    "coded": """
        SELECT l_partkey AS subject_id, l_orderkey AS hadm_id, l_linenumber AS seq_num,
          CAST(l_shipdate AS DATE) AS chartdate, p_brand AS icd_code, p_type AS icd_version
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "descriptions": """
        SELECT p_brand AS icd_code, p_type AS icd_version, p_name AS long_title FROM part""",
    "titles": """
        SELECT icd_code, icd_version, min(long_title) AS long_title FROM descriptions GROUP BY 1, 2""",
    "transfers": """
        SELECT user_id AS subject_id, CAST(floor(value) AS BIGINT) AS hadm_id, event_id AS transfer_id, ts AS intime,
          event_type AS careunit FROM events""",
    "icustays": """
        SELECT o_orderkey AS stay_id, o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS intime,
          o_orderdate + to_days(CAST(o_orderkey % 15 AS INTEGER))
            + to_seconds(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 600 WHEN 2 THEN 601 ELSE 86400 END) AS outtime
        FROM orders""",
    "emar_detail": """
        SELECT l_orderkey AS emar_id, l_linenumber AS emar_seq, p_name AS product_description,
          CASE WHEN p_size >= 10 THEN p_brand END AS route, CASE WHEN p_size <= 40 THEN p_type END AS product_unit,
          l_quantity AS dose_given, l_returnflag AS administration_type
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    # Building blocks shared by several queries.
    "first_services": """
        SELECT hadm_id, curr_service FROM services
        JOIN (SELECT hadm_id, min(transfertime) AS m FROM services GROUP BY 1) USING (hadm_id) WHERE transfertime = m""",
    "first_diagnoses": """
        SELECT hadm_id, icd_code, icd_version FROM (SELECT *, row_number() OVER (
          PARTITION BY hadm_id ORDER BY seq_num, icd_code, icd_version) AS rn FROM coded) WHERE rn = 1""",
    "readmissions": """
        SELECT *, CAST(date_diff('day', dischtime, next_admit) AS INTEGER) AS days_to_next,
          CASE WHEN date_diff('day', dischtime, next_admit) <= 30 THEN 1 ELSE 0 END AS readmitted_flag
        FROM (SELECT *, lead(admittime) OVER (PARTITION BY subject_id ORDER BY admittime, hadm_id) AS next_admit FROM admissions)""",
    "dim_patient": "SELECT row_number() OVER (ORDER BY subject_id) AS patient_sk, subject_id FROM patients",
    "dim_service": """
        SELECT row_number() OVER (ORDER BY curr_service) AS service_sk, curr_service AS service_id
        FROM (SELECT DISTINCT curr_service FROM services WHERE curr_service IS NOT NULL)""",
}


def with_tables(*names: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({CTE[name]})" for name in names)
