"""Queries on the table builders: calendars, dimensions, facts, features and scores.

Keys that are hashes cannot be repeated in SQL. Such dimensions are compared without theirs, and such facts after their
keys have been looked up again in the dimensions, as a report on the star would do. As in a refresh, dimensions are
written before the fact reads them: they are built once, and Spark knows their sizes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from lakestar.operators.joins import DimRef, star_join
from lakestar.operators.keys import staged
from lakestar.plans import calendars, dims, facts, features, scoring
from lakestar.plans.silver import SILVER_TABLES
from lakestar.session import together
from workload import standins as s
from workload.registry import Tables, query
from workload.standins import with_tables

def written(*frames: DataFrame) -> list[DataFrame]:
    """Write dimensions to the scratch folder, several at a time, and read them back."""
    return together(*[partial(staged, df) for df in frames])


# Typed layer, with the rules of the real tables


@query("""
SELECT CAST(c_custkey AS INTEGER) AS subject_id, CASE WHEN c_nationkey < 10 THEN 'Male' WHEN c_nationkey < 20 THEN 'Female' END AS gender,
  CASE WHEN c_nationkey % 2 = 0 THEN DATE '2100-01-01' + c_nationkey END AS dod,
  CAST(trunc(c_acctbal) AS INTEGER) AS anchor_age, CAST(NULL AS INTEGER) AS anchor_year, c_mktsegment AS anchor_year_group
FROM customer
""")
def silver_patients(t: Tables) -> DataFrame:
    """Patients as text: codes M, F and others, death dates with and without a time, decimal ages, years that are words."""
    nation = F.col("c_nationkey")
    day = F.date_add(F.lit("2100-01-01").cast("date"), nation).cast("string")
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("subject_id"),
        F.when(nation < 10, "M").when(nation < 20, "F").otherwise("X").alias("gender"),
        F.when(nation % 2 == 0, day).otherwise(F.concat(day, F.lit(" 10:00:00"))).alias("dod"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("anchor_age"),
        F.col("c_name").alias("anchor_year"),
        F.col("c_mktsegment").alias("anchor_year_group"),
    )
    return SILVER_TABLES["patients"].build(raw)


@query("""
SELECT CAST(o_custkey AS INTEGER) AS subject_id, CAST(o_orderkey AS INTEGER) AS hadm_id,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS INTEGER) AS hospital_expire_flag,
  CAST(o_orderdate AS DATE) AS admittime, CAST(o_orderdate AS DATE) AS dischtime, CAST(NULL AS DATE) AS edregtime,
  CAST(NULL AS DATE) AS edouttime, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS deathtime,
  o_orderpriority AS admission_type
FROM orders
""")
def silver_admissions(t: Tables) -> DataFrame:
    """Admissions as text: datetimes, plain dates, words and NULL in date columns."""
    time = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = t.orders.select(
        F.col("o_custkey").cast("string").alias("subject_id"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("hadm_id"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", ".5").otherwise("?").alias("hospital_expire_flag"),
        time.alias("admittime"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dischtime"),
        F.col("o_orderpriority").alias("edregtime"),
        F.lit(None).cast("string").alias("edouttime"),
        F.when(F.col("o_orderstatus") == "F", time).alias("deathtime"),
        F.col("o_orderpriority").alias("admission_type"),
    )
    return SILVER_TABLES["admissions"].build(raw)


@query("""
SELECT CAST(user_id AS INTEGER) AS subject_id, CAST(NULL AS INTEGER) AS hadm_id, CAST(user_id AS INTEGER) AS stay_id,
  CAST(NULL AS INTEGER) AS caregiver_id, CAST(event_id AS INTEGER) AS itemid, CAST(trunc(value) AS INTEGER) AS warning,
  CAST(ts AS DATE) AS charttime, CAST(ts AS DATE) AS storetime, CASE WHEN event_type <> 'error' THEN value END AS valuenum,
  event_type AS valueuom, props AS value
FROM events
""")
def silver_chartevents(t: Tables) -> DataFrame:
    """Chart values as text: numbers, words among the numbers, ids that are no numbers."""
    number = F.col("value").cast("decimal(18,2)").cast("string")
    raw = t.events.select(
        F.col("user_id").cast("string").alias("subject_id"),
        F.col("event_type").alias("hadm_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("stay_id"),
        F.concat(F.lit("9999999"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("caregiver_id"),
        F.col("event_id").cast("string").alias("itemid"),
        number.alias("warning"),
        F.col("ts").cast("string").alias("charttime"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("storetime"),
        F.when(F.col("event_type") == "error", "error").otherwise(number).alias("valuenum"),
        F.col("event_type").alias("valueuom"),
        F.col("props").alias("value"),
    )
    return SILVER_TABLES["chartevents"].build(raw)


@query("""
SELECT CAST(o_custkey AS INTEGER) AS subject_id, lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '-' || o_orderkey AS emar_id,
  CAST(o_orderkey AS INTEGER) AS emar_seq,
  CAST(NULL AS INTEGER) AS pharmacy_id
FROM orders
""")
def silver_emar_detail(t: Tables) -> DataFrame:
    """Administration details as text: the composite id stays whole."""
    customer, order = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    raw = t.orders.select(
        customer.alias("subject_id"),
        F.concat_ws("-", F.lpad(customer, 8, "0"), order).alias("emar_id"),
        order.alias("emar_seq"),
        F.lit("").alias("pharmacy_id"),
    )
    return SILVER_TABLES["emar_detail"].build(raw)


# Calendars

_ALL_DATES = """
  SELECT DISTINCT date FROM (
    SELECT admittime AS date FROM admissions UNION ALL SELECT dischtime FROM admissions
    UNION ALL SELECT CAST(intime AS DATE) FROM transfers UNION ALL SELECT transfertime FROM services
  ) WHERE date IS NOT NULL
"""
_PARTS = """CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year"""


def _date_sources(t: Tables):
    return [
        (s.admissions(t), ["admittime", "dischtime"]),
        (s.transfers(t), ["intime"]),
        (s.services(t), ["transfertime"]),
    ]


@query(f"""{with_tables("admissions", "transfers", "services")}
SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_sk, {_PARTS}, strftime(date, '%A') AS weekday FROM ({_ALL_DATES})
""")
def dim_date_observed(t: Tables) -> DataFrame:
    return calendars.observed_calendar(_date_sources(t))


@query(f"""{with_tables("admissions", "transfers", "services")}
SELECT date, {_PARTS}, CAST(weekofyear(date) AS INTEGER) AS week, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week FROM ({_ALL_DATES})
""")
def dim_date_week(t: Tables) -> DataFrame:
    return calendars.week_calendar(_date_sources(t)).drop("date_sk")


@query(f"""
SELECT date, {_PARTS}, strftime(date, '%a') AS weekday, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE l_shipdate IS NOT NULL)
""")
def dim_date_weekend(t: Tables) -> DataFrame:
    return calendars.weekend_calendar(s.coded(t), "chartdate").drop("date_sk")


@query(f"""
SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_sk, {_PARTS}, strftime(date, '%a') AS weekday
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
""")
def dim_date_range(t: Tables) -> DataFrame:
    """Every day between the first and the last order."""
    bounds = t.orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return calendars.range_calendar(bounds, "start", "end")


# Dimensions


@query(f"""{with_tables("patients")}
SELECT row_number() OVER (ORDER BY subject_id) AS patient_sk, subject_id, gender, dod, anchor_age, anchor_year_group FROM patients
""")
def dim_entity_dense(t: Tables) -> DataFrame:
    return dims.numbered_patient_dim(s.patients(t))


@query(f"""{with_tables("patients")} SELECT subject_id, gender, anchor_age, anchor_year FROM patients""")
def dim_entity_dedupe(t: Tables) -> DataFrame:
    """Every patient twice: one survives."""
    twice = s.patients(t).unionByName(s.patients(t))
    return dims.subject_dim(twice).drop("subject_sk")


@query("""
SELECT l_orderkey AS subject_id, l_returnflag AS gender, l_linenumber AS anchor_age, l_partkey AS anchor_year, l_suppkey AS dod
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
WHERE rn = 1
""")
def dim_entity_id_dedupe(t: Tables) -> DataFrame:
    """Ids with several different rows: the least in column order survives."""
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("subject_id"), F.col("l_returnflag").alias("gender"),
        F.col("l_linenumber").alias("anchor_age"), F.col("l_partkey").alias("anchor_year"), F.col("l_suppkey").alias("dod"),
    )
    return dims.patient_dim(rows).drop("patient_sk")


@query(f"""{with_tables("services", "dim_service")} SELECT service_sk, service_id FROM dim_service""")
def dim_category(t: Tables) -> DataFrame:
    return dims.numbered_service_dim(s.services(t))


@query(f"""{with_tables("services")}
SELECT hadm_id, curr_service FROM (
  SELECT *, row_number() OVER (PARTITION BY hadm_id ORDER BY transfertime NULLS FIRST, curr_service) AS rn FROM services) WHERE rn = 1
""")
def dim_first_category(t: Tables) -> DataFrame:
    return dims.first_service_dim(s.services(t)).drop("service_sk")


@query(f"""{with_tables("services")}
SELECT DISTINCT curr_service, curr_service AS specialty FROM services WHERE curr_service IS NOT NULL
""")
def dim_category_copy(t: Tables) -> DataFrame:
    return dims.service_dim(s.services(t)).drop("service_sk")


@query(f"""{with_tables("coded", "descriptions", "titles")}
SELECT row_number() OVER (ORDER BY icd_code, icd_version) AS diagnosis_sk, icd_code, icd_version, long_title AS icd_description
FROM (SELECT DISTINCT icd_code, icd_version FROM coded) LEFT JOIN titles USING (icd_code, icd_version)
""")
def dim_code_used(t: Tables) -> DataFrame:
    return dims.used_diagnosis_dim(s.coded(t), dims.diagnosis_dim(s.descriptions(t)))


@query(f"""{with_tables("coded", "descriptions", "titles")}
SELECT row_number() OVER (ORDER BY icd_code, long_title NULLS FIRST) AS diagnosis_sk, icd_code, long_title AS icd_description
FROM (SELECT DISTINCT icd_code FROM coded) LEFT JOIN titles USING (icd_code)
""")
def dim_code_used_fanout(t: Tables) -> DataFrame:
    """Codes matched on the code alone: one row per description."""
    return dims.used_diagnosis_dim(s.coded(t), dims.diagnosis_dim(s.descriptions(t)), codes=["icd_code"])


@query(f"""{with_tables("descriptions", "titles")} SELECT icd_code, icd_version, long_title FROM titles""")
def dim_code_version(t: Tables) -> DataFrame:
    return dims.diagnosis_dim(s.descriptions(t)).drop("diagnosis_sk")


@query(f"""{with_tables("descriptions", "titles")} SELECT icd_code, icd_version, long_title FROM titles""")
def dim_procedure_code(t: Tables) -> DataFrame:
    return dims.procedure_dim(s.descriptions(t)).drop("procedure_sk")


@query(f"""{with_tables("admissions")} SELECT hadm_id, {", ".join(dims.ADMISSION_ATTRIBUTES)} FROM admissions""")
def dim_admission(t: Tables) -> DataFrame:
    return dims.admission_dim(s.admissions(t)).drop("admission_sk")


@query(f"""{with_tables("emar_detail")}
SELECT DISTINCT product_description AS drug_name, coalesce(route, 'unknown') AS route, product_unit AS form
FROM emar_detail WHERE product_description IS NOT NULL
""")
def dim_medication(t: Tables) -> DataFrame:
    return dims.medication_dim(s.emar_detail(t)).drop("drug_sk")


# Admission star


@query(f"""{with_tables("admissions", "readmissions")}
SELECT hadm_id, subject_id, admittime, dischtime, next_admit, days_to_next, readmitted_flag FROM readmissions
""")
def readmission(t: Tables) -> DataFrame:
    return facts.readmission(s.admissions(t).select("hadm_id", "subject_id", "admittime", "dischtime"))


@query(f"""{with_tables("services", "first_services")}
SELECT hadm_id, curr_service, count(*) AS copies FROM first_services GROUP BY 1, 2
""")
def first_service_ties(t: Tables) -> DataFrame:
    return facts.first_services(s.services(t))


def _admission_fact_sql(diagnosis_dim: str, diagnosis_join: str) -> str:
    names = [
        "patients", "admissions", "services", "coded", "descriptions", "titles", "first_services", "first_diagnoses",
        "readmissions", "dim_patient", "dim_service",
    ]
    return f"""{with_tables(*names)},
dim_diagnosis AS ({diagnosis_dim}),
rows AS (
  SELECT r.hadm_id AS admission_id, patient_sk, service_sk, diagnosis_sk,
    CAST(strftime(admittime, '%Y%m%d') AS INTEGER) AS admit_date_sk,
    CAST(strftime(dischtime, '%Y%m%d') AS INTEGER) AS discharge_date_sk,
    admission_type, hospital_expire_flag, readmitted_flag,
    CAST(date_diff('day', admittime, dischtime) AS INTEGER) AS length_of_stay
  FROM readmissions r JOIN dim_patient USING (subject_id)
  LEFT JOIN first_services fs ON r.hadm_id = fs.hadm_id LEFT JOIN dim_service ON service_id = curr_service
  LEFT JOIN first_diagnoses fd ON r.hadm_id = fd.hadm_id LEFT JOIN dim_diagnosis dd ON {diagnosis_join}
)
SELECT row_number() OVER (ORDER BY admission_id, service_sk NULLS FIRST, diagnosis_sk NULLS FIRST) AS fact_admission_id, * FROM rows
"""


def admission_fact(t: Tables, codes: list[str]) -> DataFrame:
    services, coded = s.services(t), s.coded(t)
    patient, service, diagnosis = together(
        lambda: dims.numbered_patient_dim(s.patients(t)),
        lambda: dims.numbered_service_dim(services),
        lambda: dims.used_diagnosis_dim(coded, dims.diagnosis_dim(s.descriptions(t)), codes),
    )
    return facts.fact_admissions(s.admissions(t), services, coded, patient, service, diagnosis, codes=codes)


@query(
    _admission_fact_sql(
        """SELECT row_number() OVER (ORDER BY icd_code, icd_version) AS diagnosis_sk, icd_code, icd_version
        FROM (SELECT DISTINCT icd_code, icd_version FROM coded)""",
        "fd.icd_code = dd.icd_code AND fd.icd_version = dd.icd_version",
    )
)
def fact_admissions(t: Tables) -> DataFrame:
    """Stay length and readmission of every admission, with its patient, first services and first diagnosis."""
    return admission_fact(t, ["icd_code", "icd_version"])


@query(
    _admission_fact_sql(
        """SELECT row_number() OVER (ORDER BY icd_code, long_title NULLS FIRST) AS diagnosis_sk, icd_code
        FROM (SELECT DISTINCT icd_code FROM coded) LEFT JOIN titles USING (icd_code)""",
        "fd.icd_code = dd.icd_code",
    )
)
def fact_admissions_by_code(t: Tables) -> DataFrame:
    """The same with the diagnosis dimension on the code alone: a row for each of its descriptions."""
    return admission_fact(t, ["icd_code"])


@query(f"""{with_tables("patients", "transfers", "dim_patient")}
SELECT row_number() OVER (ORDER BY subject_id, hadm_id, intime, transfer_id) AS fact_transfer_id, hadm_id AS admission_id,
  patient_sk, careunit AS from_location, CAST(strftime(intime, '%Y%m%d') AS INTEGER) AS transfer_date_sk
FROM transfers LEFT JOIN dim_patient USING (subject_id)
""")
def fact_transfers(t: Tables) -> DataFrame:
    return facts.fact_transfers(s.transfers(t), dims.numbered_patient_dim(s.patients(t)))


# Intensive care star


@query(f"""{with_tables("admissions", "icustays")}
SELECT stay_id, CASE WHEN hospital_expire_flag = 1 AND abs(epoch(outtime) - epoch(dischtime)) <= 600 THEN 1 ELSE 0 END AS icu_mortality
FROM icustays LEFT JOIN admissions USING (hadm_id)
""")
def icu_mortality(t: Tables) -> DataFrame:
    ends = s.admissions(t).select("hadm_id", "dischtime", "hospital_expire_flag")
    flag = facts.icu_mortality(F.col("hospital_expire_flag"), F.col("outtime"), F.col("dischtime"))
    return s.icustays(t).join(ends, "hadm_id", "left").select("stay_id", flag.alias("icu_mortality"))


def _mean_sql(items: str) -> str:
    return f"""CAST(sum(CASE WHEN event_type IN ({items}) THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
    / nullif(count(CASE WHEN event_type IN ({items}) THEN value END), 0)"""


@query(f"""{with_tables("patients", "admissions", "services", "icustays")},
vitals AS (
  SELECT user_id AS stay_id, {_mean_sql("'click', 'view'")} AS avg_heart_rate, {_mean_sql("'purchase', 'signup'")} AS avg_spo2
  FROM events GROUP BY 1),
fluids AS (
  SELECT l_orderkey AS stay_id, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_input_ml,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_output_ml, count(*) AS num_medications,
    nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS num_procedures
  FROM lineitem GROUP BY 1),
first_service AS (
  SELECT hadm_id, curr_service FROM (
    SELECT *, row_number() OVER (PARTITION BY hadm_id ORDER BY transfertime NULLS FIRST, curr_service) AS rn FROM services) WHERE rn = 1)
SELECT i.stay_id, p.subject_id, f.curr_service, CAST(i.intime AS DATE) AS admit_date, CAST(i.outtime AS DATE) AS discharge_date,
  (epoch(outtime) - epoch(intime)) / 3600 AS icu_los_hours, avg_heart_rate, avg_spo2, total_input_ml, total_output_ml,
  num_procedures, num_medications,
  CASE WHEN hospital_expire_flag = 1 AND abs(epoch(outtime) - epoch(dischtime)) <= 600 THEN 1 ELSE 0 END AS icu_mortality
FROM icustays i LEFT JOIN patients p USING (subject_id) LEFT JOIN first_service f ON i.hadm_id = f.hadm_id
LEFT JOIN admissions a ON i.hadm_id = a.hadm_id LEFT JOIN vitals v ON i.stay_id = v.stay_id LEFT JOIN fluids l ON i.stay_id = l.stay_id
""")
def fact_icu(t: Tables) -> DataFrame:
    """Summary of every stay, its keys looked up again."""
    patient, service, date = written(
        dims.subject_dim(s.patients(t)),
        dims.first_service_dim(s.services(t)),
        calendars.week_calendar([(s.icustays(t), ["intime", "outtime"])]),
    )
    fact = facts.fact_icu_monitoring(
        s.icustays(t), s.admissions(t), s.chartevents(t), s.inputevents(t), s.outputevents(t), s.procedureevents(t),
        s.prescriptions(t), patient, service, date, heart_rate=["click", "view"], spo2=["purchase", "signup"],
    )
    rows = star_join(
        fact,
        [
            DimRef(patient, [("subject_sk", "subject_sk")], {"subject_id": "subject_id"}),
            DimRef(service, [("service_sk", "service_sk")], {"curr_service": "curr_service"}),
            DimRef(date, [("admit_date_sk", "date_sk")], {"admit_date": "date"}),
            DimRef(date, [("discharge_date_sk", "date_sk")], {"discharge_date": "date"}),
        ],
    )
    return rows.drop("icu_monitoring_sk", "subject_sk", "service_sk", "admit_date_sk", "discharge_date_sk")


# Diagnosis and procedure star

_CODED_SQL = f"""{with_tables("patients", "admissions", "coded", "descriptions", "titles")}
SELECT c.icd_code, c.icd_version, c.subject_id, c.hadm_id, c.seq_num {{extra}}
FROM coded c JOIN titles USING (icd_code, icd_version) JOIN patients p ON c.subject_id = p.subject_id
JOIN admissions a ON c.hadm_id = a.hadm_id
"""


def _named(fact: DataFrame, code: DataFrame, code_sk: str, patient: DataFrame, admission: DataFrame) -> DataFrame:
    refs = [
        DimRef(code, [(code_sk, code_sk)], {"icd_code": "icd_code", "icd_version": "icd_version"}),
        DimRef(patient, [("patient_sk", "patient_sk")], {"subject_id": "subject_id"}),
        DimRef(admission, [("admission_sk", "admission_sk")], {"hadm_id": "hadm_id"}),
    ]
    return star_join(fact, refs).drop(code_sk, "patient_sk", "admission_sk")


@query(_CODED_SQL.format(extra=""))
def fact_diagnosis(t: Tables) -> DataFrame:
    """Diagnoses whose code, patient and admission are known, named again through the keys."""
    code, patient, admission = written(
        dims.diagnosis_dim(s.descriptions(t)), dims.patient_dim(s.patients(t)), dims.admission_dim(s.admissions(t))
    )
    fact = facts.fact_diagnosis(s.coded(t), code, patient, admission)
    return _named(fact, code, "diagnosis_sk", patient, admission).drop("diagnosis_fact_sk")


@query(_CODED_SQL.format(extra=", c.chartdate AS date"))
def fact_procedure(t: Tables) -> DataFrame:
    coded = s.coded(t)
    code, patient, admission, date = written(
        dims.procedure_dim(s.descriptions(t)),
        dims.patient_dim(s.patients(t)),
        dims.admission_dim(s.admissions(t)),
        calendars.weekend_calendar(coded, "chartdate"),
    )
    fact = facts.fact_procedure(coded, code, patient, admission, date)
    named = _named(fact, code, "procedure_sk", patient, admission)
    return star_join(named, [DimRef(date, [("date_sk", "date_sk")], {"date": "date"})]).drop("procedure_fact_sk", "date_sk")


# Medication star


def _medication(t: Tables, administrations: DataFrame, on: list[str], fill_route: bool = True) -> DataFrame:
    detail = s.emar_detail(t)
    day = F.col("charttime").cast("date")
    bounds = administrations.agg(F.min(day).alias("start"), F.max(day).alias("end"))
    patient, drug, date = written(
        dims.subject_dim(s.patients(t)), dims.medication_dim(detail), calendars.range_calendar(bounds, "start", "end")
    )
    fact = facts.fact_medication_administration(
        detail, administrations, patient, drug, date, on=on, fill_route=fill_route
    )
    rows = star_join(
        fact,
        [
            DimRef(patient, [("subject_sk", "subject_sk")], {"subject_id": "subject_id"}),
            DimRef(drug, [("drug_sk", "drug_sk")], {"drug_name": "drug_name", "route": "route", "form": "form"}),
        ],
    )
    return rows.drop("med_admin_sk", "subject_sk", "drug_sk")


_MEDICATION_SQL = f"""{with_tables("emar_detail")}
SELECT emar_id, emar_seq, o_custkey AS subject_id, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, dose_given,
  administration_type AS status,
  CASE WHEN {{found}} THEN product_description END AS drug_name,
  CASE WHEN {{found}} THEN coalesce(route, 'unknown') END AS route, CASE WHEN {{found}} THEN product_unit END AS form
FROM emar_detail LEFT JOIN orders ON emar_id = o_orderkey
"""


@query(_MEDICATION_SQL.format(found="product_unit IS NOT NULL"))
def fact_medication(t: Tables) -> DataFrame:
    """Administrations with patient, drug and date; a missing route counts as unknown, a missing unit finds no drug."""
    return _medication(t, s.emar(t), ["emar_id"])


@query(_MEDICATION_SQL.format(found="product_unit IS NOT NULL AND route IS NOT NULL"))
def fact_medication_raw_route(t: Tables) -> DataFrame:
    """The same where a missing route finds no drug."""
    return _medication(t, s.emar(t), ["emar_id"], fill_route=False)


_MEDICATION_LINES_SQL = f"""{with_tables("emar_detail")}
SELECT emar_id, emar_seq, c_custkey AS subject_id, CAST(strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS INTEGER) AS date_sk,
  dose_given, administration_type AS status, CASE WHEN product_unit IS NOT NULL THEN product_description END AS drug_name,
  CASE WHEN product_unit IS NOT NULL THEN coalesce(route, 'unknown') END AS route, product_unit AS form
FROM emar_detail LEFT JOIN lineitem ON {{on}} LEFT JOIN customer ON c_custkey = l_suppkey
"""


@query(_MEDICATION_LINES_SQL.format(on="emar_id = l_orderkey AND emar_seq = l_linenumber"))
def fact_medication_two_keys(t: Tables) -> DataFrame:
    """Details that meet their administration on id and number, the keys of a refresh."""
    return _medication(t, s.emar_lines(t), ["emar_id", "emar_seq"])


@query(_MEDICATION_LINES_SQL.format(on="emar_id = l_orderkey"))
def fact_medication_fanout(t: Tables) -> DataFrame:
    """The same on the id alone, which repeats: every detail meets each administration of its id."""
    return _medication(t, s.emar_lines(t), ["emar_id"])


# Features and scores

_ITEMS = ["click", "error", "purchase", "signup", "view"]
_FEATURES = features.BASE_FEATURES + _ITEMS


def feature_rows(t: Tables) -> DataFrame:
    coded = t.lineitem.select(F.col("l_partkey").alias("subject_id"))
    return features.feature_table(
        s.patients(t), s.icustays(t), coded, t.lineitem.select(F.col("l_suppkey").alias("subject_id")),
        t.lineitem.select(F.col("l_orderkey").alias("subject_id")), s.admissions(t), [s.chartevents(t)], items=_ITEMS,
    )


def _feature_sql(names: str) -> str:
    def count(table: str, column: str, name: str) -> str:
        return f"{name} AS (SELECT {column} AS subject_id, CAST(count(*) AS DOUBLE) AS {name} FROM {table} GROUP BY 1)"

    means = ", ".join(f"""{_mean_sql(f"'{item}'")} AS "{item}" """ for item in _ITEMS)
    counts = [
        count("lineitem", "l_partkey", "num_diagnoses"), count("lineitem", "l_suppkey", "num_procedures"),
        count("lineitem", "l_orderkey", "num_drugs"), count("orders", "o_custkey", "num_admissions"),
    ]
    joins = " ".join(f"LEFT JOIN {c} USING (subject_id)" for c in (
        "stays", "num_diagnoses", "num_procedures", "num_drugs", "num_admissions", "items"))
    filled = ", ".join(f'coalesce("{c}", 0.0) AS "{c}"' for c in _FEATURES[2:])
    return f"""{with_tables("patients", "icustays")},
    stays AS (SELECT subject_id, sum(epoch(outtime) - epoch(intime)) / 86400 AS icu_los FROM icustays GROUP BY 1),
    items AS (SELECT user_id AS subject_id, {means} FROM events GROUP BY 1), {", ".join(counts)},
    features AS (SELECT subject_id, CAST(anchor_age AS DOUBLE) AS anchor_age,
      CASE WHEN gender = 'Male' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS gender, {filled} FROM patients {joins})
    SELECT {names} FROM features"""


@query(_feature_sql("*"))
def feature_table(t: Tables) -> DataFrame:
    return feature_rows(t)


@query(
    _feature_sql(
        "subject_id, "
        + ", ".join(f'round(("{c}" - avg("{c}") OVER ()) / stddev_samp("{c}") OVER (), 6) AS "{c}"' for c in _FEATURES)
    )
)
def feature_scaled(t: Tables) -> DataFrame:
    """Standard scores, to six decimals."""
    rows = staged(feature_rows(t))
    scaled = scoring.scale(scoring.fit_scaler(rows, _FEATURES), rows, _FEATURES)
    return scaled.select("subject_id", *[F.round(c, 6).alias(c) for c in _FEATURES])


@query("""
WITH sizes AS (
  SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(count(*) AS DOUBLE) AS lines
  FROM lineitem GROUP BY 1),
scores AS (
  SELECT l_orderkey, (quantity - avg(quantity) OVER ()) / stddev_samp(quantity) OVER () AS a,
    (lines - avg(lines) OVER ()) / stddev_samp(lines) OVER () AS b FROM sizes)
SELECT l_orderkey, round(abs(a + b) / sqrt(2), 4) AS pc1, round(abs(a - b) / sqrt(2), 4) AS pc2 FROM scores
""")
def ml_projection(t: Tables) -> DataFrame:
    """Two correlated columns on their principal components, which are the diagonals; without the sign, which is arbitrary."""
    quantity = F.sum(F.col("l_quantity").cast(s.CENTS)).cast("double")
    rows = staged(t.lineitem.groupBy("l_orderkey").agg(quantity.alias("quantity"), F.count("*").cast("double").alias("lines")))
    placed = scoring.assign_clusters(scoring.fit_clusters(rows, ["quantity", "lines"]), rows)
    return placed.select("l_orderkey", *[F.round(F.abs(c), 4).alias(c) for c in ("pc1", "pc2")])


@query("SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS cluster FROM orders")
def ml_clusters(t: Tables) -> DataFrame:
    """Three clouds far apart, their clusters numbered by the first coordinate of their centres."""
    cloud = F.col("o_orderkey") % 3
    x, y = cloud * 100 + F.col("o_custkey") % 7, cloud * cloud * 50 + F.col("o_orderkey") % 5
    rows = staged(t.orders.select("o_orderkey", x.cast("double").alias("x"), y.cast("double").alias("y")))
    model = scoring.fit_clusters(rows, ["x", "y"])
    centres = [float(c[0]) for c in model.stages[2].clusterCenters()]
    number = F.array(*[F.lit(sorted(centres).index(c)) for c in centres])
    placed = scoring.assign_clusters(model, rows)
    return placed.select("o_orderkey", F.element_at(number, F.col("cluster") + 1).alias("cluster"))


@query("""
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS death, CAST(o_orderstatus = 'F' AS DOUBLE) AS death_probability FROM orders
""")
def ml_risk(t: Tables) -> DataFrame:
    """A label that one feature separates: class and probability are the label."""
    died = (F.col("o_orderstatus") == "F").cast("double")
    rows = t.orders.select(
        "o_orderkey", died.alias("died"), (died * 4 + F.col("o_orderkey") % 3).alias("x"), (F.col("o_custkey") % 10).cast("double").alias("y")
    )
    rows = staged(rows)
    scored = scoring.score_risk(scoring.fit_risk(rows, ["x", "y"], "died"), rows)
    return scored.select("o_orderkey", "death", F.round("death_probability", 6).alias("death_probability"))


@query("SELECT c_custkey AS subject_id, TRUE AS in_nearest_cluster, TRUE AS is_probability, TRUE AS class_follows FROM customer")
def ml_scores(t: Tables) -> DataFrame:
    """Facts that must hold of every patient's cluster and risk; patients without an admission are scored but not learned from."""
    died = s.admissions(t).groupBy("subject_id").agg(F.max("hospital_expire_flag").cast("double").alias("died"))
    # Written first, as fitting reads it many times.
    rows = staged(feature_rows(t).join(died, "subject_id", "left"))
    clusters = scoring.fit_clusters(rows, _FEATURES)
    risk = scoring.fit_risk(rows.dropna(subset=["died"]), _FEATURES, "died")
    scored = scoring.score_risk(risk, scoring.assign_clusters(clusters, rows))
    scaled = scoring.scale(scoring.fit_scaler(rows, _FEATURES), scored, _FEATURES)
    away = [
        sum((F.col(f"`{name}`") - float(x)) ** 2 for name, x in zip(_FEATURES, centre, strict=True))
        for centre in clusters.stages[2].clusterCenters()
    ]
    return scaled.select(
        "subject_id",
        (F.element_at(F.array(*away), F.col("cluster") + 1) <= F.least(*away) + 1e-6).alias("in_nearest_cluster"),
        F.col("death_probability").between(0, 1).alias("is_probability"),
        ((F.col("death") == 1) == (F.col("death_probability") > 0.5)).alias("class_follows"),
    )
