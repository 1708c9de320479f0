from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakestar.plans import calendars, dims, facts
from tests.helpers import plan, rows


def admissions(spark, data):
    schema = "hadm_id int, subject_id int, admittime string, dischtime string, admission_type string, hospital_expire_flag int"
    df = spark.createDataFrame([(h, s, a, d, "URGENT", e) for h, s, a, d, e in data], schema)
    return df.withColumns({c: F.col(c).cast("date") for c in ("admittime", "dischtime")})


def test_readmission(spark):
    df = admissions(spark, [
        (1, 1, "2020-01-01", "2020-01-05", 0),  # 30 days before the next
        (2, 1, "2020-02-04", "2020-02-05", 0),  # 31 days before the next
        (3, 1, "2020-03-07", "2020-03-20", 0),  # the next one starts earlier than this ends
        (4, 1, "2020-03-10", None, 0),  # no discharge
        (5, 1, "2020-03-10", "2020-03-11", 0),  # same day as 4, after it by id; the last
        (6, 2, "2020-01-01", "2020-01-02", 0),
    ])
    out = facts.readmission(df)
    assert rows(out, "hadm_id", "days_to_next", "readmitted_flag") == [
        (1, 30, 1), (2, 31, 0), (3, -10, 1), (4, None, 0), (5, None, 0), (6, None, 0),
    ]


def services(spark, data):
    df = spark.createDataFrame(data, "hadm_id int, transfertime string, curr_service string")
    return df.withColumn("transfertime", F.col("transfertime").cast("date"))


SERVICES = [
    (1, "2020-01-01", "MED"), (1, "2020-01-01", "SURG"), (1, "2020-01-01", "MED"), (1, "2020-01-02", "ICU"),
    (2, None, "MED"), (2, "2020-01-03", None), (None, "2020-01-01", "MED"),
]


def test_first_services(spark):
    df = services(spark, SERVICES)
    assert rows(facts.first_services(df)) == [(1, "MED", 2), (1, "SURG", 1), (2, None, 1)]
    assert rows(facts.first_services(df, ties="first")) == [(1, "MED", 1), (2, None, 1)]


def test_first_services_cut_groups_before_the_shuffle(spark):
    text = plan(facts.first_services(services(spark, SERVICES)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_fact_admissions(spark):
    adm = admissions(spark, [
        (1, 1, "2020-01-01", "2020-01-05", 0), (2, 1, "2020-01-20", None, 1), (3, 9, "2020-01-01", "2020-01-02", 0),
    ])
    svc = services(spark, SERVICES)
    dx = spark.createDataFrame(
        [(1, 2, "B", 10), (1, 1, "A", 9), (2, 1, "Z", 9)], "hadm_id int, seq_num int, icd_code string, icd_version int"
    )
    texts = spark.createDataFrame([("A", 9, "old"), ("A", 10, "new")], "icd_code string, icd_version int, long_title string")
    patients = spark.createDataFrame([(1,), (2,)], "subject_id int").selectExpr(
        "subject_id", "'Male' AS gender", "date'2100-01-01' AS dod", "1 AS anchor_age", "'g' AS anchor_year_group"
    )
    pdim, sdim = dims.numbered_patient_dim(patients), dims.numbered_service_dim(svc)
    out = facts.fact_admissions(adm, svc, dx, pdim, sdim, dims.used_diagnosis_dim(dx, texts))
    assert out.columns == [
        "fact_admission_id", "admission_id", "patient_sk", "service_sk", "diagnosis_sk", "admit_date_sk",
        "discharge_date_sk", "admission_type", "hospital_expire_flag", "readmitted_flag", "length_of_stay",
    ]
    # Services: ICU 1, MED 2, SURG 3. Diagnoses: (A, 9) 1, (B, 10) 2, (Z, 9) 3. Patient 9 is unknown.
    assert rows(out) == [
        (1, 1, 1, 2, 1, 20200101, 20200105, "URGENT", 0, 1, 4),
        (2, 1, 1, 2, 1, 20200101, 20200105, "URGENT", 0, 1, 4),
        (3, 1, 1, 3, 1, 20200101, 20200105, "URGENT", 0, 1, 4),
        (4, 2, 1, None, 3, 20200120, None, "URGENT", 1, 0, None),
    ]
    one = facts.fact_admissions(adm, svc, dx, pdim, sdim, dims.used_diagnosis_dim(dx, texts), ties="first")
    assert rows(one, "fact_admission_id", "admission_id", "service_sk") == [(1, 1, 2), (2, 2, None)]
    by_code = facts.fact_admissions(
        adm, svc, dx, pdim, sdim, dims.used_diagnosis_dim(dx, texts, ["icd_code"]), ties="first", codes=["icd_code"]
    )
    assert rows(by_code, "admission_id", "diagnosis_sk") == [(1, 1), (1, 2), (2, 4)]


def test_fact_transfers(spark):
    moves = spark.createDataFrame(
        [(1, 5, 11, "2020-01-02 10:00:00", "ICU"), (1, 5, 10, "2020-01-02 10:00:00", "MED"), (9, None, 1, None, "ED")],
        "subject_id int, hadm_id int, transfer_id int, intime string, careunit string",
    ).withColumn("intime", F.col("intime").cast("timestamp"))
    patient = spark.createDataFrame([(7, 1)], "patient_sk int, subject_id int")
    assert rows(facts.fact_transfers(moves, patient)) == [
        (1, 5, 7, "MED", 20200102), (2, 5, 7, "ICU", 20200102), (3, None, None, "ED", None),
    ]


def test_icu_mortality(spark):
    out, discharge = "2020-01-02 10:10:00", ["2020-01-02 10:00:00", "2020-01-02 10:20:00", "2020-01-02 09:59:59", None]
    data = [(i, 1, out, d) for i, d in enumerate(discharge)] + [(4, 0, out, out), (5, None, out, out), (6, 1, out, out)]
    df = spark.createDataFrame(data, "i int, e int, o string, d string")
    times = df.select("i", "e", F.col("o").cast("timestamp").alias("o"), F.col("d").cast("timestamp").alias("d"))
    flag = facts.icu_mortality(F.col("e"), F.col("o"), F.col("d")).alias("flag")
    assert rows(times.select("i", flag)) == [(0, 1), (1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (6, 1)]
    days = times.select("i", "e", F.col("o").cast("date").alias("o"), F.col("d").cast("date").alias("d"))
    assert rows(days.select("i", flag)) == [(0, 1), (1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 1)]


def test_durations_do_not_see_summer_time(spark):
    df = spark.createDataFrame([("2021-03-28", "2021-03-29")], "a string, b string").selectExpr("date(a) a", "date(b) b")
    from lakestar.functions.dates import hours_between

    assert df.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 24.0


def icu_inputs(spark):
    stays = spark.createDataFrame(
        [(1, 1, 10, "2020-01-01", "2020-01-03"), (2, 9, 20, "2020-01-02", None)],
        "stay_id int, subject_id int, hadm_id int, intime string, outtime string",
    ).withColumns({c: F.col(c).cast("date") for c in ("intime", "outtime")})
    adm = spark.createDataFrame([(10, "2020-01-03", 1)], "hadm_id int, d string, hospital_expire_flag int")
    adm = adm.select("hadm_id", F.col("d").cast("date").alias("dischtime"), "hospital_expire_flag")
    chart = spark.createDataFrame(
        [(1, 211, "80"), (1, 220045, "90"), (1, 220277, "97.5"), (1, 646, "bad"), (1, 5, "1000"), (1, 211, None)],
        "stay_id int, itemid int, value string",
    )
    inputs = spark.createDataFrame([(1, 1.5), (1, 2.5), (1, None)], "stay_id int, amount double")
    outputs = spark.createDataFrame([(1, 7), (1, 8)], "stay_id int, value int")
    procedures = spark.createDataFrame([(1, "x"), (1, "y")], "stay_id int, p string")
    prescribed = spark.createDataFrame([(10,), (10,), (10,), (30,), (None,)], "hadm_id int")
    patients = spark.createDataFrame([(1, "Male", 40, 2100)], "subject_id int, gender string, anchor_age int, anchor_year int")
    svc = services(spark, [(10, "2020-01-01", "MED")])
    return (
        stays, adm, chart, inputs, outputs, procedures, prescribed,
        dims.subject_dim(patients), dims.first_service_dim(svc), calendars.week_calendar([(stays, ["intime", "outtime"])]),
    )


def test_fact_icu_monitoring(spark):
    out = facts.fact_icu_monitoring(*icu_inputs(spark))
    assert out.columns == [
        "icu_monitoring_sk", "stay_id", "subject_sk", "service_sk", "admit_date_sk", "discharge_date_sk",
        "icu_los_hours", "avg_heart_rate", "avg_spo2", "total_input_ml", "total_output_ml", "num_procedures",
        "num_medications", "icu_mortality",
    ]
    measures = [c for c in out.columns if not c.endswith("_sk")]
    assert rows(out, *measures) == [
        (1, 48.0, 85.0, 97.5, 4.0, 15.0, 2, 3, 1), (2, None, None, None, None, None, None, None, 0),
    ]
    keys = {r["stay_id"]: r for r in out.collect()}
    assert keys[1]["subject_sk"] is not None and keys[1]["service_sk"] is not None
    assert keys[2]["subject_sk"] is None and keys[2]["service_sk"] is None
    assert keys[1]["admit_date_sk"] != keys[1]["discharge_date_sk"] and keys[2]["discharge_date_sk"] is None


def test_vital_signs_come_from_one_filtered_scan(spark, tmp_path):
    path = str(tmp_path / "chart")
    spark.createDataFrame([(1, 211, "80", "x")], "stay_id int, itemid int, value string, note string").write.parquet(path)
    text = plan(facts.vital_signs(spark.read.parquet(path), facts.HEART_RATE_ITEMS, facts.SPO2_ITEMS))
    assert text.count("FileScan") == 1 and "In(itemid, [" in text and "note" not in text


def test_coded_facts_are_strict(spark):
    data = [
        (1, 10, "A", 9, 1, "2020-01-01"), (9, 10, "A", 9, 2, "2020-01-01"), (1, 99, "A", 9, 3, "2020-01-01"),
        (1, 10, "A", 10, 4, "2020-01-01"), (1, 10, "A", 9, 5, None), (None, 10, "A", 9, 6, "2020-01-01"),
    ]
    coded = spark.createDataFrame(data, "subject_id int, hadm_id int, icd_code string, icd_version int, seq_num int, d string")
    coded = coded.withColumn("chartdate", F.col("d").cast("date"))
    code = spark.createDataFrame([("A", 9, "a")], "icd_code string, icd_version int, long_title string")
    patient = spark.createDataFrame([(5, 1)], "patient_sk int, subject_id int")
    admission = spark.createDataFrame([(6, 10)], "admission_sk int, hadm_id int")
    diagnosis = facts.fact_diagnosis(coded, dims.diagnosis_dim(code), patient, admission)
    assert diagnosis.columns == ["diagnosis_fact_sk", "diagnosis_sk", "patient_sk", "admission_sk", "seq_num"]
    assert rows(diagnosis, "patient_sk", "admission_sk", "seq_num") == [(5, 6, 1), (5, 6, 5)]
    date = calendars.weekend_calendar(coded, "chartdate")
    procedure = facts.fact_procedure(coded, dims.procedure_dim(code), patient, admission, date)
    assert procedure.columns == ["procedure_fact_sk", "procedure_sk", "patient_sk", "admission_sk", "date_sk", "seq_num"]
    assert rows(procedure, "seq_num") == [(1,)]
    assert diagnosis.select("diagnosis_fact_sk").distinct().count() == 2


def test_fact_medication_administration(spark):
    detail = spark.createDataFrame(
        [
            ("1-1", 1, "oral", "aspirin", "mg", "5", "given"),
            ("1-2", 2, None, "aspirin", "mg", "5", "given"),
            ("1-2", 3, "oral", "aspirin", None, "5", "held"),
            ("1-3", 4, "oral", "other", "mg", None, None),
        ],
        "emar_id string, emar_seq int, route string, product_description string, product_unit string, dose_given string, administration_type string",
    )
    head = spark.createDataFrame(
        [("1-1", 1, 1, "2020-01-01 10:00:00"), ("1-2", 2, 1, "2020-01-01"), ("1-2", 3, 9, "2021-01-01")],
        "emar_id string, emar_seq int, subject_id int, charttime string",
    )
    patient = spark.createDataFrame([(5, 1)], "subject_sk int, subject_id int")
    drug = dims.medication_dim(detail.filter("product_description = 'aspirin'"))
    bounds = spark.range(1).selectExpr("date'2020-01-01' AS a", "date'2020-12-31' AS b")
    date = calendars.range_calendar(bounds, "a", "b")

    def found(**options):
        out = facts.fact_medication_administration(detail, head, patient, drug, date, **options)
        assert out.columns == ["med_admin_sk", "emar_id", "emar_seq", "subject_sk", "drug_sk", "date_sk", "dose_given", "status"]
        return rows(out.withColumn("has_drug", F.col("drug_sk").isNotNull()), "emar_seq", "subject_sk", "has_drug", "date_sk", "status")

    assert found() == [
        (1, 5, True, 20200101, "given"), (2, 5, True, 20200101, "given"), (3, None, False, None, "held"),
        (4, None, False, None, None),
    ]
    assert found(fill_route=False, broadcast_rows=None)[1] == (2, 5, False, 20200101, "given")
    # Tied by id alone, each detail meets every administration with that id.
    assert len(found(on=["emar_id"])) == 6


def test_hot_patients_and_hot_admissions_change_nothing(spark):
    """A third of the admissions belong to one patient, a third of the services are copies for one admission."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = spark.range(900)
        patient = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 200)
        adm = ids.select(
            F.col("id").alias("hadm_id"), patient.alias("subject_id"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 500).cast("int")).alias("admittime"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 500 + F.col("id") % 9).cast("int")).alias("dischtime"),
            F.lit("URGENT").alias("admission_type"), F.lit(0).alias("hospital_expire_flag"),
        )
        svc = ids.select(
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("hadm_id"),
            F.when(F.col("id") % 3 == 0, F.lit("2019-01-01")).otherwise("2020-01-01").cast("date").alias("transfertime"),
            F.when(F.col("id") % 3 == 0, "MED").otherwise("SURG").alias("curr_service"),
        )
        dx = ids.select(F.col("id").alias("hadm_id"), F.lit(1).alias("seq_num"), F.lit("A").alias("icd_code"), F.lit(9).alias("icd_version"))
        texts = dx.select("icd_code", "icd_version", F.lit("t").alias("long_title")).distinct()
        people = adm.select("subject_id").distinct().selectExpr(
            "subject_id", "'Male' AS gender", "date'2100-01-01' AS dod", "1 AS anchor_age", "'g' AS anchor_year_group"
        )
        pdim, sdim, ddim = dims.numbered_patient_dim(people), dims.numbered_service_dim(svc), dims.used_diagnosis_dim(dx, texts)
        plain = rows(facts.fact_admissions(adm, svc, dx, pdim, sdim, ddim))
        hot = rows(facts.fact_admissions(adm, svc, dx, pdim, sdim, ddim, hot_rows=50))
        assert hot == plain
        assert len(plain) == 899 + 300 and [r[0] for r in plain] == list(range(1, 1200))
        assert sum(r[1] == 5 for r in plain) == 300
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_admissions_of_stays_change_nothing(spark):
    inputs = list(icu_inputs(spark))
    inputs[0] = spark.range(300).selectExpr(
        "cast(id AS int) AS stay_id", "1 AS subject_id", "cast(if(id % 3 = 0, 10, id) AS int) AS hadm_id",
        "date'2020-01-01' AS intime", "date'2020-01-03' AS outtime",
    )
    measures = ["stay_id", "num_medications", "icu_mortality", "icu_los_hours", "avg_heart_rate"]
    plain, hot = facts.fact_icu_monitoring(*inputs), facts.fact_icu_monitoring(*inputs, hot_rows=20)
    assert "_fact_salt" in plan(hot) and "_fact_salt" not in plan(plain)
    assert rows(hot, *measures) == rows(plain, *measures)
    assert sum(r[1] == 3 for r in rows(plain, *measures)) == 101


def test_unnumbered_diagnoses_come_last(spark):
    rows = spark.createDataFrame([(1, None, "Z"), (1, 2, "B"), (1, 1, "A"), (2, None, "Y")], "hadm_id int, seq_num int, icd_code string")
    assert sorted(map(tuple, facts.first_diagnoses(rows, ["icd_code"]).collect())) == [(1, "A"), (2, "Y")]
