from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakestar.plans import calendars, dims
from tests.helpers import rows

DAYS = ["2023-01-01", "2024-02-29", "2022-01-01", "2022-01-03"]


def days(spark):
    return spark.createDataFrame([(d,) for d in [*DAYS, DAYS[0], None]], "d string")


def test_observed_calendar(spark):
    out = calendars.observed_calendar([(days(spark), ["d"]), (days(spark), ["d"])])
    assert out.columns == ["date", "date_sk", "day", "month", "year", "weekday"]
    assert rows(out) == [
        (dt.date(2022, 1, 1), 20220101, 1, 1, 2022, "Saturday"),
        (dt.date(2022, 1, 3), 20220103, 3, 1, 2022, "Monday"),
        (dt.date(2023, 1, 1), 20230101, 1, 1, 2023, "Sunday"),
        (dt.date(2024, 2, 29), 20240229, 29, 2, 2024, "Thursday"),
    ]


def test_week_calendar(spark):
    out = calendars.week_calendar([(days(spark), ["d"])])
    assert out.columns == ["date_sk", "date", "day", "month", "year", "week", "quarter", "day_of_week"]
    assert rows(out, "date", "week", "quarter", "day_of_week") == [
        (dt.date(2022, 1, 1), 52, 1, 7), (dt.date(2022, 1, 3), 1, 1, 2),
        (dt.date(2023, 1, 1), 52, 1, 1), (dt.date(2024, 2, 29), 9, 1, 5),
    ]
    assert out.select("date_sk").distinct().count() == 4


def test_weekend_calendar(spark):
    out = calendars.weekend_calendar(days(spark), "d")
    assert out.columns == ["date", "date_sk", "day", "month", "year", "weekday", "is_weekend"]
    assert rows(out, "date", "weekday", "is_weekend") == [
        (dt.date(2022, 1, 1), "Sat", True), (dt.date(2022, 1, 3), "Mon", False),
        (dt.date(2023, 1, 1), "Sun", True), (dt.date(2024, 2, 29), "Thu", False),
    ]


def test_range_calendar(spark):
    bounds = spark.range(1).selectExpr("date'2109-01-01' AS start", "date'2215-12-31' AS end")
    out = calendars.range_calendar(bounds, "start", "end")
    assert out.columns == ["date_sk", "date", "day", "month", "year", "weekday"]
    assert out.count() == 39_080
    assert tuple(out.orderBy("date").first()) == (21090101, dt.date(2109, 1, 1), 1, 1, 2109, "Tue")


def test_numbered_patients_keep_copies(spark):
    data = [(3, "Male", None, 40, "g"), (1, "Female", None, 50, "g"), (3, "Male", None, 40, "g"), (None, None, None, None, None)]
    patients = spark.createDataFrame(data, "subject_id int, gender string, dod date, anchor_age int, anchor_year_group string")
    out = dims.numbered_patient_dim(patients)
    assert out.columns == ["patient_sk", "subject_id", "gender", "dod", "anchor_age", "anchor_year_group"]
    assert rows(out, "patient_sk", "subject_id") == [(1, None), (2, 1), (3, 3), (4, 3)]


def test_patients_by_id(spark):
    data = [(1, "Male", 40, 2100, None), (1, "Female", 40, 2100, None), (None, "Male", 1, 1, None)]
    patients = spark.createDataFrame(data, "subject_id int, gender string, anchor_age int, anchor_year int, dod date")
    assert rows(dims.subject_dim(patients), "subject_id", "gender") == [(1, "Female")]
    assert rows(dims.patient_dim(patients), "subject_id", "gender") == [(None, "Male"), (1, "Female")]
    assert dims.patient_dim(patients).columns == ["patient_sk", "subject_id", "gender", "anchor_age", "anchor_year", "dod"]
    assert dims.subject_dim(patients).columns == ["subject_sk", "subject_id", "gender", "anchor_age", "anchor_year"]


def test_services(spark):
    services = spark.createDataFrame(
        [(1, "2020-01-02", "MED"), (1, "2020-01-01", "SURG"), (2, None, "NULLFIRST"), (2, "2020-01-01", "MED"), (3, "2020-01-01", None), (None, "2020-01-01", "X")],
        "hadm_id int, transfertime string, curr_service string",
    ).withColumn("transfertime", F.col("transfertime").cast("date"))
    assert rows(dims.numbered_service_dim(services)) == [(1, "MED"), (2, "NULLFIRST"), (3, "SURG"), (4, "X")]
    assert rows(dims.first_service_dim(services), "hadm_id", "curr_service") == [(1, "SURG"), (2, "NULLFIRST")]
    assert rows(dims.service_dim(services), "curr_service", "specialty") == [(s, s) for s in ("MED", "NULLFIRST", "SURG", "X")]


def test_codes(spark):
    used = spark.createDataFrame([("A", 9), ("A", 9), ("B", 10), ("Z", 9)], "icd_code string, icd_version int")
    described = spark.createDataFrame(
        [("A", 9, "old"), ("A", 10, "new"), ("A", 9, "older"), ("B", 10, "b"), ("C", 9, "c")],
        "icd_code string, icd_version int, long_title string",
    )
    unique = dims.diagnosis_dim(described)
    assert unique.columns == ["diagnosis_sk", "icd_code", "icd_version", "long_title"]
    assert rows(unique.drop("diagnosis_sk")) == [("A", 9, "old"), ("A", 10, "new"), ("B", 10, "b"), ("C", 9, "c")]
    assert rows(dims.procedure_dim(described), "icd_code", "icd_version") == [("A", 9), ("A", 10), ("B", 10), ("C", 9)]
    assert rows(dims.used_diagnosis_dim(used, unique)) == [(1, "A", 9, "old"), (2, "B", 10, "b"), (3, "Z", 9, None)]
    by_code = dims.used_diagnosis_dim(used, unique, codes=["icd_code"])
    assert by_code.columns == ["diagnosis_sk", "icd_code", "icd_description"]
    assert rows(by_code) == [(1, "A", "new"), (2, "A", "old"), (3, "B", "b"), (4, "Z", None)]


def test_medications(spark):
    details = spark.createDataFrame(
        [("aspirin", None, "mg"), ("aspirin", "unknown", "mg"), ("aspirin", "oral", None), (None, "oral", "mg"), ("aspirin", "oral", None)],
        "product_description string, route string, product_unit string",
    )
    out = dims.medication_dim(details)
    assert out.columns == ["drug_sk", "drug_name", "route", "form"]
    assert rows(out.drop("drug_sk")) == [("aspirin", "oral", None), ("aspirin", "unknown", "mg")]


def test_admissions_have_thirteen_columns(spark):
    names = ["hadm_id", *dims.ADMISSION_ATTRIBUTES]
    admissions = spark.createDataFrame([tuple("1" for _ in names)] * 2, names)
    out = dims.admission_dim(admissions)
    assert out.columns == ["admission_sk", *names] and out.count() == 1
