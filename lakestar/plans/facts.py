"""Fact tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType

from lakestar.functions.casts import lenient_double
from lakestar.functions.dates import date_key, hours_between, seconds_between
from lakestar.operators.groups import first_by, first_value, next_value
from lakestar.operators.joins import BROADCAST_ROWS, DimRef, broadcast_if_small, lookup, star_join
from lakestar.operators.keys import dense_key, staged, unique_id
from lakestar.operators.skew import HOT_ROWS, count_copies, expand_copies
from lakestar.plans.dims import UNKNOWN_ROUTE

# The window of a readmission in days, the tolerance of a death at the end of a stay in seconds, and
# the chart items of the two vital signs.
READMISSION_DAYS = 30
DEATH_TOLERANCE_SECONDS = 600
HEART_RATE_ITEMS = (211, 220045)
SPO2_ITEMS = (220277, 646)


# Admission star


def readmission(admissions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the patient's next admission, the days from discharge to it, and a flag if those are 30 or fewer.

    A next admission that precedes the discharge counts as a readmission; none, or an unknown date, does not.
    """
    ahead = next_value(admissions, ["subject_id"], ["admittime", "hadm_id"], "admittime", "next_admit", hot_rows)
    days = F.datediff("next_admit", "dischtime")
    return ahead.withColumns(
        {"days_to_next": days, "readmitted_flag": F.when(days <= READMISSION_DAYS, 1).otherwise(0)}
    )


def first_services(services: DataFrame, ties: Literal["all", "first"] = "all") -> DataFrame:
    """The service an admission starts with; those that tie on the earliest time are all kept by default.

    Equal rows come as one with their number in ``copies``, so that what is ranked per admission are the few
    services that share its earliest time, however often each is repeated.
    """
    timed = services.select("hadm_id", "transfertime", "curr_service").filter("transfertime is not null and hadm_id is not null")
    if ties == "first":
        return first_by(timed, ["hadm_id"], ["transfertime"]).select("hadm_id", "curr_service", F.lit(1).cast("long").alias("copies"))
    earliest = F.rank().over(Window.partitionBy("hadm_id").orderBy("transfertime"))
    ranked = count_copies(timed).withColumn("_rank", earliest).filter("_rank = 1")
    return ranked.select("hadm_id", "curr_service", "copies")


def first_diagnoses(diagnoses: DataFrame, codes: Sequence[str]) -> DataFrame:
    """The diagnosis coded first for each admission: the lowest seq_num, then the least code. A NULL seq_num comes last."""
    known = diagnoses.withColumn("_unnumbered", F.col("seq_num").isNull())
    return first_value(known, ["hadm_id"], codes, ["_unnumbered", "seq_num"])


def fact_admissions(
    admissions: DataFrame,
    services: DataFrame,
    diagnoses: DataFrame,
    dim_patient: DataFrame,
    dim_service: DataFrame,
    dim_diagnosis: DataFrame,
    ties: Literal["all", "first"] = "all",
    codes: Sequence[str] = ("icd_code", "icd_version"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Admissions with length of stay, readmission and the keys of patient, first service and first diagnosis.

    A patient must be known; service and diagnosis may be missing. An admission has one row per tied first service,
    and per dimension row of its diagnosis, which is one unless the dimension is built on the code alone.
    """
    columns = ["hadm_id", "subject_id", "admittime", "dischtime", "admission_type", "hospital_expire_flag"]
    rows = readmission(admissions.select(*columns), hot_rows)
    rows = lookup(rows, DimRef(dim_patient, [("subject_id", "subject_id")], {"patient_sk": "patient_sk"}), "inner")
    rows = rows.join(first_services(services, ties), "hadm_id", "left")
    rows = rows.join(first_diagnoses(diagnoses, codes), "hadm_id", "left")
    rows = star_join(
        rows,
        [
            DimRef(dim_service, [("curr_service", "service_id")], {"service_sk": "service_sk"}),
            DimRef(dim_diagnosis, [(c, c) for c in codes], {"diagnosis_sk": "diagnosis_sk"}),
        ],
    )
    measures = rows.select(
        F.col("hadm_id").alias("admission_id"),
        "patient_sk",
        "service_sk",
        "diagnosis_sk",
        date_key(F.col("admittime")).alias("admit_date_sk"),
        date_key(F.col("dischtime")).alias("discharge_date_sk"),
        "admission_type",
        "hospital_expire_flag",
        "readmitted_flag",
        F.datediff("dischtime", "admittime").alias("length_of_stay"),
        "copies",
    )
    numbered = dense_key(
        expand_copies(staged(measures), "copies", "_copy_number"), ["admission_id"], "fact_admission_id"
    )
    return numbered.select("fact_admission_id", *[c for c in measures.columns if c != "copies"])


def fact_transfers(transfers: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """One row per transfer, numbered by patient, admission and time."""
    rows = transfers.select("subject_id", "hadm_id", "intime", "transfer_id", "careunit")
    rows = lookup(rows, DimRef(dim_patient, [("subject_id", "subject_id")], {"patient_sk": "patient_sk"}))
    # The sort reads its input twice; the join behind it runs once.
    numbered = dense_key(staged(rows), ["subject_id", "hadm_id", "intime", "transfer_id"], "fact_transfer_id")
    return numbered.select(
        "fact_transfer_id",
        F.col("hadm_id").alias("admission_id"),
        "patient_sk",
        F.col("careunit").alias("from_location"),
        date_key(F.col("intime")).alias("transfer_date_sk"),
    )


# Intensive care star


def icu_mortality(expired: Column, left: Column, discharged: Column) -> Column:
    """1 if the patient died and left the unit within 600 seconds of the discharge. On dates: on the same day."""
    apart = F.abs(seconds_between(discharged, left))
    return F.when((expired == 1) & (apart <= DEATH_TOLERANCE_SECONDS), 1).otherwise(0)


def _number(df: DataFrame, column: str) -> Column:
    """The column for adding up: text as a double, a whole number as a double, an exact decimal as it is."""
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        return lenient_double(F.col(column))
    return F.col(column) if kind == "decimal" else F.col(column).cast("double")


def _mean(value: Column) -> Column:
    """Mean as sum by count, so that decimal input is added up exactly."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def vital_signs(chartevents: DataFrame, heart_rate: Sequence[object], spo2: Sequence[object]) -> DataFrame:
    """Mean heart rate and oxygen saturation per stay, in one scan of the chart that reads only their items."""
    value = _number(chartevents, "value").alias("value")
    charted = chartevents.select("stay_id", "itemid", value).filter(F.col("itemid").isin(*heart_rate, *spo2))

    def mean_of(items: Sequence[object]) -> Column:
        return _mean(F.when(F.col("itemid").isin(*items), F.col("value")))

    return charted.groupBy("stay_id").agg(
        mean_of(heart_rate).alias("avg_heart_rate"), mean_of(spo2).alias("avg_spo2")
    )


def fact_icu_monitoring(
    icustays: DataFrame,
    admissions: DataFrame,
    chartevents: DataFrame,
    inputevents: DataFrame,
    outputevents: DataFrame,
    procedureevents: DataFrame,
    prescriptions: DataFrame,
    dim_patient: DataFrame,
    dim_service: DataFrame,
    dim_date: DataFrame,
    heart_rate: Sequence[object] = HEART_RATE_ITEMS,
    spo2: Sequence[object] = SPO2_ITEMS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per stay with its keys, hours, vital signs, fluid totals, counts and the mortality flag.

    Every event table is reduced to one row per stay, or per admission, before it meets the stays, so no join
    multiplies rows. Joins come in runs on one key, and so does the shuffle of the stays.
    """
    stays = icustays.select(
        "stay_id", "subject_id", "hadm_id", "intime", "outtime",
        hours_between(F.col("intime"), F.col("outtime")).alias("icu_los_hours"),
    )
    ends = admissions.select("hadm_id", "dischtime", "hospital_expire_flag")
    prescribed = prescriptions.groupBy("hadm_id").agg(F.count("hadm_id").alias("_prescribed"))
    totals_in = inputevents.groupBy("stay_id").agg(F.sum("amount").cast("double").alias("total_input_ml"))
    totals_out = outputevents.groupBy("stay_id").agg(F.sum(_number(outputevents, "value")).cast("double").alias("total_output_ml"))
    procedures = procedureevents.groupBy("stay_id").agg(F.count("*").alias("num_procedures"))

    calendar = broadcast_if_small(dim_date)

    def date_ref(time: str, out: str) -> DimRef:
        return DimRef(calendar, [(F.col(time).cast("date"), "date")], {out: "date_sk"})

    rows = star_join(
        stays,
        [
            DimRef(prescribed, [("hadm_id", "hadm_id")], {"num_medications": "_prescribed"}, hot_rows=hot_rows),
            DimRef(dim_service, [("hadm_id", "hadm_id")], {"service_sk": "service_sk"}),
            DimRef(ends, [("hadm_id", "hadm_id")], {c: c for c in ("dischtime", "hospital_expire_flag")}),
            DimRef(dim_patient, [("subject_id", "subject_id")], {"subject_sk": "subject_sk"}),
            date_ref("intime", "admit_date_sk"),
            date_ref("outtime", "discharge_date_sk"),
        ],
    )
    for per_stay in (vital_signs(chartevents, heart_rate, spo2), totals_in, totals_out, procedures):
        rows = rows.join(per_stay, "stay_id", "left")
    return rows.select(
        unique_id().alias("icu_monitoring_sk"),
        "stay_id",
        "subject_sk",
        "service_sk",
        "admit_date_sk",
        "discharge_date_sk",
        "icu_los_hours",
        "avg_heart_rate",
        "avg_spo2",
        "total_input_ml",
        "total_output_ml",
        "num_procedures",
        "num_medications",
        icu_mortality(F.col("hospital_expire_flag"), F.col("outtime"), F.col("dischtime")).alias("icu_mortality"),
    )


# Diagnosis and procedure star


def _coded_refs(dim_code: DataFrame, code_sk: str, dim_patient: DataFrame, dim_admission: DataFrame) -> list[DimRef]:
    return [
        DimRef(dim_code, [("icd_code", "icd_code"), ("icd_version", "icd_version")], {code_sk: code_sk}),
        DimRef(dim_patient, [("subject_id", "subject_id")], {"patient_sk": "patient_sk"}),
        DimRef(dim_admission, [("hadm_id", "hadm_id")], {"admission_sk": "admission_sk"}),
    ]


def fact_diagnosis(
    diagnoses: DataFrame, dim_diagnosis: DataFrame, dim_patient: DataFrame, dim_admission: DataFrame
) -> DataFrame:
    """One row per coded diagnosis whose code, patient and admission are all known."""
    rows = star_join(diagnoses, _coded_refs(dim_diagnosis, "diagnosis_sk", dim_patient, dim_admission), strict=True)
    return rows.select(
        unique_id().alias("diagnosis_fact_sk"), "diagnosis_sk", "patient_sk", "admission_sk", "seq_num"
    )


def fact_procedure(
    procedures: DataFrame, dim_procedure: DataFrame, dim_patient: DataFrame, dim_admission: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per coded procedure whose code, patient, admission and date are all known."""
    refs = _coded_refs(dim_procedure, "procedure_sk", dim_patient, dim_admission)
    refs.append(DimRef(broadcast_if_small(dim_date), [(F.col("chartdate").cast("date"), "date")], {"date_sk": "date_sk"}))
    rows = star_join(procedures, refs, strict=True)
    return rows.select(
        unique_id().alias("procedure_fact_sk"), "procedure_sk", "patient_sk", "admission_sk", "date_sk", "seq_num"
    )


# Medication star


def fact_medication_administration(
    details: DataFrame,
    administrations: DataFrame,
    dim_patient: DataFrame,
    dim_medication: DataFrame,
    dim_date: DataFrame,
    on: Sequence[str] = ("emar_id", "emar_seq"),
    fill_route: bool = True,
    broadcast_rows: int | None = BROADCAST_ROWS,
) -> DataFrame:
    """One row per detail of an administration, with patient, drug and date where known.

    ``on`` names the columns that tie a detail to its administration; ids cut to a prefix (ints) alone would match every
    administration of a patient with each other, and are refused. With ``fill_route`` a missing route looks up the "unknown" of the
    drug dimension, otherwise it finds nothing. The dimensions are broadcast if a count finds them small enough.
    """
    if list(on) == ["emar_id"] and isinstance(details.schema["emar_id"].dataType, IntegerType):
        raise ValueError("cut ids do not tell administrations apart; add emar_seq to on, or keep the ids whole")
    detail = details.select(
        "emar_id", "emar_seq", "route", "product_description", "product_unit", "dose_given", "administration_type"
    )
    head = administrations.select(*on, "subject_id", F.col("charttime").cast("date").alias("_chart_date"))
    route = F.coalesce(F.col("route"), F.lit(UNKNOWN_ROUTE)) if fill_route else F.col("route")
    drug_key = [("product_description", "drug_name"), (route, "route"), ("product_unit", "form")]
    rows = star_join(
        detail.join(head, list(on), "left"),
        [
            DimRef(dim_patient, [("subject_id", "subject_id")], {"subject_sk": "subject_sk"}, broadcast_rows=broadcast_rows),
            DimRef(dim_medication, drug_key, {"drug_sk": "drug_sk"}, broadcast_rows=broadcast_rows),
            DimRef(dim_date, [("_chart_date", "date")], {"date_sk": "date_sk"}, broadcast_rows=broadcast_rows),
        ],
    )
    return rows.select(
        unique_id().alias("med_admin_sk"),
        "emar_id",
        "emar_seq",
        "subject_sk",
        "drug_sk",
        "date_sk",
        "dose_given",
        F.col("administration_type").alias("status"),
    )
