"""Entity, category and code dimensions.

Generic builders first, then the dimensions of each star with their fixed columns. Every builder puts its surrogate
key first. "Numbered" keys are dense 1..n; the others are hashes of the natural key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakestar.operators.groups import dedupe, first_by
from lakestar.operators.keys import dense_key, stable_key


def numbered_dim(df: DataFrame, columns: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """All rows, copies included, numbered in the given order."""
    return dense_key(df.select(*columns), order, key, copies=True).select(key, *columns)


def entity_dim(
    df: DataFrame, ids: Sequence[str], attributes: Sequence[str], key: str, order: Sequence[str] = (), require_ids: bool = False
) -> DataFrame:
    """One row per natural key: the first in ``order``, then in the order of the attributes."""
    rows = df.select(*ids, *attributes)
    if require_ids:
        rows = rows.dropna(subset=list(ids))
    return dedupe(rows, ids, order).select(stable_key(*ids).alias(key), *ids, *attributes)


def category_dim(df: DataFrame, column: str, key: str, copy_as: str | None = None) -> DataFrame:
    """Distinct values of a column with a hashed key and, if named, a second column that starts as a copy."""
    values = df.select(column).dropna().distinct()
    extra = [F.col(column).alias(copy_as)] if copy_as else []
    return values.select(stable_key(column).alias(key), column, *extra)


def numbered_category_dim(df: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """Distinct values of a column, numbered in their order."""
    values = df.select(F.col(column).alias(name)).dropna().distinct()
    return dense_key(values, [name], key).select(key, name)


def used_code_dim(
    used: DataFrame, described: DataFrame, codes: Sequence[str], text: str, key: str, text_as: str
) -> DataFrame:
    """Codes that occur in ``used`` with their description, numbered; one row per matching description.

    With fewer ``codes`` than the description table is keyed on, a code gets a row for each of its descriptions.
    """
    joined = used.select(*codes).distinct().join(described.select(*codes, F.col(text).alias(text_as)), list(codes), "left")
    return dense_key(joined, codes, key, copies=True).select(key, *codes, text_as)


# Admission star


def numbered_patient_dim(patients: DataFrame) -> DataFrame:
    columns = ["subject_id", "gender", "dod", "anchor_age", "anchor_year_group"]
    return numbered_dim(patients, columns, ["subject_id"], "patient_sk")


def numbered_service_dim(services: DataFrame) -> DataFrame:
    return numbered_category_dim(services, "curr_service", "service_sk", "service_id")


def used_diagnosis_dim(
    diagnoses: DataFrame, descriptions: DataFrame, codes: Sequence[str] = ("icd_code", "icd_version")
) -> DataFrame:
    """Pass ``codes=["icd_code"]`` to match descriptions on the code alone, whatever its version."""
    return used_code_dim(diagnoses, descriptions, codes, "long_title", "diagnosis_sk", "icd_description")


# Intensive care star; the medication star has the same patients


def subject_dim(patients: DataFrame) -> DataFrame:
    return entity_dim(patients, ["subject_id"], ["gender", "anchor_age", "anchor_year"], "subject_sk", require_ids=True)


def first_service_dim(services: DataFrame) -> DataFrame:
    """The first service of each admission. A service without a time comes first; ties go to the least name."""
    first = first_by(services.select("hadm_id", "transfertime", "curr_service"), ["hadm_id"], ["transfertime"])
    known = first.select("hadm_id", "curr_service").dropna()
    return known.select(stable_key("hadm_id").alias("service_sk"), "hadm_id", "curr_service")


# Diagnosis and procedure star


def patient_dim(patients: DataFrame) -> DataFrame:
    return entity_dim(patients, ["subject_id"], ["gender", "anchor_age", "anchor_year", "dod"], "patient_sk")


def diagnosis_dim(descriptions: DataFrame) -> DataFrame:
    return entity_dim(descriptions, ["icd_code", "icd_version"], ["long_title"], "diagnosis_sk")


def procedure_dim(descriptions: DataFrame) -> DataFrame:
    return entity_dim(descriptions, ["icd_code", "icd_version"], ["long_title"], "procedure_sk")


# The columns of the admission dimension after its key and hadm_id.
ADMISSION_ATTRIBUTES = [
    "admittime", "dischtime", "admission_type", "insurance", "language", "marital_status", "race",
    "admission_location", "discharge_location", "admit_provider_id", "hospital_expire_flag",
]


def admission_dim(admissions: DataFrame) -> DataFrame:
    return entity_dim(admissions, ["hadm_id"], ADMISSION_ATTRIBUTES, "admission_sk")


# Medication star


def service_dim(services: DataFrame) -> DataFrame:
    return category_dim(services, "curr_service", "service_sk", copy_as="specialty")


# Fixed value: what stands for a missing route.
UNKNOWN_ROUTE = "unknown"


def medication_dim(administrations: DataFrame) -> DataFrame:
    """Distinct drug name, route and form; the name must be known, a missing route becomes "unknown"."""
    drugs = administrations.select(
        F.col("product_description").alias("drug_name"),
        F.coalesce(F.col("route").cast("string"), F.lit(UNKNOWN_ROUTE)).alias("route"),
        F.col("product_unit").alias("form"),
    )
    drugs = drugs.dropna(subset=["drug_name"]).distinct()
    return drugs.select(stable_key("drug_name", "route", "form").alias("drug_sk"), "drug_name", "route", "form")
