"""Raw files to catalog on a few records."""

from __future__ import annotations

import datetime as dt

import pytest

from lakestar.plans import refresh
from lakestar.plans.silver import SILVER_TABLES, cut_ids, keep_times
from tests.helpers import rows

# Records of the tables that matter; the others get one row of empty fields.
RECORDS = {
    "patients": [
        {"subject_id": "1", "gender": "M", "dod": "2180-05-06", "anchor_age": "40", "anchor_year": "2100", "anchor_year_group": "g"},
        {"subject_id": "2", "gender": "X", "dod": "", "anchor_age": "x", "anchor_year": "2101", "anchor_year_group": "g"},
    ],
    "admissions": [
        {"subject_id": "1", "hadm_id": "10", "admittime": "2150-01-01 08:00:00", "dischtime": "2150-01-05 09:00:00",
         "hospital_expire_flag": "0", "admission_type": "URGENT"},
        {"subject_id": "1", "hadm_id": "11", "admittime": "2150-01-20 08:00:00", "dischtime": "2150-01-22 09:00:00",
         "hospital_expire_flag": "1", "admission_type": "EW EMER."},
    ],
    "transfers": [
        {"subject_id": "1", "hadm_id": "10", "transfer_id": "5", "intime": "2150-01-01 10:00:00", "outtime": "2150-01-02 10:00:00", "careunit": "MICU"},
    ],
    "services": [{"subject_id": "1", "hadm_id": "10", "transfertime": "2150-01-01 09:00:00", "curr_service": "MED"}],
    "diagnoses_icd": [{"subject_id": "1", "hadm_id": "10", "seq_num": "1", "icd_code": "A", "icd_version": "9"}],
    "d_icd_diagnoses": [{"icd_code": "A", "icd_version": "9", "long_title": "Cholera"}],
    "procedures_icd": [
        {"subject_id": "1", "hadm_id": "11", "seq_num": "1", "icd_code": "P", "icd_version": "10", "chartdate": "2150-01-21"},
        {"subject_id": "1", "hadm_id": "99", "seq_num": "1", "icd_code": "P", "icd_version": "10", "chartdate": "2150-01-21"},
    ],
    "d_icd_procedures": [{"icd_code": "P", "icd_version": "10", "long_title": "Suture"}],
    "prescriptions": [{"subject_id": "1", "hadm_id": "11", "poe_id": "10000001-7"}],
    "emar": [{"subject_id": "1", "hadm_id": "11", "emar_id": "10000001-1", "emar_seq": "1", "charttime": "2150-01-21 01:00:00"}],
    "emar_detail": [
        {"subject_id": "1", "emar_id": "10000001-1", "emar_seq": "1", "route": "", "product_description": "aspirin",
         "product_unit": "mg", "dose_given": "5", "administration_type": "given"},
    ],
    "icustays": [{"subject_id": "1", "hadm_id": "11", "stay_id": "7", "intime": "2150-01-20 09:00:00", "outtime": "2150-01-22 08:00:00"}],
    "chartevents": [
        {"stay_id": "7", "itemid": "211", "value": "80", "valuenum": "80", "charttime": "2150-01-21 09:00:00"},
        {"stay_id": "7", "itemid": "220277", "value": "error", "valuenum": ""},
    ],
    "inputevents": [{"stay_id": "7", "amount": "1.5"}],
    "outputevents": [{"stay_id": "7", "value": "30.7"}],
    "procedureevents": [{"stay_id": "7"}],
}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    from lakestar.plans.dims import ADMISSION_ATTRIBUTES

    root = tmp_path_factory.mktemp("lake")
    for table, spec in SILVER_TABLES.items():
        records = RECORDS.get(table, [{}])
        extra = ADMISSION_ATTRIBUTES if table == "admissions" else []
        names = list(dict.fromkeys([*spec.rules, *extra, *[name for record in records for name in record], "note"]))
        path = root / "raw" / spec.folder / f"{table}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [",".join(names), *[",".join(record.get(name, "") for name in names[:-1]) + ",n" for record in records]]
        path.write_text("\n".join(lines) + "\n")
    made = refresh.Layers(spark, *[str(root / part) for part in ("raw", "bronze", "silver", "gold")])
    refresh.bronze(made)
    refresh.silver(made)
    for star in (refresh.admission_star, refresh.icu_star, refresh.coding_star, refresh.medication_star, refresh.catalog):
        star(made)
    return made


def test_specs_cover_the_tables():
    assert len(SILVER_TABLES) == 31
    assert sum(len(spec.rules) for spec in SILVER_TABLES.values()) == 181
    assert sum(len(spec.rules) for spec in refresh.cut_id_specs().values()) == 186
    assert sum(spec.folder == "icu" for spec in SILVER_TABLES.values()) == 9
    assert SILVER_TABLES["provider"].rules == {}


def test_silver_is_typed(layers):
    patients = layers.silver_table("patients")
    assert rows(patients, "subject_id", "gender", "dod", "anchor_age", "note") == [
        (1, "Male", dt.date(2180, 5, 6), 40, "n"), (2, None, None, None, "n"),
    ]
    assert rows(layers.silver_table("outputevents"), "value") == [(30,)]
    assert rows(layers.silver_table("emar"), "emar_id", "charttime") == [("10000001-1", dt.date(2150, 1, 21))]
    assert layers.silver_table("provider").columns == ["note"]


def test_composite_ids_are_cut_on_request(spark):
    raw = spark.createDataFrame([("10000001-1", "1", "2")], "emar_id string, emar_seq string, pharmacy_id string")
    raw = raw.selectExpr("*", "'3' AS subject_id")
    assert SILVER_TABLES["emar_detail"].build(raw).first()["emar_id"] == "10000001-1"
    assert cut_ids("emar_detail").build(raw).first()["emar_id"] == 10000001


def test_times_can_be_kept(spark):
    raw = spark.createDataFrame([("1", "1", "1", "2150-01-20 09:00:00", "bad")], "subject_id string, hadm_id string, stay_id string, intime string, outtime string")
    kept = keep_times(SILVER_TABLES["icustays"]).build(raw).first()
    assert kept["intime"] == dt.datetime(2150, 1, 20, 9) and kept["outtime"] is None


def test_admission_star(layers):
    facts = layers.gold_table(refresh.ADMISSION_STAR, "fact_admissions")
    assert rows(facts, "admission_id", "patient_sk", "service_sk", "diagnosis_sk", "readmitted_flag", "length_of_stay") == [
        (10, 1, 1, 1, 1, 4), (11, 1, None, None, 0, 2),
    ]
    assert rows(layers.gold_table(refresh.ADMISSION_STAR, "fact_transfers")) == [(1, 10, 1, "MICU", 21500101)]


def test_icu_star(layers):
    assert rows(
        layers.gold_table(refresh.ICU_STAR, "fact_icu_monitoring"),
        "stay_id", "icu_los_hours", "avg_heart_rate", "avg_spo2", "total_input_ml", "total_output_ml",
        "num_procedures", "num_medications", "icu_mortality",
    ) == [(7, 48.0, 80.0, None, 1.5, 30.0, 1, 1, 1)]


def test_coding_and_medication_stars(layers):
    assert layers.gold_table(refresh.CODING_STAR, "fact_diagnosis").count() == 1
    assert layers.gold_table(refresh.CODING_STAR, "fact_procedure").count() == 1
    med = layers.gold_table(refresh.MEDICATION_STAR, "fact_medication_administration").first()
    assert med["subject_sk"] is not None and med["drug_sk"] is not None and med["date_sk"] == 21500121


def test_catalog_has_48_tables(spark, layers):
    counts = {db: len(spark.catalog.listTables(db)) for db in [*refresh.DATABASES.values(), refresh.SILVER_DATABASE]}
    assert list(counts.values()) == [6, 4, 7, 31]
    joined = spark.sql("""
        SELECT count(*) FROM hospitaladmissionprocess.fact_admissions f
        JOIN hospitaladmissionprocess.dim_patient p ON f.patient_sk = p.patient_sk JOIN SilverLayer.admissions a ON a.hadm_id = f.admission_id
    """)
    assert joined.first()[0] == 2


def test_second_run_changes_nothing_but_the_transfers(layers):
    def files(star, table):
        return sorted(layers.gold_table(star, table).inputFiles())

    before = {t: files(refresh.ADMISSION_STAR, t) for t in ("fact_admissions", "dim_patient", "fact_transfers")}
    refresh.admission_star(layers)
    after = {t: files(refresh.ADMISSION_STAR, t) for t in before}
    assert before["fact_admissions"] == after["fact_admissions"] and before["dim_patient"] == after["dim_patient"]
    assert before["fact_transfers"] != after["fact_transfers"]


def test_whole_refresh_from_the_raw_files(spark, layers, tmp_path):
    fresh = refresh.Layers(spark, layers.raw, *[str(tmp_path / part) for part in ("bronze", "silver", "gold")])
    refresh.refresh(fresh)
    med = fresh.gold_table(refresh.MEDICATION_STAR, "fact_medication_administration").first()
    assert med["emar_id"] == "10000001-1" and med["drug_sk"] is not None
    assert fresh.gold_table(refresh.ADMISSION_STAR, "fact_admissions").count() == 2
