"""The typed layer: what each raw table's columns become."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation

from lakestar.functions.casts import prefix_int, recode, strict_date
from lakestar.operators.conform import Rule, conform, conform_counted


@dataclass(frozen=True)
class TableSpec:
    """A raw table: its source folder, its subject area in the typed layer, and a rule per typed column."""

    folder: str
    area: str
    rules: dict[str, Rule] = field(default_factory=dict)

    # Columns by which the typed table is dealt and sorted, where reports filter on them; none keeps the raw order.
    cluster: tuple[str, ...] = ()

    def build(self, raw: DataFrame) -> DataFrame:
        return conform(raw, self.rules)

    def build_counted(self, raw: DataFrame) -> tuple[DataFrame, Observation]:
        """The same, with the number of values that each rule loses."""
        return conform_counted(raw, self.rules)

    def rule_names(self) -> list[tuple[str, str]]:
        """Each rule's column and kind, in the order of the loss counts."""
        return [(name, rule if isinstance(rule, str) else rule.__name__.strip("_")) for name, rule in self.rules.items()]


def _gender(c: Column) -> Column:
    return recode(c, {"M": "Male", "F": "Female"})


def _spec(
    folder: str, area: str, *, special: dict[str, Callable[[Column], Column]] | None = None, cluster: str = "", **by_type: str
) -> TableSpec:
    """Spec from column names listed by type, as one text per type."""
    rules: dict[str, Rule] = {name: kind for kind, names in by_type.items() for name in names.split()}
    return TableSpec(folder, area, {**rules, **(special or {})}, tuple(cluster.split()))


# The tables, their folders and areas, and the type of each column. Columns not listed stay strings. The two
# tables that vital signs and features filter by item are clustered by it.
SILVER_TABLES: dict[str, TableSpec] = {
    "patients": _spec(
        "hosp", "PatientTracking",
        int="anchor_year anchor_age subject_id",
        special={"gender": _gender, "dod": strict_date},
    ),
    "admissions": _spec(
        "hosp", "PatientTracking",
        int="subject_id hadm_id hospital_expire_flag",
        date="admittime dischtime edregtime edouttime deathtime",
    ),
    "transfers": _spec("hosp", "PatientTracking", int="subject_id hadm_id transfer_id", date="intime outtime"),
    "services": _spec("hosp", "Administration", int="subject_id hadm_id", date="transfertime"),
    "poe": _spec(
        "hosp", "Administration", int="subject_id poe_seq hadm_id", date="ordertime"
    ),
    "poe_detail": _spec("hosp", "Administration", int="subject_id poe_seq"),
    "diagnoses_icd": _spec("hosp", "Billing", int="subject_id hadm_id icd_version seq_num"),
    "d_icd_diagnoses": _spec("hosp", "Billing", int="icd_version"),
    "procedures_icd": _spec("hosp", "Billing", int="icd_version subject_id hadm_id seq_num", date="chartdate"),
    "d_icd_procedures": _spec("hosp", "Billing", int="icd_version"),
    "drgcodes": _spec("hosp", "Billing", int="subject_id hadm_id drg_code drg_severity drg_mortality"),
    "hcpcsevents": _spec("hosp", "Billing", int="subject_id hadm_id seq_num", date="chartdate"),
    "d_hcpcs": _spec("hosp", "Billing", int="category"),
    "pharmacy": _spec(
        "hosp", "Medication",
        int="subject_id hadm_id pharmacy_id",
        date="starttime stoptime entertime verifiedtime expirationdate",
    ),
    "prescriptions": _spec(
        "hosp", "Medication",
        int="subject_id hadm_id pharmacy_id poe_seq",
        date="starttime stoptime",
    ),
    "emar": _spec(
        "hosp", "Medication",
        int="subject_id hadm_id emar_seq pharmacy_id",
        date="charttime scheduletime storetime",
    ),
    "emar_detail": _spec("hosp", "Medication", int="subject_id emar_seq pharmacy_id"),
    "labevents": _spec(
        "hosp", "Measurement",
        date="charttime storetime",
        int="subject_id hadm_id specimen_id itemid labevent_id",
        double="valuenum ref_range_lower ref_range_upper",
        cluster="itemid subject_id",
    ),
    "microbiologyevents": _spec(
        "hosp", "Measurement",
        date="chartdate storedate",
        int="microevent_id subject_id hadm_id micro_specimen_id spec_itemid org_itemid test_itemid test_seq ab_itemid",
    ),
    "omr": _spec("hosp", "Measurement", date="chartdate", int="subject_id seq_num"),
    "d_labitems": _spec("hosp", "Measurement", int="itemid"),
    "provider": _spec("hosp", "Provider"),
    "icustays": _spec("icu", "ICU-PatientTracking", int="subject_id hadm_id stay_id", date="intime outtime"),
    "chartevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid warning",
        date="charttime storetime",
        double="valuenum",
        string="valueuom value",
        cluster="itemid stay_id",
    ),
    "datetimeevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid",
        date="charttime storetime value",
    ),
    "ingredientevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid orderid linkorderid",
        double="amount rate originalamount originalrate",
        date="starttime endtime storetime",
    ),
    "inputevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid orderid linkorderid isopenbag continueinnextdept",
        double="amount rate originalamount originalrate patientweight totalamount",
        date="starttime endtime storetime",
    ),
    "outputevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid value",
        date="charttime storetime",
    ),
    "procedureevents": _spec(
        "icu", "ICU-Measurement",
        int="subject_id hadm_id stay_id caregiver_id itemid orderid linkorderid isopenbag continueinnextdept",
        double="value patientweight originalamount originalrate",
        date="starttime endtime storetime",
    ),
    "d_items": _spec("icu", "ICU-Measurement", int="itemid lownormalvalue highnormalvalue"),
    "caregiver": _spec("icu", "ICU-Caregiver", int="caregiver_id"),
}


# The tables with a composite id, and its column.
COMPOSITE_IDS = {"poe": "poe_id", "poe_detail": "poe_id", "prescriptions": "poe_id", "emar": "emar_id", "emar_detail": "emar_id"}


def cut_ids(table: str) -> TableSpec:
    """The table with its composite id cut to an int of the first characters. Ids that share them become equal, and those
    whose first part is shorter are lost, so this has to be asked for."""
    spec = SILVER_TABLES[table]
    return replace(spec, rules={**spec.rules, COMPOSITE_IDS[table]: prefix_int})


def keep_times(spec: TableSpec) -> TableSpec:
    """The same table with times of day kept: dates by cast become timestamps."""
    rules = {name: (lambda c: c.try_cast("timestamp")) if rule == "date" else rule for name, rule in spec.rules.items()}
    return replace(spec, rules=rules)
