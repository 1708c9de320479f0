"""The layers in turn: raw CSV to bronze, bronze to silver, silver to the gold stars, and the catalog over them.

Each layer is written before the next one reads it, so generated keys are fixed and lineage stays short. A table that
is complete is not written again; only the transfer fact is replaced on every run. All roots are Hadoop paths.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestar.operators.keys import missing_keys, require_unique, staged
from lakestar.operators.lasting import with_lasting_key
from lakestar.operators.unions import union_all
from lakestar.plans import calendars, dims, facts, features, scoring
from lakestar.plans.silver import COMPOSITE_IDS, SILVER_TABLES, TableSpec, cut_ids
from lakestar.session import scratch_scope, side_session, together
from lakestar.sources.bucketed import write_bucketed
from lakestar.sources.catalog import create_database, register_all
from lakestar.sources.tables import (
    DEFAULT_FORMAT,
    ingest,
    is_complete,
    read_available,
    read_table,
    write_clustered,
    write_new,
    write_replace,
)

# The stars' folders in the gold layer and the databases they and the silver layer are registered in.
ADMISSION_STAR = "HospitalAdmissionProcess"
ICU_STAR = "IcuStayMonitoring"
CODING_STAR = "diagnosis_process"
MEDICATION_STAR = "MedicationUsageAdministration"
DATABASES = {
    ADMISSION_STAR: "hospitaladmissionprocess",
    ICU_STAR: "icustaymonitoring",
    CODING_STAR: "DiagnosisProcedureAnalytics",
}
SILVER_DATABASE = "SilverLayer"
EVENT_DATABASE = "EventLayer"
# The event tables of the monitoring star, the key by which each is reduced, and what they are sorted by inside a bucket.
EVENT_KEYS = {
    "chartevents": "stay_id", "inputevents": "stay_id", "outputevents": "stay_id", "procedureevents": "stay_id",
    "prescriptions": "hadm_id",
}
EVENT_SORT = {"chartevents": ["itemid"]}

# The calendar of the intensive care star looks for dates in these silver tables, some of which may be
# missing, and the calendar of the medication star covers these dates.
ICU_DATE_SOURCES = {
    "ICU-PatientTracking/icustays": ["intime", "outtime"],
    "ICU-Measurement/chartevents": ["charttime"],
    "ICU-Measurement/datetimeevents": ["charttime"],
    "ICU-Measurement/inputevents": ["starttime", "endtime"],
    "ICU-Measurement/outputevents": ["charttime"],
    "ICU-Measurement/procedureevents": ["starttime", "endtime"],
    "ICU-Measurement/ingredientevents": ["starttime", "endtime"],
    "ICU-Measurement/labevents": ["charttime"],
    "ICU-Measurement/microbiologyevents": ["chartdate"],
    "ICU-Measurement/omr": ["chartdate"],
    "ICU-Caregiver/emar": ["charttime"],
    "ICU-Caregiver/emar_detail": ["charttime"],
}
MEDICATION_DATES = ("2109-01-01", "2215-12-31")


@dataclass(frozen=True)
class Layers:
    """Where the layers live, and the format of all but the raw one. ``repair`` writes half-written tables anew; malformed
    raw lines go to tables below ``rejects``, if it is given; surrogate keys last in key tables below ``keys``, if it is given; with ``events`` the monitoring star
    reads its event tables from copies there that lie in ``buckets`` buckets by stay or admission."""

    spark: SparkSession
    raw: str
    bronze: str
    silver: str
    gold: str
    fmt: str = DEFAULT_FORMAT
    repair: bool = False
    rejects: str | None = None
    keys: str | None = None
    events: str | None = None
    buckets: int = 64

    @property
    def losses(self) -> str:
        return f"{self.silver}/losses"

    def silver_path(self, table: str) -> str:
        return f"{self.silver}/{SILVER_TABLES[table].area}/{table}"

    def silver_table(self, table: str) -> DataFrame:
        return read_table(self.spark, self.silver_path(table), fmt=self.fmt)

    def gold_path(self, star: str, table: str) -> str:
        return f"{self.gold}/{star}/{table}"

    def gold_table(self, star: str, table: str) -> DataFrame:
        return read_table(self.spark, self.gold_path(star, table), fmt=self.fmt)

    def event_table(self, table: str, key: str) -> DataFrame:
        """A typed event table, from its bucketed copy if there is a place for those; the copy is made once."""
        if not self.events:
            return self.silver_table(table)
        name = f"{EVENT_DATABASE}.{table}"
        create_database(self.spark, EVENT_DATABASE)
        path = f"{self.events}/{table}"
        return write_bucketed(self.silver_table(table), name, [key], self.buckets, path, EVENT_SORT.get(table, []))

    def keyed(self, dim: DataFrame, star: str, table: str, natural: Sequence[str], key: str, hashed: bool = True) -> DataFrame:
        """The dimension with lasting keys, if there is a place for key tables; else as it was built."""
        if not self.keys:
            return dim
        return with_lasting_key(dim, f"{self.keys}/{star}/{table}", natural, key, hashed)

    def report_keys(self, star: str, facts: Mapping[str, Sequence[str]]) -> None:
        """Write how many rows of each fact have found no row of a dimension, by key, to the star's ``key_report``."""
        each = [missing_keys(self.gold_table(star, fact), keys).withColumn("fact", F.lit(fact)) for fact, keys in facts.items()]
        report = union_all(each).select("fact", "key", "rows", "missing").coalesce(1)
        write_replace(report, self.gold_path(star, "key_report"), self.fmt)

    def create_all(
        self, star: str, builders: Mapping[str, Callable[[], DataFrame]], unique: Mapping[str, Sequence[str]] | None = None
    ) -> list[DataFrame]:
        """Create tables that do not depend on each other, several at a time; ``unique`` names key columns to check."""
        unique = unique or {}
        return together(*[partial(self.create, star, table, build, unique.get(table, ())) for table, build in builders.items()])

    def create(self, star: str, table: str, build: Callable[[], DataFrame], unique: Sequence[str] = ()) -> DataFrame:
        """Build and write a gold table unless it is complete, and read it back. A table whose ``unique`` columns repeat is
        an error, on every run, before anything is joined with it."""
        path = self.gold_path(star, table)
        if not is_complete(self.spark, path, self.fmt):
            write_new(build(), path, self.fmt, repair=self.repair)
        made = self.gold_table(star, table)
        return require_unique(made, unique) if unique else made


def bronze(layers: Layers) -> None:
    folders: dict[str, list[str]] = {}
    for table, spec in SILVER_TABLES.items():
        folders.setdefault(spec.folder, []).append(table)
    ingest(layers.spark, folders, layers.raw, layers.bronze, layers.fmt, repair=layers.repair, rejects_root=layers.rejects)


# Rows of the loss report: one per rule of a typed table.
LOSSES = "position int, column string, rule string, rows long, lost long"


def silver(layers: Layers, specs: Mapping[str, TableSpec] = SILVER_TABLES) -> None:
    """Typed tables, each with the number of values that its rules turned into NULL (see ``losses``)."""

    def build(table: str) -> None:
        spec, path = specs[table], layers.silver_path(table)
        if is_complete(layers.spark, path, layers.fmt):
            return
        raw = read_table(side_session(layers.spark), f"{layers.bronze}/{spec.folder}/{table}", fmt=layers.fmt)
        typed, lost = spec.build_counted(raw)
        # A sort by range reads its input twice, which would count everything twice: it gets the written table.
        if spec.cluster:
            write_clustered(staged(typed), path, spec.cluster, layers.fmt, repair=layers.repair)
        else:
            write_new(typed, path, layers.fmt, repair=layers.repair)
        found = lost.get
        counts = [(i, name, rule, found["rows"], found[str(i)]) for i, (name, rule) in enumerate(spec.rule_names())]
        write_replace(layers.spark.createDataFrame(counts, LOSSES).coalesce(1), f"{layers.losses}/table={table}", layers.fmt)

    together(*[partial(build, table) for table in specs])


def losses(layers: Layers) -> DataFrame:
    """(table, position, column, rule, rows, lost) for every rule of the typed tables."""
    return layers.spark.read.format(layers.fmt).schema(f"{LOSSES}, table string").load(layers.losses)


def cut_id_specs() -> dict[str, TableSpec]:
    """The silver rules with composite ids cut to ints; whole ids are the default."""
    return {**SILVER_TABLES, **{table: cut_ids(table) for table in COMPOSITE_IDS}}


def admission_star(layers: Layers, codes: Sequence[str] = ("icd_code", "icd_version")) -> None:
    table, star = layers.silver_table, ADMISSION_STAR
    sources = {"admissions": ["admittime", "dischtime"], "transfers": ["intime", "outtime"], "services": ["transfertime"]}
    _, patient, service, diagnosis = layers.create_all(
        star,
        {
            "dim_date": lambda: calendars.observed_calendar((table(name), cols) for name, cols in sources.items()),
            "dim_patient": lambda: layers.keyed(
                dims.numbered_patient_dim(table("patients")), star, "dim_patient", ["subject_id"], "patient_sk", hashed=False
            ),
            "dim_service": lambda: layers.keyed(
                dims.numbered_service_dim(table("services")), star, "dim_service", ["service_id"], "service_sk", hashed=False
            ),
            "dim_diagnosis": lambda: layers.keyed(
                dims.used_diagnosis_dim(table("diagnoses_icd"), table("d_icd_diagnoses"), codes),
                star, "dim_diagnosis", [*codes, "icd_description"], "diagnosis_sk", hashed=False,
            ),
        },
        # A patient who is there twice would double the facts.
        unique={"dim_patient": ["subject_id"]},
    )
    layers.create(
        star,
        "fact_admissions",
        lambda: facts.fact_admissions(
            table("admissions"), table("services"), table("diagnoses_icd"), patient, service, diagnosis, codes=codes
        ),
    )
    write_replace(
        facts.fact_transfers(table("transfers"), patient), layers.gold_path(star, "fact_transfers"), layers.fmt
    )
    layers.report_keys(star, {"fact_admissions": ["patient_sk", "service_sk", "diagnosis_sk"], "fact_transfers": ["patient_sk"]})


def icu_star(layers: Layers) -> None:
    table, star = layers.silver_table, ICU_STAR

    def calendar() -> DataFrame:
        found = read_available(layers.spark, ICU_DATE_SOURCES, root=f"{layers.silver}/", fmt=layers.fmt)
        if found.skipped:
            reasons = layers.spark.createDataFrame(list(found.skipped.items()), "source string, reason string").coalesce(1)
            write_replace(reasons, layers.gold_path(star, "skipped_sources"), layers.fmt)
        return calendars.week_calendar((df, df.columns) for df in found.used.values())

    date, patient, service = layers.create_all(
        star,
        {
            "dim_date": calendar,
            "dim_patient": lambda: dims.subject_dim(table("patients")),
            "dim_service": lambda: dims.first_service_dim(table("services")),
        },
    )
    layers.create(
        star,
        "fact_icu_monitoring",
        lambda: facts.fact_icu_monitoring(
            table("icustays"), table("admissions"), *[layers.event_table(e, key) for e, key in EVENT_KEYS.items()],
            patient, service, date,
        ),
    )


def coding_star(layers: Layers) -> None:
    table, star = layers.silver_table, CODING_STAR
    diagnosis, procedure, patient, admission, date = layers.create_all(
        star,
        {
            "dim_diagnosis": lambda: layers.keyed(
                dims.diagnosis_dim(table("d_icd_diagnoses")), star, "dim_diagnosis", ["icd_code", "icd_version"], "diagnosis_sk"
            ),
            "dim_procedure": lambda: layers.keyed(
                dims.procedure_dim(table("d_icd_procedures")), star, "dim_procedure", ["icd_code", "icd_version"], "procedure_sk"
            ),
            "dim_diagproc_patient": lambda: dims.patient_dim(table("patients")),
            "dim_diagproc_admission": lambda: dims.admission_dim(table("admissions")),
            "dim_diagproc_date": lambda: calendars.weekend_calendar(table("procedures_icd"), "chartdate"),
        },
        # Hashes of two columns could collide; with key tables they don't.
        unique={"dim_diagnosis": ["diagnosis_sk"], "dim_procedure": ["procedure_sk"]},
    )
    layers.create_all(
        star,
        {
            "fact_diagnosis": lambda: facts.fact_diagnosis(table("diagnoses_icd"), diagnosis, patient, admission),
            "fact_procedure": lambda: facts.fact_procedure(
                table("procedures_icd"), procedure, patient, admission, date
            ),
        },
    )


def medication_star(
    layers: Layers, on: Sequence[str] = ("emar_id", "emar_seq"), dates: tuple[str | None, str | None] = MEDICATION_DATES
) -> None:
    """The calendar covers ``dates`` and every day up to the first and the last administration, so no known date is without a key."""
    table, star = layers.silver_table, MEDICATION_STAR

    def calendar() -> DataFrame:
        bounds = calendars.extreme_dates(layers.spark, [(table("emar"), ["charttime"])], *dates)
        return calendars.range_calendar(bounds, "start", "end")

    date, patient, _, medication = layers.create_all(
        star,
        {
            "dim_date": calendar,
            "dim_patient": lambda: dims.subject_dim(table("patients")),
            "dim_service": lambda: dims.service_dim(table("services")),
            "dim_medication": lambda: layers.keyed(
                dims.medication_dim(table("emar_detail")), star, "dim_medication", ["drug_name", "route", "form"], "drug_sk"
            ),
        },
        unique={"dim_service": ["service_sk"], "dim_medication": ["drug_sk"]},
    )
    layers.create(
        star,
        "fact_medication_administration",
        lambda: facts.fact_medication_administration(
            table("emar_detail"), table("emar"), patient, medication, date, on=on
        ),
    )
    layers.report_keys(star, {"fact_medication_administration": ["subject_sk", "drug_sk", "date_sk"]})


# The features and scores of patients, and the models behind the scores, below the gold layer.
FEATURES, MODELS = "PatientFeatures", "models"


def feature_step(layers: Layers) -> None:
    table = layers.silver_table
    sources = ["icustays", "diagnoses_icd", "procedures_icd", "prescriptions", "admissions"]
    layers.create(
        FEATURES,
        "features",
        lambda: features.feature_table(
            table("patients"), *[table(name) for name in sources], [table("labevents"), table("chartevents")]
        ),
        unique=["subject_id"],
    )


def score_step(layers: Layers, clusters: int = 3) -> None:
    """Score every patient with the saved models, which are fitted once, on the first run; the risk is learned from patients with
    an admission, by whether one of these ended in death."""
    spark, names = layers.spark, features.FEATURES
    rows = layers.gold_table(FEATURES, "features")
    ended = layers.silver_table("admissions").groupBy("subject_id").agg(F.max("hospital_expire_flag").cast("double").alias("died"))
    models = f"{layers.gold}/{MODELS}"

    def fit_groups() -> PipelineModel:
        # k-means takes no more clusters than there are different patients.
        different = rows.select(*[f"`{n}`" for n in names]).distinct().limit(clusters).count()
        return scoring.fit_clusters(rows, names, different)

    groups = scoring.fit_once(spark, f"{models}/clusters", names, fit_groups)
    risk = scoring.fit_once(
        spark, f"{models}/risk", names, lambda: scoring.fit_risk(rows.join(ended, "subject_id").where("died IS NOT NULL"), names, "died")
    )
    scored = scoring.score_risk(risk, scoring.assign_clusters(groups, rows))
    scored = scored.select("subject_id", "cluster", "pc1", "pc2", "death", "death_probability")
    write_replace(scored, layers.gold_path(FEATURES, "scores"), layers.fmt)


# The gold tables of each registered star.
GOLD_TABLES = {
    ADMISSION_STAR: ["dim_date", "dim_diagnosis", "dim_patient", "dim_service", "fact_admissions", "fact_transfers"],
    ICU_STAR: ["dim_date", "dim_patient", "dim_service", "fact_icu_monitoring"],
    CODING_STAR: [
        "dim_diagnosis", "dim_procedure", "dim_diagproc_patient", "dim_diagproc_admission", "dim_diagproc_date",
        "fact_diagnosis", "fact_procedure",
    ],
}


def catalog(layers: Layers) -> None:
    """Register the three stars and the whole silver layer as external tables."""
    stars = {
        DATABASES[star]: {name: layers.gold_path(star, name) for name in names} for star, names in GOLD_TABLES.items()
    }
    typed = {table: layers.silver_path(table) for table in SILVER_TABLES}
    register_all(layers.spark, {**stars, SILVER_DATABASE: typed}, layers.fmt)


STEPS = ("bronze", "silver", "admissions", "icu", "coding", "medication", "features", "score", "catalog")


def refresh(
    layers: Layers,
    steps: Sequence[str] = STEPS,
    specs: Mapping[str, TableSpec] = SILVER_TABLES,
    codes: Sequence[str] = ("icd_code", "icd_version"),
    on: Sequence[str] = ("emar_id", "emar_seq"),
) -> None:
    """Everything from the raw files to the catalog, or the named steps, always in that order."""
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"no such step: {', '.join(sorted(unknown))}")
    run = {
        "bronze": lambda: bronze(layers),
        "silver": lambda: silver(layers, specs),
        "admissions": lambda: admission_star(layers, codes),
        "icu": lambda: icu_star(layers),
        "coding": lambda: coding_star(layers),
        "medication": lambda: medication_star(layers, on),
        "features": lambda: feature_step(layers),
        "score": lambda: score_step(layers),
        "catalog": lambda: catalog(layers),
    }
    with scratch_scope(layers.spark):
        for step in STEPS:
            if step in steps:
                run[step]()
