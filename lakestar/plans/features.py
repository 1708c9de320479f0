"""Feature table: one row of seventeen numbers per patient."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakestar.functions.dates import seconds_between
from lakestar.operators.unions import union_all

# The features and their order. The names that are numbers are measured items.
BASE_FEATURES = ["anchor_age", "gender", "icu_los", "num_diagnoses", "num_procedures", "num_drugs", "num_admissions"]
ITEM_FEATURES = ["50912", "50809", "51516", "50811", "220045", "220050", "220051", "220210", "223762", "220277"]
FEATURES = BASE_FEATURES + ITEM_FEATURES

SECONDS_PER_DAY = 86_400


def encode_gender(gender: Column, male: str = "Male") -> Column:
    """1 for male, 0 for everything else, unknown included."""
    return F.when(gender == male, 1.0).otherwise(0.0)


def _tagged(df: DataFrame, slot: int | Column, **columns: Column) -> DataFrame:
    tag = slot if isinstance(slot, Column) else F.lit(slot)
    return df.select("subject_id", tag.cast("int").alias("_slot"), *[c.alias(name) for name, c in columns.items()])


def feature_table(
    patients: DataFrame,
    icustays: DataFrame,
    diagnoses: DataFrame,
    procedures: DataFrame,
    prescriptions: DataFrame,
    admissions: DataFrame,
    measurements: Sequence[DataFrame],
    items: Sequence[object] = tuple(int(item) for item in ITEM_FEATURES),
) -> DataFrame:
    """Features of each patient; what was never recorded is 0. ``icu_los`` is the sum of the stays in days.

    All sources are one union, each row tagged with the slot of the feature that it counts for, and one aggregation, so rows are
    reduced in the tasks that read them and what is left is shuffled once. Scans of measurements read the wanted items
    alone. A patient who is there more than once is one row, with the highest age and male if any of the rows is;
    patients without an id each keep a row, without events.
    """
    person = patients.select("subject_id", F.col("anchor_age").cast("double").alias("_age"), encode_gender(F.col("gender")).alias("_male"))
    wanted = union_all([m.select("subject_id", "itemid", "valuenum").filter(F.col("itemid").isin(*items)) for m in measurements])
    counted = {"num_diagnoses": diagnoses, "num_procedures": procedures, "num_drugs": prescriptions, "num_admissions": admissions}
    names = [*BASE_FEATURES, *[str(item) for item in items]]
    slots = {name: i for i, name in enumerate(names)}
    item_slot = F.coalesce(*[F.when(F.col("itemid") == item, F.lit(slots[str(item)])) for item in items])
    parts = [
        _tagged(person.where("subject_id IS NOT NULL"), slots["anchor_age"], _age=F.col("_age"), _male=F.col("_male")),
        _tagged(icustays, slots["icu_los"], _seconds=seconds_between(F.col("intime"), F.col("outtime"))),
        *[_tagged(df, slots[name]) for name, df in counted.items()],
        _tagged(wanted, item_slot, valuenum=F.col("valuenum")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)

    def of(slot: str, aggregate: str) -> Column:
        # A filtered aggregate is left alone by the rows of all other slots, which a conditional value is not.
        return F.expr(f"{aggregate} FILTER (WHERE _slot = {slots[slot]})")

    age = "anchor_age"
    aggregates = [of(age, "count(*)").alias("_patients"), of(age, "max(_age)").alias(age), of(age, "max(_male)").alias("gender")]
    aggregates.append((of("icu_los", "sum(_seconds)") / SECONDS_PER_DAY).alias("icu_los"))
    aggregates += [of(name, "count(*)").cast("double").alias(name) for name in counted]
    aggregates += [F.try_divide(of(n, "sum(valuenum)").cast("double"), of(n, "count(valuenum)")).alias(n) for n in names[len(BASE_FEATURES) :]]
    found = rows.where("subject_id IS NOT NULL").groupBy("subject_id").agg(*aggregates).where("_patients > 0")
    nameless = person.where("subject_id IS NULL").select("subject_id", F.col("_age").alias("anchor_age"), F.col("_male").alias("gender"))
    whole = found.drop("_patients").unionByName(nameless, allowMissingColumns=True)
    return whole.select("subject_id", *[F.col(f"`{name}`") for name in names]).fillna(0.0, names)
