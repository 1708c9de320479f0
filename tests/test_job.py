from __future__ import annotations

import pytest

from lakestar import job, session
from lakestar.operators.keys import staged
from lakestar.plans import facts, refresh
from tests.helpers import rows
from tests.test_refresh import layers  # noqa: F401


def _roots(made, tmp_path):
    return [f"--raw={made.raw}", *[f"--{part}={tmp_path / part}" for part in ("bronze", "silver", "gold")]]


def test_each_step_runs_by_its_arguments(spark, layers, tmp_path):  # noqa: F811
    roots = _roots(layers, tmp_path)
    fresh = refresh.Layers(spark, layers.raw, *[str(tmp_path / part) for part in ("bronze", "silver", "gold")])
    job.main([*roots, "--step", "bronze"], spark)
    assert not (tmp_path / "silver").exists()
    job.main([*roots, "--step", "silver", "--keep-times"], spark)
    assert dict(fresh.silver_table("icustays").dtypes)["intime"] == "timestamp"
    assert dict(fresh.silver_table("emar").dtypes)["emar_id"] == "string"
    job.main([*roots, "--step", "icu"], spark)
    # 47 hours from 9:00 to 8:00 two days later, which whole days would make 48.
    assert rows(fresh.gold_table(refresh.ICU_STAR, "fact_icu_monitoring"), "stay_id", "icu_los_hours") == [(7, 47.0)]
    assert not (tmp_path / "gold" / refresh.MEDICATION_STAR).exists()
    job.main([*roots, "--step", "medication", "--on", "emar_id", "emar_seq"], spark)
    assert fresh.gold_table(refresh.MEDICATION_STAR, "fact_medication_administration").count() == 1


def test_cut_ids_need_the_number(spark):
    names = ["emar_seq", "route", "product_description", "product_unit", "dose_given", "administration_type"]
    detail = spark.createDataFrame([(10000001, *["x"] * 6)], f"emar_id int, {', '.join(f'{n} string' for n in names)}")
    with pytest.raises(ValueError, match="cut ids"):
        facts.fact_medication_administration(detail, detail, detail, detail, detail, on=["emar_id"])


def test_repeated_patients_and_colliding_keys_are_errors(spark, tmp_path):
    made = refresh.Layers(spark, *[str(tmp_path / part) for part in ("raw", "bronze", "silver", "gold")])
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "drug_sk int, drug_name string")
    for _ in range(2):
        with pytest.raises(ValueError, match="drug_sk is not unique"):
            made.create("star", "dim_medication", lambda: twice, ["drug_sk"])


def test_unknown_steps_are_refused(layers):  # noqa: F811
    with pytest.raises(ValueError, match="no such step: gold"):
        refresh.refresh(layers, steps=["gold"])


def test_scratch_scope_deletes_its_own_tables_only(spark):
    before = staged(spark.range(3))
    with pytest.raises(RuntimeError), session.scratch_scope(spark):
        inside = staged(spark.range(4))
        raise RuntimeError
    assert before.count() == 3
    with pytest.raises(Exception, match="NOT_EXIST|NOT_FOUND"):
        inside.count()
