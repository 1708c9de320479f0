from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakestar.plans import features, scoring
from tests.helpers import rows


@pytest.fixture(scope="module")
def table(spark):
    patients = spark.createDataFrame([(1, "Male", 40), (2, "Female", 50), (3, None, None), (None, "Male", 60)], "subject_id int, gender string, anchor_age int")
    stays = spark.createDataFrame([(1, "2020-01-01", "2020-01-03"), (1, "2020-02-01", "2020-02-02")], "subject_id int, a string, b string")
    stays = stays.select("subject_id", F.col("a").cast("date").alias("intime"), F.col("b").cast("date").alias("outtime"))
    many = spark.createDataFrame([(1,), (1,), (2,)], "subject_id int")
    labs = spark.createDataFrame([(1, 50912, 1.0), (1, 50912, 2.0), (1, 7, 9.0), (2, 50809, None)], "subject_id int, itemid int, valuenum double")
    chart = spark.createDataFrame([(1, 220045, 80.0)], "subject_id int, itemid int, valuenum double")
    return features.feature_table(patients, stays, many, many, many, many, [labs, chart])


def test_feature_order_is_fixed(table):
    assert table.columns == ["subject_id", *features.FEATURES]
    assert len(features.FEATURES) == 17
    assert {f.dataType.typeName() for f in table.schema.fields[1:]} == {"double"}


def test_feature_values(table):
    assert rows(table, "subject_id", "anchor_age", "gender", "icu_los", "num_drugs", "50912", "50809", "220045") == [
        (None, 60.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0),
        (1, 40.0, 1.0, 3.0, 2.0, 1.5, 0.0, 80.0), (2, 50.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0),
        (3, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


@pytest.fixture(scope="module")
def points(spark):
    """Two clouds far apart; the second one dies."""
    side = (F.col("id") % 2).cast("double")
    return spark.range(60).select("id", (side * 100 + F.col("id") % 7).alias("x"), (side * 50 + F.col("id") % 5).alias("y"), side.alias("died"))


def test_scaling(points):
    out = scoring.scale(scoring.fit_scaler(points, ["x", "y"]), points, ["x", "y"])
    mean, std = out.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert abs(mean) < 1e-9 and abs(std - 1) < 1e-9
    assert out.columns == ["id", "died", "x", "y"]


def test_clusters_and_projection(points, tmp_path):
    from pyspark.ml import PipelineModel

    model = scoring.fit_clusters(points, ["x", "y"], k=2)
    model.write().save(str(tmp_path / "model"))
    out = scoring.assign_clusters(PipelineModel.load(str(tmp_path / "model")), points)
    assert out.columns == [*points.columns, "cluster", "pc1", "pc2"]
    assert out.groupBy("died").agg(F.countDistinct("cluster").alias("n")).filter("n > 1").count() == 0
    assert out.select("cluster").distinct().count() == 2
    spread = out.agg(F.var_samp("pc1"), F.var_samp("pc2")).first()
    assert spread[0] > spread[1]


def test_risk(points):
    out = scoring.score_risk(scoring.fit_risk(points, ["x", "y"], "died", trees=5), points)
    assert out.columns == [*points.columns, "death", "death_probability"]
    assert out.filter("death != died").count() == 0
    assert out.filter("(death = 1) != (death_probability > 0.5)").count() == 0
