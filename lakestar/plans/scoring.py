"""Clusters, a two-dimensional projection and a risk score for every row of a feature table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakestar.sources.tables import is_complete, read_table, write_new


def _scaled(features: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
    ]


def _drop_vectors(df: DataFrame) -> DataFrame:
    return df.drop("_raw", "_scaled", "_pc", "_votes", "_probability", "_prediction")


def fit_scaler(df: DataFrame, features: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=_scaled(features)).fit(df)


def scale(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace each feature by its standard score."""
    scores = vector_to_array(F.col("_scaled"))
    others = [c for c in df.columns if c not in features]
    return model.transform(df).select(*others, *[scores[i].alias(name) for i, name in enumerate(features)])


def fit_clusters(df: DataFrame, features: Sequence[str], k: int = 3, seed: int = 42) -> PipelineModel:
    """Scaler, k-means and projection to two principal components."""
    stages = [
        *_scaled(features),
        KMeans(featuresCol="_scaled", predictionCol="cluster", k=k, seed=seed),
        PCA(k=2, inputCol="_scaled", outputCol="_pc"),
    ]
    return Pipeline(stages=stages).fit(df)


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add cluster, pc1 and pc2."""
    point = vector_to_array(F.col("_pc"))
    scored = model.transform(df).withColumns({"pc1": point[0], "pc2": point[1]})
    return _drop_vectors(scored)


def fit_risk(df: DataFrame, features: Sequence[str], label: str, trees: int = 20, seed: int = 42) -> PipelineModel:
    """Scaler of its own and a random forest for a 0/1 label; a forest of one tree learns from all rows, not from a draw."""
    forest = RandomForestClassifier(
        featuresCol="_scaled", labelCol=label, numTrees=trees, seed=seed, bootstrap=trees > 1,
        rawPredictionCol="_votes", probabilityCol="_probability", predictionCol="_prediction",
    )
    return Pipeline(stages=[*_scaled(features), forest]).fit(df)


def score_risk(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the predicted class, ``death``, and the probability of class 1, ``death_probability``."""
    scored = model.transform(df).withColumns(
        {
            "death": F.col("_prediction").cast("int"),
            "death_probability": vector_to_array(F.col("_probability"))[1],
        }
    )
    return _drop_vectors(scored)


# Saved models


def save_model(spark: SparkSession, model: PipelineModel, path: str, features: Sequence[str]) -> None:
    """Save a fitted pipeline with the features that it takes, in their order. The list is written last: a model without it is
    none."""
    model.write().overwrite().save(f"{path}/model")
    listed = spark.createDataFrame(list(enumerate(features)), "position int, feature string").coalesce(1)
    write_new(listed, f"{path}/features", repair=True)


def load_model(spark: SparkSession, path: str, features: Sequence[str]) -> PipelineModel:
    """A saved pipeline, or an error if it was fitted on other features or on the same ones in another order."""
    stored = [r["feature"] for r in read_table(spark, f"{path}/features").orderBy("position").collect()]
    if stored != list(features):
        raise ValueError(f"the model in {path} takes {', '.join(stored)}, not {', '.join(features)}")
    return PipelineModel.load(f"{path}/model")


def fit_once(spark: SparkSession, path: str, features: Sequence[str], fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model saved in ``path``, fitted and saved before if there is none yet; it is always the saved one that is used."""
    if not is_complete(spark, f"{path}/features"):
        save_model(spark, fit(), path, features)
    return load_model(spark, path, features)


# Quality of scores


def area_under_curve(df: DataFrame, score: str, label: str, bins: int = 10_000) -> DataFrame:
    """(positives, negatives, area): the share of pairs of a positive and a negative in which the positive scores higher.

    Scores from 0 to 1 are counted in ``bins`` equal steps, and a pair in one step counts half. The rows are aggregated to one
    per step; what goes on from there has at most ``bins`` rows. Rows without a score or a label don't count; without
    positives or without negatives the area is NULL.
    """
    step = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counted = rows.groupBy(step.alias("_step")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    below = F.coalesce(F.sum("_n").over(Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = counted.withColumn("_won", F.col("_p") * (below + F.col("_n") / 2))
    total = won.agg(F.coalesce(F.sum("_p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("_n"), F.lit(0)).alias("negatives"), F.sum("_won").alias("_won"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return total.select("positives", "negatives", F.try_divide(F.col("_won"), pairs).alias("area"))


def cluster_quality(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """(cluster, members, silhouette): how much nearer members are to their own cluster than to the next one, from -1 to 1, on
    average, by mean squared distances.

    A mean squared distance to a cluster follows from the cluster's size, sum and sum of squares, so no pair of rows meets: one
    aggregation gives these numbers (a row per cluster, which the driver sees), one scan applies them. A cluster's only
    member has 0, and so have all where there is only one cluster.
    """
    columns = [F.col(f"`{f}`").cast("double") for f in features]
    square = sum((c * c for c in columns[1:]), columns[0] * columns[0])
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)]
    groups = df.groupBy(F.col(cluster).alias("_c")).agg(F.count("*").alias("n"), F.sum(square).alias("q"), *sums).collect()

    def total_to(g) -> Column:
        """Sum of the squared distances from the row to all members."""
        dot = sum((c * g[f"s{i}"] for i, c in enumerate(columns[1:], 1)), columns[0] * g["s0"])
        return square * g["n"] - 2 * dot + g["q"]

    own, others = F.lit(None).cast("double"), []
    for g in groups:
        same = F.col(cluster).eqNullSafe(F.lit(g["_c"]))
        own = F.when(same, F.try_divide(total_to(g), F.lit(g["n"] - 1))).otherwise(own)
        others.append(F.when(~same, total_to(g) / g["n"]))
    if len(others) < 2:
        return df.groupBy(cluster).agg(F.count("*").alias("members"), F.lit(0.0).alias("silhouette"))
    next_ = F.least(*others)
    score = F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    scored = df.select(F.col(cluster), own.alias("_a"), next_.alias("_b")).select(cluster, F.when(F.col("_a").isNull(), 0.0).otherwise(score).alias("_s"))
    return scored.groupBy(cluster).agg(F.count("*").alias("members"), F.avg("_s").alias("silhouette"))
