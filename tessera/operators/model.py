"""Pair classifiers: gradient-boosted trees of pyspark.ml with the parameters of each mode."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.features import MODE_A, MODE_B, MODE_D

# Trees, learning rate, depth, least rows of a leaf, shares of rows and columns of each mode.
SETTINGS = {"A": (500, 0.03, 6, 50, 0.8, "0.8"), "B": (300, 0.05, 6, 20, 0.8, "0.8"), "D": (300, 0.05, 6, 20, 1.0, "all")}
FEATURES = {"A": MODE_A, "B": MODE_B, "D": MODE_D}
SEED = 42


def train(pairs: DataFrame, mode: str = "A", trees: int | None = None, rate: float | None = None, weight: str | None = None) -> PipelineModel:
    """A model from feature columns and label. Trees grow by level, without penalties on leaves, so thresholds must be searched anew.

    weight: a column that says for how many equal pairs each stands. The least rows of a leaf then are the least weight of one;
    a tree draws its share of rows with all of their weight.
    """
    most, usual, depth, leaf, rows, columns = SETTINGS[mode]
    trees = GBTClassifier(maxIter=trees or most, stepSize=rate or usual, maxDepth=depth, minInstancesPerNode=leaf, subsamplingRate=rows, featureSubsetStrategy=columns, seed=SEED, labelCol="label")
    if weight:
        total = pairs.agg(F.coalesce(F.sum(weight), F.lit(0.0))).first()[0]
        # Weights are whole numbers; a share of one half or more, which no split can meet twice, is not allowed.
        trees.setParams(weightCol=weight, minInstancesPerNode=1, minWeightFractionPerNode=min((leaf - 0.5) / max(total, 1.0), 0.4999999))
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES[mode]), outputCol="features"), trees]).fit(pairs)


def scored(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """pairs with probability, of label 1. Missing feature columns are an error."""
    lacking = [c for c in model.stages[0].getInputCols() if c not in pairs.columns]
    if lacking:
        raise ValueError(f"features are missing: {', '.join(lacking)}")
    got = model.transform(pairs).withColumn("probability", F.round(vector_to_array("probability")[1], 6))
    return got.drop("features", "rawPrediction", "prediction")


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    names = model.stages[0].getInputCols()
    return sorted(zip(names, model.stages[1].featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def save(model: PipelineModel, threshold: float, path: str, spark: SparkSession) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(threshold, list(model.stages[0].getInputCols()))], "threshold double, feature_names array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def load(path: str, spark: SparkSession) -> tuple[PipelineModel, float, list[str]]:
    row = spark.read.schema("threshold double, feature_names array<string>").json(f"{path}/settings").first()
    return PipelineModel.load(f"{path}/model"), row["threshold"], row["feature_names"]
