"""Boosted-tree training, prediction and artefacts on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.operators.metrics import evaluate
from pacewatch.operators.oversample import smote
from pacewatch.operators.split import time_split
from pacewatch.schema import GBT_PARAMS, MODEL_COLUMNS
from pacewatch.session import use_checkpoints

_INTERNAL = ["_features", "_raw", "_probability", "_prediction"]


def assemble(df: DataFrame, features: Sequence[str] = MODEL_COLUMNS) -> DataFrame:
    """Model inputs as doubles, missing ones 0; other columns pass through."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def train(
    df: DataFrame,
    params: Mapping[str, object] | None = None,
    features: Sequence[str] = MODEL_COLUMNS,
    label: str = "is_fraud",
) -> PipelineModel:
    """Fit boosted trees. ``params`` override single defaults.

    Boosting passes over its input several times per tree, so the input is written to
    the checkpoint folder once: neither a pass nor a lost executor then replays the
    feature and oversampling plans behind it. Every tenth tree the running predictions
    go there too.
    """
    use_checkpoints(df.sparkSession)
    settings = {**GBT_PARAMS, "checkpointInterval": 10, **(params or {})}
    vector = VectorAssembler(inputCols=list(features), outputCol="_features")
    trees = GBTClassifier(
        featuresCol="_features",
        labelCol=label,
        predictionCol="_prediction",
        **settings,
    )
    trees.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    table = assemble(df.select(*features, F.col(label).cast("double").alias(label)), features)
    return Pipeline(stages=[vector, trees]).fit(table.checkpoint())


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` of the positive class."""
    features = model.stages[0].getInputCols()
    scored = model.transform(assemble(df, features))
    return scored.withColumn("probability", vector_to_array("_probability")[1]).drop(*_INTERNAL)


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, importance), one row per model input."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, weights)), "feature string, importance double")


def top_importances(model: PipelineModel, spark: SparkSession, n: int = 10) -> DataFrame:
    return importances(model, spark).orderBy(F.col("importance").desc(), "feature").limit(n)


def run_training(
    features_table: DataFrame,
    path: str,
    params: Mapping[str, object] | None = None,
    features: Sequence[str] = MODEL_COLUMNS,
) -> tuple[PipelineModel, DataFrame]:
    """The whole training step: split by time, oversample the training side, fit, evaluate on the
    untouched later side, and save model, parameters, metrics and importances under ``path``.

    Returns the model and its (metric, value) rows.
    """
    train_side, test_side = time_split(features_table)
    fitted = train(smote(train_side, features), params, features)
    report = evaluate(predict(fitted, test_side)).checkpoint()
    save_run(path, fitted, report, {**GBT_PARAMS, **(params or {})})
    return fitted, report


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_run(
    path: str,
    model: PipelineModel,
    metrics: DataFrame,
    params: Mapping[str, object],
) -> None:
    """Model, parameters, metrics and importances of one training run under ``path``."""
    spark = metrics.sparkSession
    save_model(model, f"{path}/model")
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    importances(model, spark).coalesce(1).write.mode("overwrite").json(f"{path}/importances")
    rows = [(name, json.dumps(value)) for name, value in sorted(params.items())]
    table = spark.createDataFrame(rows, "name string, value string")
    table.coalesce(1).write.mode("overwrite").json(f"{path}/params")
