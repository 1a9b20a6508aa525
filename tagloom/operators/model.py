"""Species calls by a model over profile features (survey L1, L2).

No trained model comes with the library: fit one here on labelled rows, or bring a callable.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import extended

FEATURES = ("ln_coverage", "ln_g", "ln_depth", "ln_share")


def fit_forest(features: DataFrame, label: str, trees: int = 50, seed: int = 7, names: tuple[str, ...] = FEATURES) -> PipelineModel:
    """L1: a random forest on rows with all features and a 0/1 label; training is distributed."""
    rows = features.where(F.col(label).isNotNull()).na.drop(subset=list(names)).withColumn(label, F.col(label).cast("double"))
    assembler = VectorAssembler(inputCols=list(names), outputCol="_features")
    forest = RandomForestClassifier(labelCol=label, featuresCol="_features", numTrees=trees, seed=seed, probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r")
    return Pipeline(stages=[assembler, forest]).fit(rows)


def predict_forest(model: PipelineModel, features: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """L1: ``prob`` and ``pred`` for rows with all features; others are left out."""
    out = model.transform(features.na.drop(subset=list(names)))
    return out.withColumns({"prob": vector_to_array("_p")[1], "pred": F.col("_y").cast("int")}).drop("_features", "_p", "_y", "_r")


def predict_with(predict: Callable[[pd.DataFrame], pd.Series], features: DataFrame, names: tuple[str, ...] = FEATURES, least: float = 0.5) -> DataFrame:
    """L1: the same with a callable that gives a probability for a batch of features."""
    rows = features.na.drop(subset=list(names))
    schema = extended(rows, "prob double, pred int")

    def run(frames):
        for pdf in frames:
            prob = pd.Series(predict(pdf[list(names)]), index=pdf.index, dtype="float64")
            yield pdf.assign(prob=prob, pred=(prob >= least).astype("int32"))

    return rows.mapInPandas(run, schema)


def spread_to_subspecies(merged: DataFrame, members: DataFrame, sample: str = "sample") -> DataFrame:
    """L2: each sub-species row (sample, species, merged) with the call of its merged name."""
    return members.join(merged.select(sample, "merged", "prob", "pred"), [sample, "merged"])
