"""One distributed Spark ML fit for all series, whatever their number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Rows with all features known, and their vector."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


def fit(frame: DataFrame, features: Sequence[str], target: str = "y", rounds: int = 20, depth: int = 3, rate: float = 0.1, validation: str | None = None, seed: int = 0) -> GBTRegressionModel:
    """Boosted trees on all rows; ``validation`` names a boolean column of rows that only decide when to stop."""
    learner = GBTRegressor(featuresCol="features", labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed)
    if validation:
        learner = learner.setValidationIndicatorCol(validation)
    return learner.fit(assemble(frame, features))


def predict(model: GBTRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    return model.transform(assemble(df, features)).drop("features")


def importance(model: GBTRegressionModel, spark, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
