"""Linear model of the trip price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame

FEATURES = ("trip_distance", "trip_duration_minutes")
LABEL = "total_amount"


def fit_linear(df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL) -> tuple[LinearRegressionModel, DataFrame]:
    """Fit by normal equations (one distributed pass) and predict the same rows."""
    rows = df.dropna(subset=[*features, label])
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(assembled)
    return model, model.transform(assembled).select(*features, label, "prediction")
