"""Scores of forecasts against observed sales."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.errors import (
    mean_absolute_error,
    mean_squared_error,
    root_mean_squared_error,
)
from shelfcast.operators.history import of_series


def stamp(rows: DataFrame, training_date: datetime.date) -> DataFrame:
    """Mark rows with the day of training, given by the caller so that reruns agree."""
    return rows.withColumn("training_date", F.lit(training_date).cast("date"))


def with_actuals(predictions: DataFrame, history: DataFrame) -> DataFrame:
    """Attach the observed ``y`` to predictions; days not observed get NULL."""
    return predictions.drop("y").join(
        history.select("store", "item", "ds", "y"), ["store", "item", "ds"], "left"
    )


def evaluate(forecast: DataFrame, before: datetime.date) -> DataFrame:
    """MAE, MSE and RMSE per training date and series over days earlier than ``before``.

    The scores are in-sample, as the model saw those days. Days without an observed
    ``y`` do not count.
    """
    return (
        forecast.where(F.col("ds") < F.lit(before))
        .groupBy("training_date", "store", "item")
        .agg(
            mean_absolute_error("y", "yhat").alias("mae"),
            mean_squared_error("y", "yhat").alias("mse"),
            root_mean_squared_error("y", "yhat").alias("rmse"),
        )
    )


def evaluate_single(
    forecast: DataFrame, store: int, item: int, before: datetime.date
) -> DataFrame:
    """Scores of one series."""
    return evaluate(of_series(forecast, store, item), before)
