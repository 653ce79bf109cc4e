"""From sales rows to stored parameters, forecasts and scores."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.evaluation import evaluate, stamp
from shelfcast.operators.frame import HORIZON_DAYS
from shelfcast.operators.history import clean_history, colocate, of_series
from shelfcast.operators.sampled import sampled_horizon
from shelfcast.operators.seasonal import fit, predict, short_series
from shelfcast.schemas import EVALUATION, FORECAST_TABLE
from shelfcast.sources.settled import scratch, settle
from shelfcast.sources.tables import (
    from_table_rows,
    load_parameters,
    read_partition,
    save_parameters,
    store_short,
    write_evaluations,
    write_forecasts,
)


def run_forecast(
    sales: DataFrame,
    folder: str,
    training_date: datetime.date,
    evaluate_before: datetime.date,
    horizon: int = HORIZON_DAYS,
    as_float: bool = False,
    series: tuple[int, int] | None = None,
    partitions: int | None = None,
    draws: int = 0,
    start_from: datetime.date | None = None,
) -> None:
    """Train, predict and score every series; store the results under ``folder``.

    With ``series``, a store and an item, only that one is trained, and only its rows of
    the training date are replaced. Series seen on one day are forecast flat and listed in
    ``short_series``. ``partitions`` is the number of fitting tasks. With ``draws`` the band of
    the horizon is sampled, see ``sampled_horizon``; else it is the closed form.
    The searches begin with the stored model of the training date ``start_from``, if given.

    Each step reads what the step before it stored, so neither the daily sums nor a fit
    are ever repeated, also when executors are lost. The history serves both fit and
    prediction and is kept by series meanwhile; lost blocks are read from its table.
    """
    if horizon < 0:
        raise ValueError(f"the horizon must not be negative, but is {horizon}")
    spark = sales.sparkSession
    if series is not None:
        sales = of_series(sales, *series)
    start = None if start_from is None else load_parameters(spark, f"{folder}/parameters", start_from)
    with scratch(spark) as work:
        history = colocate(settle(clean_history(sales), work), partitions).persist()
        try:
            trained = settle(fit(history, start), work)
            save_parameters(trained, training_date, f"{folder}/parameters", series)
            short = short_series(trained)
            store_short(short, f"{folder}/short_series", training_date, series)
            forecast = predict(trained, history, 0 if draws else horizon)
            if draws:
                forecast = forecast.unionByName(sampled_horizon(trained, horizon, draws))
            forecast = stamp(forecast, training_date)
            write_forecasts(forecast, f"{folder}/forecasts", as_float, series)
        finally:
            history.unpersist()
    stored = stored_forecast(spark, folder, training_date)
    if series is not None:
        stored = of_series(stored, *series)
    scores = evaluate(stored, evaluate_before)
    write_evaluations(scores, f"{folder}/evaluations", as_float, series)


def run_prediction(
    spark: SparkSession,
    folder: str,
    trained_on: datetime.date,
    frame: DataFrame,
    horizon: int = HORIZON_DAYS,
) -> DataFrame:
    """Predict the dates of ``frame`` and the horizon from the stored model of a date."""
    return predict(load_parameters(spark, f"{folder}/parameters", trained_on), frame, horizon)


def store_prediction(
    spark: SparkSession, folder: str, trained_on: datetime.date, horizon: int = HORIZON_DAYS
) -> None:
    """Predict again from the stored model of a date, for the days that it saw and the horizon.

    Nothing is fitted. The rows go to ``predictions``, in the columns of the forecasts table.
    """
    observed = stored_forecast(spark, folder, trained_on).where("y IS NOT NULL")
    frame = observed.select("store", "item", "ds", "y")
    predicted = stamp(run_prediction(spark, folder, trained_on, frame, horizon), trained_on)
    write_forecasts(predicted, f"{folder}/predictions")


def scores_of(spark: SparkSession, folder: str, training_date: datetime.date) -> DataFrame:
    """Stored scores of one training date."""
    return read_partition(spark, f"{folder}/evaluations", EVALUATION, training_date)


def stored_forecast(spark, folder: str, training_date: datetime.date) -> DataFrame:
    """Forecast rows of one training date as ``run_forecast`` stored them."""
    path = f"{folder}/forecasts"
    return from_table_rows(read_partition(spark, path, FORECAST_TABLE, training_date))
