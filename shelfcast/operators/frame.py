"""Dates to predict: the observed days and the horizon after them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.schemas import SERIES

# Days to predict, and the plotted span of 455 days that ends with them.
HORIZON_DAYS = 90
PLOT_DAYS_BACK = 454


def by_series():
    """Window over a whole series, which holds one row per day at most."""
    return Window.partitionBy(*SERIES)


def unroll_horizon(rows: DataFrame, horizon: int) -> DataFrame:
    """Follow the row with ``ds = last`` by ``horizon`` days whose ``y`` is NULL.

    The extra days grow out of the last row where it lies, so no second pass over the
    history, no union and no join are needed.
    """
    if horizon < 0:
        raise ValueError(f"the horizon must not be negative, but is {horizon}")
    kept = [name for name in rows.columns if name not in ("ds", "y", "last")]
    ahead = rows.selectExpr("*", f"explode(sequence(0, if(ds = last, {horizon}, 0))) AS ahead")
    return ahead.selectExpr(
        *kept, "date_add(ds, ahead) AS ds", "CASE WHEN ahead = 0 THEN y END AS y"
    )


def extended_history(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """``store, item, ds, y`` for observed days and the horizon. Gaps stay gaps."""
    last = history.select("store", "item", "ds", "y", F.max("ds").over(by_series()).alias("last"))
    return unroll_horizon(last, horizon)


def future_frame(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """``store, item, ds`` for observed days and the horizon."""
    return extended_history(history, horizon).select("store", "item", "ds")


def recent_days(forecast: DataFrame, days_back: int = PLOT_DAYS_BACK) -> DataFrame:
    """The forecast rows worth plotting: the horizon and about one year before it."""
    newest = F.max("ds").over(by_series())
    return (
        forecast.withColumn("newest", newest)
        .where(F.col("ds") >= F.date_sub("newest", days_back))
        .drop("newest")
    )
