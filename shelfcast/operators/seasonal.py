"""Seasonal growth model: fits of many series at once in Python, everything else in Spark.

Spark gathers a series into one row, and Python fits a batch of rows and returns a parameter
row for each, so it sees each daily total once and hands back under a kilobyte a series. Dates,
predictions, bounds and scores are Spark columns over those rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import curve, curves
from shelfcast.functions.season import (
    DAY_NUMBER,
    SCALED_TIME,
    SEASONALITY,
    TREND,
    TREND_VARIANCE,
    ready_to_predict,
)
from shelfcast.operators.baseline import Z95
from shelfcast.operators.frame import HORIZON_DAYS, unroll_horizon
from shelfcast.operators.history import colocate
from shelfcast.schemas import FORECAST, PARAMETERS, SERIES

# Ship the fit inside the task, so that executors need not have this package installed.
for _module in (curve, curves):
    cloudpickle.register_pickle_by_value(_module)

# Series with fewer days are forecast flat and reported.
MIN_POINTS = 2
ARROW_TYPES = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "double": pa.float64(),
    "array<double>": pa.list_(pa.float64()),
}


def fit(history: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """One parameter row per series. A series seen on one day gets a flat line.

    A series is one row of daily totals, at most one for each calendar day however many sales
    were summed into it. Colocate the history first, so that the number of fitting tasks does
    not depend on its size in bytes; a history that lies by series is not moved again. Series
    of the same number of days that arrive together are fitted together, see ``curves``.

    ``start`` has parameters of an earlier fit, of any days and of some of the series, one row
    for each at most. They begin the search of their series, which takes the fewer rounds to
    the same curve the newer they are; series of few days are begun anew (``DAYS_TO_START``).
    They move to the history, which stays where it is.
    """
    fit_curves = curves.fit_curves
    # Day numbers travel to Python and back as plain integers, dates would become objects.
    total = F.struct(F.unix_date("ds").alias("day"), F.col("y").cast("double").alias("y"))
    series = history.groupBy(*SERIES).agg(F.array_sort(F.collect_list(total)).alias("days"))
    if start is not None:
        series = series.join(_starts(start), list(SERIES), "left")
    columns = {
        field.name: "int" if field.name.endswith("_ds") else field.dataType.simpleString()
        for field in PARAMETERS
    }
    arrow_schema = pa.schema([(name, ARROW_TYPES[kind]) for name, kind in columns.items()])

    def fit_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = batch.column(2)
        flat, cuts = listed.flatten(), np.cumsum(listed.value_lengths().to_numpy())[:-1]
        day, y = (flat.field(at).to_numpy(zero_copy_only=False).astype("float64") for at in (0, 1))
        days = np.split(day, cuts)
        starts = batch.column(3).to_pylist() if batch.num_columns > 3 else None
        rows = fit_curves(days, np.split(y, cuts), starts)
        for row, store, item, one in zip(rows, *(batch.column(at).to_pylist() for at in (0, 1)), days):
            row.update(store=store, item=item, first_ds=int(one[0]), last_ds=int(one[-1]))
        return pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (fit_batch(batch) for batch in batches if batch.num_rows)

    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    fitted = series.mapInArrow(run, schema)
    dates = {name: F.date_from_unix_date(name) for name in ("first_ds", "last_ds")}
    return fitted.withColumns(dates)


def _starts(parameters: DataFrame) -> DataFrame:
    """``store, item, start``: models with days as numbers."""
    numbers = [F.unix_date(name).alias(name) for name in ("first_ds", "last_ds")]
    same = ("points", "scale", "slope", "level", "changepoints", "deltas", "season")
    return parameters.select(*SERIES, F.struct(*numbers, *same).alias("start"))


SHORT_REASON = "fewer than two days of history"


def skipped_series(rows: DataFrame, day: str = "ds") -> DataFrame:
    """Series with one day of history, which are forecast flat, with the reason.

    Works on sales as on daily totals: first and last day are found before the shuffle.
    """
    days = rows.groupBy(*SERIES).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return days.where("first = last").select(
        *SERIES, F.lit(1).alias("points"), F.lit(SHORT_REASON).alias("reason")
    )


def short_series(parameters: DataFrame) -> DataFrame:
    """The same report from the parameters of a training run."""
    return parameters.where(F.col("points") < MIN_POINTS).select(
        *SERIES, "points", F.lit(SHORT_REASON).alias("reason")
    )


def predict(parameters: DataFrame, frame: DataFrame, horizon: int = 0) -> DataFrame:
    """Prediction with a 95% band for every row of ``frame`` whose series was fitted.

    ``frame`` has ``store, item, ds`` and may have ``y``, which is passed on. ``horizon``
    days follow the last day that the model saw, if the frame has it: they grow out of
    that row after the join, so the frame needs no window and no second sort. A frame that
    already lies by series is not moved. The join is left to Spark, which broadcasts
    parameters of a known small size and otherwise merges sorted sides that can spill.
    """
    rows = frame if "y" in frame.columns else frame.withColumn("y", F.lit(None).cast("double"))
    ready = ready_to_predict(parameters).withColumnRenamed("last_ds", "last")
    rows = unroll_horizon(rows.join(ready, list(SERIES)), horizon)
    placed = rows.selectExpr("*", SCALED_TIME, DAY_NUMBER)
    parts = placed.selectExpr(
        "ds",
        "store",
        "item",
        "y",
        "scale",
        "sigma",
        f"{TREND} AS trend",
        f"1 + {SEASONALITY} AS growth",
        f"{TREND_VARIANCE} AS variance",
    )
    banded = parts.selectExpr(
        "*",
        "scale * trend * growth AS yhat",
        f"{Z95}D * scale * sqrt(sigma * sigma + growth * growth * variance) AS band",
    )
    return banded.selectExpr(
        "ds", "store", "item", "y", "yhat", "yhat + band AS yhat_upper", "yhat - band AS yhat_lower"
    ).to(FORECAST)


def forecast(
    history: DataFrame, horizon: int = HORIZON_DAYS, partitions: int | None = None
) -> DataFrame:
    """Fit every series and predict its observed days and the horizon.

    Fit and prediction read the same partitioning of the history, so it is shuffled
    once and Spark reuses that exchange.
    """
    together = colocate(history, partitions)
    return predict(fit(together), together, horizon)
