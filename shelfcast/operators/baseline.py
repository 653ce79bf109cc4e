"""Linear trend times weekday factor, computed by Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.operators.frame import HORIZON_DAYS, unroll_horizon
from shelfcast.schemas import FORECAST

# Two-sided 95% point of the standard normal distribution.
Z95 = 1.959963984540054
# A trend value below this is taken as zero and gives no weekday ratio.
TINY_TREND = 1e-9

OVER_SERIES = "OVER (PARTITION BY store, item)"
TREND = "(intercept + slope * unix_date(ds))"
RATIO = f"CASE WHEN abs({TREND}) > {TINY_TREND}D THEN y / {TREND} END"
# Mean ratio of each weekday, Monday first.
FACTORS = ", ".join(
    f"coalesce(avg(CASE WHEN weekday(ds) = {day} THEN {RATIO} END) {OVER_SERIES}, 1D)"
    for day in range(7)
)
CENTER = f"{TREND} * get(factors, weekday(ds))"


def baseline_forecast(history: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Forecast rows for the observed days and the horizon of every series.

    Ordinary least squares gives the trend, the mean of sales over trend per weekday
    gives the factor, and the residual deviation gives the 95% band. A one-day series
    is flat, an unseen weekday has factor 1.

    All three steps are windows over the same series partitioning: the history is
    shuffled and sorted once and never joined to its own statistics.
    """
    fitted = history.selectExpr(
        "store",
        "item",
        "ds",
        "y",
        f"max(ds) {OVER_SERIES} AS last",
        f"coalesce(regr_slope(y, unix_date(ds)) {OVER_SERIES}, 0D) AS slope",
        f"coalesce(regr_intercept(y, unix_date(ds)) {OVER_SERIES}, avg(y) {OVER_SERIES})"
        " AS intercept",
    )
    weighted = fitted.selectExpr("*", f"array({FACTORS}) AS factors")
    spread = weighted.selectExpr(
        "*", f"{Z95}D * coalesce(stddev_samp(y - {CENTER}) {OVER_SERIES}, 0D) AS band"
    )
    center = unroll_horizon(spread, horizon).selectExpr("*", f"{CENTER} AS yhat")
    return center.selectExpr(
        "ds", "store", "item", "y", "yhat", "yhat + band AS yhat_upper", "yhat - band AS yhat_lower"
    ).to(FORECAST)
