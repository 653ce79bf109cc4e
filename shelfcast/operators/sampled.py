"""Bands of the horizon from sampled trend changes instead of the closed form.

A draw is one way the series may go on: on each day to come the slope changes with the rate
seen so far, by a Laplace number of the mean size seen so far, and the day's noise is normal.
The band is what lies between two percentiles of the draws. All numbers of a draw come from a
hash of series, draw and day, so that reruns agree on any cluster and in any order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.season import (
    DAY_NUMBER,
    SCALED_TIME,
    SEASONALITY,
    TREND,
    ready_to_predict,
)
from shelfcast.operators.frame import HORIZON_DAYS
from shelfcast.operators.history import colocate
from shelfcast.schemas import FORECAST, SERIES

DRAWS = 1000
# Ends of the 95% band.
LOWER, UPPER = 0.025, 0.975

# Hexadecimal digits of the hash that make the numbers of a draw and day: first and count.
DIGITS = {"chance": (1, 13), "radius": (14, 10), "angle": (24, 9)}
HASH = "md5(concat_ws(':', store, item, draw, unix_date(ds)))"
# The part of the chance below the rate is uniform again, and makes the size of the change.
SIDE = "chance / rate - 0.5D"
CHANGE = (
    f"if(chance < rate, -mean * sign({SIDE}) * ln(greatest(1D - 2D * abs({SIDE}), 1e-300D)), 0D)"
)
NOISE = "sigma * sqrt(-2D * ln(radius)) * cos(6.283185307179586D * angle)"


def _uniform(name: str) -> str:
    """A number above 0 and below 1."""
    first, count = DIGITS[name]
    whole = f"double(conv(substr(hash, {first}, {count}), 16, 10))"
    return f"({whole} + 0.5D) / {16**count}D AS {name}"


def sampled_horizon(
    parameters: DataFrame,
    horizon: int = HORIZON_DAYS,
    draws: int = DRAWS,
    partitions: int | None = None,
) -> DataFrame:
    """The days after each model's last one, in the columns of a forecast with ``y`` NULL.

    ``yhat`` is the curve, as in ``predict``; the bounds are percentiles of ``draws`` draws, by
    linear interpolation. At most one change falls on a day. Without changes the band differs
    from the closed form by sampling alone, a few percent of its width at 1,000 draws; where
    changes decide, its shape differs too, as few large changes are not normal. A series seen
    on one day has no width.

    Only parameter rows are exchanged. Draws grow out of them where they lie, and both the sums
    along a draw and the percentiles of a day keep that partitioning, so that nothing of the
    size of ``series * draws * horizon`` moves. A series is at most ``draws * horizon`` rows.
    """
    if horizon < 0 or draws < 1:
        raise ValueError(f"{horizon} days and {draws} draws were asked for")
    numbers = ready_to_predict(colocate(parameters, partitions)).selectExpr(
        "*",
        "coalesce(least(bends / nullif(span, 0D), 1D), 0D) AS rate",
        "coalesce(sqrt(1.5D * drift / nullif(bends, 0D)), 0D) AS mean",
        f"explode(slice(sequence(0, {horizon}), 2, {max(horizon, 1)})) AS ahead",
    )
    dated = numbers.selectExpr("*", "date_add(last_ds, ahead) AS ds")
    curves = dated.selectExpr("*", SCALED_TIME, DAY_NUMBER).selectExpr(
        "store", "item", "ds", "t", "scale", "sigma", "rate", "mean",
        f"{TREND} AS trend",
        f"1 + {SEASONALITY} AS growth",
    )
    hashed = curves.selectExpr("*", f"explode(sequence(1, {draws})) AS draw")
    chances = hashed.selectExpr("*", f"{HASH} AS hash").selectExpr(
        "*", *[_uniform(name) for name in DIGITS]
    )
    changes = chances.selectExpr(
        "store", "item", "ds", "draw", "t", "scale", "trend", "growth",
        f"{CHANGE} AS change", f"{NOISE} AS noise",
    )
    so_far = Window.partitionBy(*SERIES, "draw").orderBy("ds")
    bent = changes.withColumn(
        "bent", F.col("t") * F.sum("change").over(so_far) - F.sum(F.expr("change * t")).over(so_far)
    )
    values = bent.selectExpr(
        "store", "item", "ds", "scale * trend * growth AS yhat",
        "scale * ((trend + bent) * growth + noise) AS value",
    )
    bands = values.groupBy(*SERIES, "ds").agg(
        F.first("yhat").alias("yhat"), F.percentile("value", [LOWER, UPPER]).alias("ends")
    )
    return bands.selectExpr(
        "ds", "store", "item", "double(NULL) AS y", "yhat",
        "ends[1] AS yhat_upper", "ends[0] AS yhat_lower",
    ).to(FORECAST)
