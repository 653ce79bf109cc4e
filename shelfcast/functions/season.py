"""The fitted curve as Spark SQL expressions over a parameter row.

The sums over changepoints and waves are spelled out term by term, because a lambda over
an array is interpreted for every element of every row. The coefficients are first laid
out as columns that cannot be NULL: without NULL and bounds checks the generated code
stays small enough for the JVM to compile, which makes it several times faster. The
sums are given as text, since building hundreds of Column objects one by one takes
longer than planning the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.functions.curve import CHANGEPOINTS, WEEK_DAYS, WEEK_ORDER, YEAR_DAYS, YEAR_ORDER

TWO_PI = 6.283185307179586

# Wave and angle per day of each season coefficient, in the order of the fit.
WAVES = [
    (wave, k * TWO_PI / period)
    for period, order in ((YEAR_DAYS, YEAR_ORDER), (WEEK_DAYS, WEEK_ORDER))
    for wave in ("sin", "cos")
    for k in range(1, order + 1)
]

# 0 on the first and 1 on the last day the model saw; always 0 if it saw one day.
SCALED_TIME = "coalesce((unix_date(ds) - start) / nullif(span, 0D), 0D) AS t"
DAY_NUMBER = "coalesce(double(unix_date(ds)), 0D) AS day"

# Piecewise linear growth: every changepoint passed bends the slope by its delta.
TREND = " + ".join(
    ["level + slope * t"]
    + [f"delta{j} * greatest(t - change{j}, 0D)" for j in range(CHANGEPOINTS)]
)

# Relative season of a day number.
SEASONALITY = " + ".join(
    f"season{j} * {wave}(day * {angle!r}D)" for j, (wave, angle) in enumerate(WAVES)
)

# Variance of slope changes still to come, zero on the history. Changes are assumed to go
# on at the rate and mean size seen so far, as a compound Poisson process with Laplace
# sizes: rate * 2 size^2 * (t - 1)^3 / 3, of which ``drift`` is the part before the time.
TREND_VARIANCE = "drift * pow(greatest(t - 1D, 0D), 3D)"
DRIFT = (
    "size(deltas) * 2 / 3 * pow(aggregate(deltas, 0D, (total, delta) -> total + abs(delta))"
    " / greatest(size(deltas), 1), 2)"
)


def _laid_out(values: str, prefix: str, count: int) -> list[str]:
    return [f"coalesce(get({values}, {j}), 0D) AS {prefix}{j}" for j in range(count)]


def ready_to_predict(parameters: DataFrame) -> DataFrame:
    """Parameters with all that depends on the series alone worked out once per series.

    Changepoints that a short series does not have get delta 0, which changes nothing.
    """
    numbers = {
        "span": "double(datediff(last_ds, first_ds))",
        "start": "double(unix_date(first_ds))",
        "drift": DRIFT,
        "bends": "double(greatest(size(deltas), 0))",
        **{name: name for name in ("scale", "slope", "level", "sigma")},
    }
    return parameters.selectExpr(
        "store",
        "item",
        "last_ds",
        *[f"coalesce({number}, 0D) AS {name}" for name, number in numbers.items()],
        *_laid_out("deltas", "delta", CHANGEPOINTS),
        *_laid_out("changepoints", "change", CHANGEPOINTS),
        *_laid_out("season", "season", len(WAVES)),
    )
