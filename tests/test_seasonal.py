import datetime
import warnings

import numpy as np
import pandas as pd
import pytest

from shelfcast.functions import curve
from shelfcast.functions.curve import changepoint_times, fit_curve, fourier
from shelfcast.operators import seasonal
from shelfcast.operators.frame import extended_history, future_frame
from shelfcast.operators.history import clean_history, colocate
from shelfcast.schemas import FORECAST, HISTORY, PARAMETERS
from shelfcast.sources.sales import sales_from_lineitem
from tests.conftest import plan_of, sales_frame, tuples

FIRST = datetime.date(2014, 1, 1)
YEARS = 3 * 365


def truth(d, bend=0.0):
    growth = 50 + 0.02 * d + bend * np.maximum(0, d - YEARS / 2)
    return growth * (
        1 + 0.10 * np.sin(2 * np.pi * d / 7) + 0.20 * np.sin(2 * np.pi * d / 365.25)
    )


def value_at(fitted, t, days):
    growth = fitted["level"] + fitted["slope"] * t
    for delta, at in zip(fitted["deltas"], fitted["changepoints"]):
        growth = growth + delta * np.maximum(t - at, 0)
    return fitted["scale"] * growth * (1 + np.array(fitted["season"]) @ fourier(days))


def fit_and_extend(d, y, horizon=90):
    epoch = (FIRST - datetime.date(1970, 1, 1)).days
    fitted = fit_curve(epoch + d.astype(float), y)
    far = np.arange(d[0], d[-1] + horizon + 1)
    return fitted, far, value_at(fitted, (far - d[0]) / (d[-1] - d[0]), epoch + far)


def test_noise_free_curve_is_recovered():
    d = np.arange(YEARS)
    _, far, predicted = fit_and_extend(d, truth(d))
    error = np.abs(predicted / truth(far) - 1)
    assert error[:YEARS].max() < 0.01 and error[YEARS:].max() < 0.02


def test_one_slope_change_is_followed():
    d = np.arange(YEARS)
    _, far, predicted = fit_and_extend(d, truth(d, bend=0.05))
    error = np.abs(predicted / truth(far, bend=0.05) - 1)
    assert error[:YEARS].max() < 0.01 and error[YEARS:].max() < 0.02


def test_missing_days_do_not_hurt():
    d = np.sort(np.random.default_rng(3).choice(YEARS, int(0.9 * YEARS), replace=False))
    _, far, predicted = fit_and_extend(d, truth(d))
    assert np.abs(predicted / truth(far) - 1).max() < 0.02


@pytest.mark.parametrize("level", [0.0, 12.0, -3.0])
def test_constant_series(level):
    d = np.arange(200)
    _, _, predicted = fit_and_extend(d, np.full(200, level))
    assert predicted == pytest.approx(level, abs=0.02 * abs(level) + 1e-9)


@pytest.mark.parametrize("points", [2, 3, 5, 12])
def test_short_series_stay_finite(points):
    d = np.arange(points) * 3
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        fitted, _, predicted = fit_and_extend(d, np.arange(points) + 1.0)
    assert np.isfinite(predicted).all()
    assert len(fitted["deltas"]) == max(int(0.8 * points) - 1, 0)


def test_changepoints_lie_in_the_first_part():
    changes = changepoint_times(np.linspace(0, 1, 1000))
    assert len(changes) == 25
    assert 0 < changes[0] and changes[-1] <= 0.8
    assert np.ptp(np.diff(changes)) < 0.01


def noisy_history(spark, stores=20, items=3, sd=2.0, days=YEARS):
    rng = np.random.default_rng(11)
    d = np.arange(days)
    frames = []
    for store in range(1, stores + 1):
        for item in range(1, items + 1):
            y = np.round(20 * truth(d) + rng.normal(0, 20 * sd, days)).astype("int64")
            dates = [FIRST + datetime.timedelta(int(n)) for n in d]
            frames.append(pd.DataFrame({"store": store, "item": item, "ds": dates, "y": y}))
    return spark.createDataFrame(pd.concat(frames), HISTORY)


def test_band_covers_held_out_days(spark):
    history = noisy_history(spark).persist()
    cut = FIRST + datetime.timedelta(YEARS - 90)
    forecast = seasonal.forecast(history.where(history.ds < cut), 90)
    held_out = forecast.drop("y").where(forecast.ds >= cut).join(history, ["store", "item", "ds"])
    inside = held_out.selectExpr(
        "avg(double(y BETWEEN yhat_lower AND yhat_upper)) AS share", "count(*) AS rows"
    ).first()
    assert inside.rows == 60 * 90
    assert 0.90 <= inside.share <= 0.99
    history.unpersist()


@pytest.fixture(scope="module")
def history(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = clean_history(sales_from_lineitem(lineitem, stores=7, items=9)).persist()
    yield rows
    rows.unpersist()


@pytest.fixture(scope="module")
def forecast_rows(history):
    return seasonal.forecast(history).orderBy("store", "item", "ds").toPandas()


def test_forecast_contract(spark, history, forecast_rows):
    assert seasonal.forecast(history).schema == FORECAST
    sizes = {tuple(row[:2]): row[2] for row in history.groupBy("store", "item").count().collect()}
    for (store, item), rows in forecast_rows.groupby(["store", "item"]):
        assert len(rows) == sizes[(store, item)] + 90
        assert rows["y"].isna().sum() == 90 and rows["y"].tail(90).isna().all()
    assert (forecast_rows["yhat_lower"] <= forecast_rows["yhat"]).all()
    assert (forecast_rows["yhat"] <= forecast_rows["yhat_upper"]).all()
    assert np.isfinite(forecast_rows[["yhat", "yhat_lower", "yhat_upper"]].to_numpy()).all()


@pytest.mark.parametrize("partitions", [1, 8])
def test_result_does_not_depend_on_partitions(history, forecast_rows, partitions):
    again = seasonal.forecast(history, partitions=partitions).orderBy("store", "item", "ds")
    pd.testing.assert_frame_equal(again.toPandas(), forecast_rows, rtol=1e-9)


def test_spark_prediction_equals_the_fitted_curve(history, forecast_rows):
    epoch = datetime.date(1970, 1, 1)
    parameters = seasonal.fit(history)
    assert parameters.schema.fieldNames() == PARAMETERS.fieldNames()
    for row in parameters.limit(10).collect():
        rows = forecast_rows.query(f"store == {row.store} and item == {row.item}")
        days = np.array([(d - epoch).days for d in rows["ds"]], dtype=float)
        first, last = (row.first_ds - epoch).days, (row.last_ds - epoch).days
        expected = value_at(row.asDict(), (days - first) / (last - first), days)
        np.testing.assert_allclose(rows["yhat"], expected, rtol=1e-9)


def test_band_is_constant_relative_to_noise_then_widens(spark):
    history = noisy_history(spark, stores=1, items=1)
    rows = seasonal.forecast(history).orderBy("ds").toPandas()
    width = rows["yhat_upper"] - rows["yhat_lower"]
    past, ahead = width[rows["y"].notna()], width[rows["y"].isna()]
    assert past.max() - past.min() < 1e-6
    assert (ahead >= past.iloc[0] - 1e-9).all() and ahead.iloc[-1] > past.iloc[0]


def test_short_series_are_reported_and_do_not_fail_the_job(spark):
    rows = [("2017-01-01", 2, 1, 3)] + [(f"2017-01-0{d}", 1, 1, d) for d in range(1, 6)]
    rows += [(None, 3, 1, 4), ("2017-01-01", 3, 1, None)]
    history = clean_history(sales_frame(spark, rows))
    assert tuples(seasonal.skipped_series(history)) == [
        (2, 1, 1, "fewer than two days of history")
    ]
    forecast = seasonal.forecast(history)
    assert tuples(forecast.select("store", "item").distinct()) == [(1, 1), (2, 1)]
    assert forecast.count() == 5 + 90 + 1 + 90
    flat = forecast.where("store = 2")
    assert {row[1:] for row in tuples(flat, "ds", "yhat", "yhat_lower", "yhat_upper")} == {
        (3.0, 3.0, 3.0)
    }
    assert tuples(seasonal.short_series(seasonal.fit(history))) == [
        (2, 1, 1, "fewer than two days of history")
    ]


def test_series_on_one_day_in_ansi_mode(spark):
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        history = clean_history(sales_frame(spark, [("2017-01-01", 2, 1, 0)]))
        assert tuples(seasonal.forecast(history, 2), "yhat") == [(0.0,)] * 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_negative_horizon_is_refused(spark):
    history = clean_history(sales_frame(spark, [("2017-01-01", 2, 1, 1)]))
    for refuse in (lambda: future_frame(history, -1), lambda: seasonal.forecast(history, -1)):
        with pytest.raises(ValueError):
            refuse()


def test_intermittent_series_say_whether_they_converged():
    random = np.random.default_rng(3)
    for points in (30, 200, 900):
        day = np.arange(points, dtype=float) + 17_000
        y = random.poisson(0.4, points) * random.integers(1, 9, points)
        fit = curve.fit_curve(day, y.astype(float))
        assert isinstance(fit["converged"], bool) and 0 < fit["rounds"] <= curve.MAX_ROUNDS
        assert fit["converged"] or fit["rounds"] > 1
        assert (fit["sigma"] * fit["scale"]) ** 2 <= np.var(y) * 1.001


def test_sigma_belongs_to_the_returned_parameters():
    day = np.arange(400, dtype=float) + 17_000
    y = np.random.default_rng(5).poisson(0.3, 400).astype(float)
    fit = curve.fit_curve(day, y)
    t = (day - day[0]) / (day[-1] - day[0])
    bends = np.maximum(t[:, None] - np.array(fit["changepoints"]), 0) @ np.array(fit["deltas"])
    season = np.array(fit["season"]) @ curve.fourier(day)
    fitted = fit["scale"] * (fit["level"] + fit["slope"] * t + bends) * (1 + season)
    assert fit["scale"] * fit["sigma"] == pytest.approx(np.sqrt(np.mean((y - fitted) ** 2)))


def test_prediction_on_dates_only(spark):
    rows = [(f"2017-01-{d:02d}", 1, 1, d) for d in range(1, 21)]
    history = colocate(clean_history(sales_frame(spark, rows)))
    parameters = seasonal.fit(history)
    predicted = seasonal.predict(parameters, future_frame(history, 5))
    assert predicted.schema == FORECAST and predicted.count() == 25
    assert predicted.where("y IS NOT NULL").count() == 0
    expected = seasonal.predict(parameters, extended_history(history, 5))
    assert tuples(predicted, "ds", "yhat") == tuples(expected, "ds", "yhat")


def test_sales_are_scanned_and_shuffled_once(spark, sf_dir):
    sales = sales_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    forecast = seasonal.forecast(clean_history(sales))
    forecast.collect()
    plan = plan_of(forecast)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert plan.count("Window") == 0
    assert plan.count("MapInArrow") == 1
