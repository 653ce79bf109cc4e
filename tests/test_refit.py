import datetime

import numpy as np
import pytest

from shelfcast.functions import curve, curves
from shelfcast.operators import seasonal
from shelfcast.operators.history import clean_history, colocate
from shelfcast.plans.forecast_job import run_forecast
from shelfcast.schemas import PARAMETERS
from shelfcast.sources.sales import sales_from_lineitem
from shelfcast.sources.settled import settle
from shelfcast.sources.tables import load_parameters
from tests.conftest import day, sales_frame, tuples


def at(model, first, days):
    """Values of a model on days, in sales."""
    t = (days - first) / (model["last_ds"] - first)
    bends = np.maximum(t - np.array(model["changepoints"])[:, None], 0.0)
    trend = model["level"] + model["slope"] * t + np.array(model["deltas"]) @ bends
    return model["scale"] * trend * (1 + np.array(model["season"]) @ curve.fourier(days))


def series(days, bend, seed=1):
    noise = np.random.default_rng(seed).normal(0, 2, len(days))
    season = 1 + 0.2 * np.sin(2 * np.pi * days / 7) + 0.3 * np.cos(2 * np.pi * days / 365.25)
    return (100 + 0.05 * (days - days[0]) + bend * np.maximum(days - days[len(days) // 2], 0)) * season + noise


def fitted(days, y, start=None):
    row = curves.fit_curves([days], [y], None if start is None else [start])[0]
    return {**row, "first_ds": int(days[0]), "last_ds": int(days[-1])}


DAYS = np.arange(17000.0, 18200.0)


def test_carried_over_keeps_the_curve():
    y = series(DAYS, 0.1)
    old = fitted(DAYS[:1100], y[:1100])
    changes = curve.changepoint_times((DAYS - DAYS[0]) / (DAYS[-1] - DAYS[0]))
    weights = curve.carried_over(old, DAYS[0], DAYS[-1], changes, 200.0)
    moved = {
        "scale": 200.0, "slope": weights[0], "level": weights[1], "changepoints": changes,
        "deltas": weights[2:-26], "season": weights[-26:], "last_ds": DAYS[-1],
    }
    before = at(old, DAYS[0], DAYS[:1100])
    assert np.abs(at(moved, DAYS[0], DAYS[:1100]) - before).max() < 0.01 * old["scale"]


def test_same_axis_is_carried_over_exactly():
    old = fitted(DAYS, series(DAYS, -0.05))
    changes = np.array(old["changepoints"])
    weights = curve.carried_over(old, DAYS[0], DAYS[-1], changes, old["scale"])
    stored = [old["slope"], old["level"], *old["deltas"], *old["season"]]
    assert weights == pytest.approx(stored, abs=1e-9)


@pytest.mark.parametrize("bend", [0.0, 0.2, -0.08])
def test_fewer_rounds_to_the_same_curve(bend):
    y = series(DAYS, bend)
    anew, old = fitted(DAYS, y), fitted(DAYS[:1150], y[:1150])
    again = fitted(DAYS, y, old)
    assert again["converged"] and again["rounds"] <= anew["rounds"]
    apart = at(anew, DAYS[0], DAYS) - at(again, DAYS[0], DAYS)
    assert np.abs(apart).max() < 0.002 * anew["scale"]


def test_a_poor_start_still_reaches_the_curve():
    y = series(DAYS, 0.1)
    other = fitted(DAYS[:300], 5000 - 3 * y[:300])
    again, anew = fitted(DAYS, y, other), fitted(DAYS, y)
    assert again["converged"]
    assert again["sigma"] == pytest.approx(anew["sigma"], rel=0.02)


def sparse(seed, many):
    """Sales on some days of seven years, by chance alone."""
    random = np.random.default_rng(seed)
    days = np.sort(random.choice(2499, many, replace=False)) + 9130.0
    return days, random.integers(1, 51, many).astype(float)


def test_search_goes_on_where_the_plain_prior_ended_it():
    days, y = sparse(18084, 150)
    assert fitted(days, y)["converged"] and curve.fit_curve(days, y)["converged"]


@pytest.mark.parametrize("seed", [324, 326, 394])
def test_few_days_end_at_one_curve_from_any_model(seed):
    days, y = sparse(seed, 34)
    anew, again = fitted(days, y), fitted(days, y, fitted(days[:30], y[:30]))
    assert anew["converged"] and again["converged"]
    assert np.abs(at(anew, days[0], days) - at(again, days[0], days)).max() <= 0.01 * anew["scale"]


def test_some_series_have_no_start(spark):
    start = datetime.date(2017, 1, 1)
    days = [start + datetime.timedelta(n) for n in range(60)]
    rows = [(d.isoformat(), s, 1, 10 * s + n % 7) for s in (1, 2) for n, d in enumerate(days)]
    history = settle(clean_history(sales_frame(spark, [*rows, ("2017-01-05", 3, 1, 4)])))
    early = seasonal.fit(colocate(history.where("store = 1 AND ds < '2017-02-20'")))
    one_day = seasonal.fit(colocate(history.where("store = 2 AND ds = '2017-01-01'")))
    gone = seasonal.fit(colocate(history.where("store = 1").selectExpr("9 AS store", "item", "ds", "y")))
    models = settle(early.unionByName(one_day).unionByName(gone))
    found = tuples(seasonal.fit(colocate(history), models), "store", "points", "converged")
    assert found == [(1, 60, True), (2, 60, True), (3, 1, True)]
    anew = tuples(seasonal.fit(colocate(history)).where("store > 1"))
    assert tuples(seasonal.fit(colocate(history), models).where("store > 1")) == anew
    none = spark.createDataFrame([], PARAMETERS)
    assert tuples(seasonal.fit(colocate(history), none).where("store > 1")) == anew


def test_rounds_of_the_job(spark, sf_dir, tmp_path):
    folder, first, second = str(tmp_path), day("2001-06-01"), day("2001-12-31")
    sales = settle(sales_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), 2, 2))
    run_forecast(sales.where("date < '2001-06-01'"), folder, first, first, 2)
    run_forecast(sales, folder, second, second, 2)
    rounds = load_parameters(spark, f"{folder}/parameters", second).agg({"rounds": "sum"}).first()[0]
    run_forecast(sales, folder, second, second, 2, start_from=first)
    again = load_parameters(spark, f"{folder}/parameters", second)
    assert again.agg({"rounds": "sum"}).first()[0] < rounds and again.where("NOT converged").isEmpty()
