import hashlib
import math

import numpy as np
import pytest

from shelfcast.operators import seasonal
from shelfcast.operators.history import clean_history
from shelfcast.operators.sampled import sampled_horizon
from shelfcast.plans.forecast_job import run_forecast, stored_forecast
from shelfcast.schemas import FORECAST, HISTORY, PARAMETERS
from tests.conftest import day, plan_of, sales_frame, tuples

SEASON = [0.01 * (wave % 5 - 2) for wave in range(26)]


def model(spark, *models):
    """Models of ``(store, slope changes, noise)`` over 365 days."""
    rows = [
        (store, 7, day("2017-01-01"), day("2018-01-01"), 366, 100.0, 0.2, 0.5,
         [0.1 * (at + 1) for at in range(len(deltas))], deltas, SEASON, sigma, True, 3)
        for store, deltas, sigma in models
    ]
    return spark.createDataFrame(rows, PARAMETERS)


def draws_of(store, deltas, sigma, horizon, draws):
    """Values of one series by plain numbers: an array of draws by days, without the season."""
    rate, mean = len(deltas) / 365, float(np.mean(np.abs(deltas))) if deltas else 0.0
    first = day("2018-01-01").toordinal() - day("1970-01-01").toordinal()
    bent, noise = np.zeros((draws, horizon)), np.zeros((draws, horizon))
    for draw in range(draws):
        past = []
        for at in range(horizon):
            t = (365 + at + 1) / 365
            text = hashlib.md5(f"{store}:7:{draw + 1}:{first + at + 1}".encode()).hexdigest()
            chance, radius, angle = (
                (int(part, 16) + 0.5) / 16 ** len(part) for part in (text[:13], text[13:23], text[23:])
            )
            if chance < rate:
                side = chance / rate - 0.5
                past.append((t, -mean * math.copysign(1, side) * math.log(1 - 2 * abs(side))))
            bent[draw, at] = sum(change * (t - since) for since, change in past)
            noise[draw, at] = sigma * math.sqrt(-2 * math.log(radius)) * math.cos(2 * math.pi * angle)
    return bent, noise


def test_equals_plain_numbers(spark):
    horizon, draws, deltas = 20, 60, [0.8, -0.9] * 12
    parameters = model(spark, (3, deltas, 0.02))
    found = sampled_horizon(parameters, horizon, draws).orderBy("ds").collect()
    last = spark.createDataFrame([(3, 7, day("2018-01-01"), 1)], HISTORY)
    curve = seasonal.predict(parameters, last, horizon).where("y IS NULL").orderBy("ds").collect()
    bent, noise = draws_of(3, deltas, 0.02, horizon, draws)
    assert np.abs(bent).max() > 0.01
    assert [row["ds"] for row in found] == [row["ds"] for row in curve]
    for at, (row, center) in enumerate(zip(found, curve)):
        assert row["yhat"] == pytest.approx(center["yhat"]) and row["y"] is None
        t = (365 + at + 1) / 365
        trend = 0.5 + 0.2 * t + sum(
            delta * max(t - 0.1 * (place + 1), 0) for place, delta in enumerate(deltas)
        )
        growth = center["yhat"] / (100 * trend)
        values = 100 * ((trend + bent[:, at]) * growth + noise[:, at])
        lower, upper = np.quantile(values, [0.025, 0.975])
        assert (row["yhat_lower"], row["yhat_upper"]) == pytest.approx((lower, upper))


def test_agrees_with_the_closed_form(spark):
    """Widths by noise alone within a tenth; with many small changes, over the horizon, too."""
    parameters = model(spark, (1, [], 0.05), (2, [0.3, -0.3] * 12, 0.05))
    last = spark.createDataFrame([(s, 7, day("2018-01-01"), 1) for s in (1, 2)], HISTORY)
    closed = seasonal.predict(parameters, last, 90).where("y IS NULL")
    sampled = sampled_horizon(parameters, 90, 4000)
    names = ("store", "ds", "yhat_upper", "yhat_lower")
    widths = {
        row[:2]: row[2] - row[3] for row in tuples(closed, *names)
    }
    ratios = {1: [], 2: []}
    for store, ds, upper, lower in tuples(sampled, *names):
        ratios[store].append((upper - lower) / widths[store, ds])
    assert max(abs(ratio - 1) for ratio in ratios[1]) < 0.1
    assert abs(np.mean(ratios[1]) - 1) < 0.01 and abs(np.mean(ratios[2]) - 1) < 0.1


def test_reruns_and_other_partitions_agree(spark):
    parameters = model(spark, (1, [0.1, 0.2], 0.05), (2, [0.3], 0.0))
    first = tuples(sampled_horizon(parameters, 10, 50, 3))
    assert tuples(sampled_horizon(parameters.repartition(5), 10, 50, 7)) == first


def test_only_parameters_are_exchanged(spark):
    found = sampled_horizon(model(spark, (1, [0.1], 0.05)), 5, 20)
    found.collect()
    assert plan_of(found).count("Exchange") == 1
    assert found.schema.names == FORECAST.names


def test_odd_models(spark):
    one_day = (9, 7, day("2018-01-01"), day("2018-01-01"), 1, 4.0, 0.0, 1.0, [], [], [0.0] * 26, 0.0, True, 0)
    flat = sampled_horizon(spark.createDataFrame([one_day], PARAMETERS), 3, 10)
    assert {row[4:] for row in tuples(flat)} == {(4.0, 4.0, 4.0)} and flat.count() == 3
    assert sampled_horizon(model(spark, (1, [0.1], 0.1)), 0, 10).count() == 0
    assert sampled_horizon(spark.createDataFrame([], PARAMETERS), 3, 10).count() == 0
    one = sampled_horizon(model(spark, (1, [0.1], 0.1)), 2, 1).collect()
    assert [row["yhat_upper"] for row in one] == [row["yhat_lower"] for row in one]
    for horizon, draws in ((-1, 10), (3, 0)):
        with pytest.raises(ValueError):
            sampled_horizon(model(spark, (1, [], 0.1)), horizon, draws)


def test_job_stores_sampled_bands(spark, tmp_path):
    rows = [(f"2017-01-{at:02d}", 1, 1, 10 + at * at % 7) for at in range(1, 32)]
    folder, date = str(tmp_path), day("2017-02-01")
    sales = sales_frame(spark, rows)
    run_forecast(sales, folder, date, date, 5)
    closed = stored_forecast(spark, folder, date).orderBy("ds").collect()
    run_forecast(sales, folder, date, date, 5, draws=400)
    drawn = stored_forecast(spark, folder, date).orderBy("ds").collect()
    assert len(closed) == len(drawn) == 36
    assert [row["ds"] for row in closed] == [row["ds"] for row in drawn]
    assert closed[:31] == drawn[:31] and closed[31:] != drawn[31:]
    for one, other in zip(closed, drawn):
        assert one["yhat"] == pytest.approx(other["yhat"])
