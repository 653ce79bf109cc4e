import datetime

import pytest

from shelfcast.operators.baseline import Z95, baseline_forecast
from shelfcast.operators.evaluation import evaluate, evaluate_single, stamp, with_actuals
from shelfcast.operators.frame import future_frame
from shelfcast.operators.history import clean_history
from shelfcast.schemas import FORECAST, HISTORY
from shelfcast.sources.sales import sales_from_lineitem
from tests.conftest import day, plan_of, sales_frame, tuples

START = datetime.date(2017, 1, 2)


def series(spark, values, store=1, item=1):
    days = [(store, item, START + datetime.timedelta(n), y) for n, y in enumerate(values)]
    return spark.createDataFrame(days, HISTORY)


def test_flat_series_is_continued_exactly(spark):
    forecast = baseline_forecast(series(spark, [20] * 30), 10)
    assert forecast.schema == FORECAST
    rows = forecast.collect()
    assert len(rows) == 40
    for row in rows:
        assert row.yhat == pytest.approx(20)
        assert row.yhat_lower == pytest.approx(20, abs=1e-6)
    assert sum(row.y is None for row in rows) == 10


def test_weekday_factor_is_learned(spark):
    weekly = [100, 100, 100, 100, 100, 150, 50]
    forecast = baseline_forecast(series(spark, weekly * 52), 14).collect()
    horizon = sorted((row.ds, row.yhat) for row in forecast if row.y is None)
    assert [value for _, value in horizon] == pytest.approx(weekly * 2, rel=0.02)


def test_band_is_the_residual_deviation(spark):
    values = [10, 14, 9, 15, 11, 13, 12, 9, 12, 15, 14, 10, 9, 16]
    rows = baseline_forecast(series(spark, values), 1).collect()
    errors = [row.y - row.yhat for row in rows if row.y is not None]
    mean = sum(errors) / len(errors)
    deviation = (sum((e - mean) ** 2 for e in errors) / (len(errors) - 1)) ** 0.5
    for row in rows:
        assert row.yhat_upper - row.yhat == pytest.approx(Z95 * deviation)
        assert row.yhat_lower <= row.yhat <= row.yhat_upper


def test_one_day_and_zero_series_do_not_fail(spark):
    one = baseline_forecast(series(spark, [7]), 3).collect()
    assert [row.yhat for row in one] == [7.0] * 4
    zero = baseline_forecast(series(spark, [0] * 10), 3).collect()
    assert all(row.yhat == 0 and row.yhat_upper == 0 for row in zero)


def test_unseen_weekday_has_factor_one(spark):
    # A Monday and a Tuesday only, on a line through both.
    rows = baseline_forecast(series(spark, [10, 12]), 1).collect()
    assert [row.yhat for row in rows if row.y is None] == pytest.approx([14])


def test_history_moves_once_and_needs_no_join_and_no_python(spark, sf_dir):
    history = clean_history(sales_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))
    forecast = stamp(baseline_forecast(history), day("2018-01-01"))
    scores = evaluate(forecast, day("2000-01-01"))
    plan = plan_of(scores)
    assert "Join" not in plan and "Python" not in plan and "Pandas" not in plan
    # One exchange for the daily sum and one that all windows and the scores share.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Sort [") == 1


def test_single_series_scores_filter_the_scan(spark, tmp_path):
    rows = [("2017-01-01", 1, 1, 3), ("2017-01-02", 1, 1, 4), ("2017-01-02", 2, 1, 9)]
    sales_frame(spark, rows).write.parquet(str(tmp_path / "sales"))
    history = clean_history(spark.read.parquet(str(tmp_path / "sales")))
    forecast = stamp(baseline_forecast(history, 5), day("2018-01-01"))
    scores = evaluate_single(forecast, 2, 1, day("2018-01-01"))
    assert "EqualTo(store,2)" in plan_of(scores)
    assert [tuple(row) for row in scores.collect()] == [(day("2018-01-01"), 2, 1, 0.0, 0.0, 0.0)]


def test_metrics(spark):
    rows = [
        (day("2017-01-01"), 1, 1, 1.0, 2.0),
        (day("2017-01-02"), 1, 1, 2.0, 2.0),
        (day("2017-01-03"), 1, 1, 3.0, 5.0),
        (day("2017-01-04"), 1, 1, None, 9.0),
        (day("2018-01-01"), 1, 1, 0.0, 99.0),
    ]
    forecast = spark.createDataFrame(rows, "ds date, store int, item int, y double, yhat double")
    scores = evaluate(stamp(forecast, day("2019-01-01")), day("2018-01-01")).collect()
    assert len(scores) == 1
    assert scores[0].training_date == day("2019-01-01")
    assert scores[0].mae == pytest.approx(1.0)
    assert scores[0].mse == pytest.approx(5 / 3)
    assert scores[0].rmse == pytest.approx((5 / 3) ** 0.5)


def test_actuals_join_leaves_the_horizon_null(spark):
    history = series(spark, [5, 6, 7])
    joined = with_actuals(future_frame(history, 2), history)
    assert sorted((row.ds.day, row.y) for row in joined.collect()) == [
        (2, 5),
        (3, 6),
        (4, 7),
        (5, None),
        (6, None),
    ]


def test_one_hot_series_gives_the_same_rows(spark):
    """A third of all sales on one day of one series changes neither plan nor result."""
    rows = [("2017-01-01", 1, 1, 1)] * 3000 + [
        (f"2017-01-{d:02d}", s, 1, s) for s in range(1, 31) for d in range(1, 29)
    ]
    history = clean_history(sales_frame(spark, rows).repartition(6))
    assert history.count() == 30 * 28
    hot = [row for row in tuples(history) if row[:3] == (1, 1, day("2017-01-01"))]
    assert hot == [(1, 1, day("2017-01-01"), 3001)]
    assert baseline_forecast(history, 90).count() == 30 * (28 + 90)
