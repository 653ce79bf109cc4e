import re

import pytest

from shelfcast.operators import seasonal
from shelfcast.operators.baseline import baseline_forecast
from shelfcast.operators.evaluation import evaluate, stamp
from shelfcast.operators.history import clean_history
from shelfcast.schemas import HISTORY
from shelfcast.sources.kept import forget_history, keep_history, kept_history
from shelfcast.sources.sales import sales_from_lineitem
from shelfcast.sources.settled import settle
from tests.conftest import day, plan_of, tuples


@pytest.fixture(scope="module")
def history(spark, sf_dir):
    return settle(clean_history(sales_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))))


@pytest.fixture(scope="module")
def kept(spark, history, tmp_path_factory):
    yield keep_history(history, "kept_days", str(tmp_path_factory.mktemp("kept") / "days"), 4)
    forget_history(spark, "kept_days")


def moved(frame):
    """Exchanges that move rows by key in the plan, with what they read."""
    frame.collect()
    return re.findall(r"\+?-? *Exchange hashpartitioning[^\n]*", plan_of(frame))


def test_same_rows(spark, history, kept):
    assert tuples(kept) == tuples(history) and kept.schema.names == HISTORY.names
    assert tuples(kept_history(spark, "kept_days")) == tuples(history)


def test_fit_does_not_move_the_history(kept, history):
    fitted = seasonal.fit(kept)
    assert moved(fitted) == []
    assert tuples(fitted) == tuples(seasonal.fit(history))


def test_predict_does_not_move_the_history(kept, history):
    parameters = settle(seasonal.fit(history))
    predicted = seasonal.predict(parameters, kept, 30)
    assert moved(predicted) == []
    assert tuples(predicted) == tuples(seasonal.predict(parameters, history, 30))


def test_a_join_without_broadcast_moves_the_parameters_alone(spark, kept, history):
    parameters = settle(seasonal.fit(history))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        predicted = seasonal.predict(parameters, kept, 30)
        assert len(moved(predicted)) == 1 and "Bucketed: true" in plan_of(predicted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scores_do_not_move_the_history(kept, history):
    date = day("2001-12-31")
    scores = evaluate(stamp(baseline_forecast(kept), date), date)
    assert moved(scores) == []
    expected = evaluate(stamp(baseline_forecast(history), date), date)
    assert [row[:3] for row in tuples(scores)] == [row[:3] for row in tuples(expected)]
    for one, other in zip(tuples(scores), tuples(expected)):
        assert one[3:] == pytest.approx(other[3:])


def test_keeping_again_replaces(spark, history, tmp_path):
    path = str(tmp_path / "again")
    keep_history(history, "kept_again", path, 3)
    fewer = history.where("store = 1")
    assert tuples(keep_history(fewer, "kept_again", path, 2)) == tuples(fewer)
    assert keep_history(history.limit(0), "kept_again", path, 2).count() == 0
    forget_history(spark, "kept_again")
    forget_history(spark, "kept_again")
