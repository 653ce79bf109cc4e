import threading

import pytest

import submit
from shelfcast.operators.baseline import baseline_forecast
from shelfcast.operators.history import clean_history
from shelfcast.plans import star_load
from shelfcast.plans.star_load import check_star, load_star, read_star, reset_star
from shelfcast.sources.claims import Claimed, claimed, holder, release
from shelfcast.sources.settled import settle
from tests.conftest import sales_frame, tuples


def forecast_of(spark, stores):
    rows = [(f"2017-01-{at:02d}", store, 1, at) for store in stores for at in range(1, 6)]
    return settle(baseline_forecast(clean_history(sales_frame(spark, rows)), 2))


def test_a_claim_is_held_once_and_goes(spark, tmp_path):
    folder = str(tmp_path / "star")
    with claimed(spark, folder, "first"):
        assert holder(spark, folder).startswith("first, ")
        with pytest.raises(Claimed, match="held by first, .* since "):
            with claimed(spark, folder, "second"):
                pass
        assert holder(spark, folder).startswith("first, ")
    assert holder(spark, folder) is None
    with pytest.raises(ZeroDivisionError):
        with claimed(spark, folder, "third"):
            raise ZeroDivisionError
    assert holder(spark, folder) is None


def test_a_claim_taken_by_another_is_not_removed(spark, tmp_path):
    folder = str(tmp_path / "star")
    with claimed(spark, folder, "slow"):
        release(spark, folder)
        other = claimed(spark, folder, "other")
        other.__enter__()
    assert holder(spark, folder).startswith("other, ")
    other.__exit__(None, None, None)


def test_a_load_within_another_writes_nothing(spark, tmp_path, monkeypatch):
    folder, refusals = str(tmp_path), []
    rows, others = forecast_of(spark, (1, 2)), forecast_of(spark, (2, 3))
    reset_star(spark, folder)
    append = star_load._append

    def meanwhile(members, path):
        if not refusals:
            with pytest.raises(Claimed) as refusal:
                load_star(others, folder, load="second")
            refusals.append(str(refusal.value))
        append(members, path)

    monkeypatch.setattr(star_load, "_append", meanwhile)
    load_star(rows, folder, load="first")
    assert "held by load first" in refusals[0]
    assert tuples(read_star(spark, folder)["dim_store"]) == [(1, 1), (2, 2)]
    load_star(others, folder, load="second")
    star = read_star(spark, folder)
    assert tuples(star["dim_store"]) == [(1, 1), (2, 2), (3, 3)]
    assert star["fact_sales"].count() == 3 * 7 and sum(check_star(spark, folder).values()) == 0


def test_loads_at_once_repeat_no_id(spark, tmp_path):
    folder = str(tmp_path)
    batches = [forecast_of(spark, stores) for stores in ((1, 2), (3, 4), (5, 6))]
    reset_star(spark, folder)
    faults = []

    def load(at):
        threading.Event().wait(0.2 * at)
        while True:
            try:
                return load_star(batches[at], folder, load=f"batch {at}")
            except Claimed:
                threading.Event().wait(0.3)
            except Exception as fault:
                return faults.append(fault)

    threads = [threading.Thread(target=load, args=(at,)) for at in range(len(batches))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join(180)
    assert not faults and not any(thread.is_alive() for thread in threads)
    star = read_star(spark, folder)
    ids = tuples(star["dim_store"])
    assert [row[0] for row in ids] == [1, 2, 3, 4, 5, 6] and len({row[1] for row in ids}) == 6
    assert star["fact_sales"].count() == 6 * 7 and sum(check_star(spark, folder).values()) == 0


def test_a_claim_left_behind_is_taken_away_by_hand(spark, tmp_path, capsys):
    folder, star = str(tmp_path), f"{tmp_path}/star"
    reset_star(spark, star)
    lost = claimed(spark, star, "lost")
    lost.__enter__()
    with pytest.raises(Claimed, match="lost"):
        load_star(forecast_of(spark, (1,)), star)
    submit.main(["release-star", "--folder", folder])
    assert "held by: lost" in capsys.readouterr().out
    load_star(forecast_of(spark, (1,)), star)
    assert sum(check_star(spark, star).values()) == 0
    lost.__exit__(None, None, None)
