import numpy as np
import pytest

from shelfcast.functions import curve, curves


def made(seed, sizes):
    random, days, totals = np.random.default_rng(seed), [], []
    for size in sizes:
        day = np.sort(random.choice(2400, size, replace=False)) + 10_000.0
        shape = (1 + 0.1 * np.sin(2 * np.pi * day / 7)) * (1 + 0.2 * np.sin(2 * np.pi * day / 365.25))
        days.append(day)
        totals.append(np.round((50 + 0.02 * (day - 10_000)) * shape + random.normal(0, random.choice([0, 2, 20]), size)))
    return days, totals


def values(row, day):
    """The fitted curve on the days of the series."""
    if len(day) < 2:
        return np.array([row["level"] * row["scale"]])
    t = (day - day[0]) / (day[-1] - day[0])
    bends = np.maximum(t - np.array(row["changepoints"])[:, None], 0)
    trend = row["level"] + row["slope"] * t + np.array(row["deltas"]) @ bends
    return row["scale"] * trend * (1 + np.array(row["season"]) @ curve.fourier(day))


SIZES = [1, 2, 3, 5, 30, 31, 60, 61, 62, 200, 900]


@pytest.mark.parametrize("stack", [curves.STACK, 5_000])
def test_stacked_fits_are_the_single_ones(monkeypatch, stack):
    """Every size, mixed; the curves agree to a millionth of the largest total."""
    monkeypatch.setattr(curves, "STACK", stack)
    days, totals = made(1, np.random.default_rng(0).choice(SIZES, 150))
    totals[3][:], totals[4][:] = 0, 5
    for day, y, row in zip(days, totals, curves.fit_curves(days, totals)):
        single = curve.fit_curve(day, y)
        assert row.keys() == single.keys()
        assert all(row[key] == single[key] for key in ("points", "converged", "rounds", "scale"))
        assert row["changepoints"] == single["changepoints"]
        assert np.allclose(values(row, day), values(single, day), atol=1e-6 * single["scale"], rtol=0)
        for key in ("slope", "level", "deltas", "season", "sigma"):
            assert np.allclose(row[key], single[key], atol=1e-5), key


def test_no_series():
    assert curves.fit_curves([], []) == []


def test_changepoints_of_one_series_are_its_own():
    days, totals = made(2, [40, 40, 40])
    rows = curves.fit_curves(days, totals)
    for row, day in zip(rows, days):
        t = (day - day[0]) / (day[-1] - day[0])
        assert np.allclose(row["changepoints"], curve.changepoint_times(t))
    assert rows[0]["changepoints"] != rows[1]["changepoints"]
