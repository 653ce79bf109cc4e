"""Fit of one seasonal growth curve with numpy.

    y = (level + slope t + sum_j delta_j max(0, t - c_j)) (1 + season(day)) + noise

The maximum a posteriori fit under normal priors on level, slope and season and a
Laplace prior on the slope changes, after Taylor and Letham, "Forecasting at scale"
(2018), found by Gauss-Newton steps with halving. Within a step the Laplace prior
becomes a reweighted ridge, and the noise level is updated after it.
"""

from __future__ import annotations

import numpy as np

# Model defaults of the published method.
YEAR_DAYS, YEAR_ORDER = 365.25, 10
WEEK_DAYS, WEEK_ORDER = 7.0, 3
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGE_SCALE = 0.05
TREND_DEVIATION = 5.0
SEASON_DEVIATION = 10.0

MAX_ROUNDS = 400
MAX_HALVINGS = 14
REWEIGHTINGS = 5
# Series of fewer days hardly determine a curve: searches from two places may end at two curves,
# so theirs always begin at the same place.
DAYS_TO_START = 2 * (2 + CHANGEPOINTS + 2 * (YEAR_ORDER + WEEK_ORDER))
# Largest move of the scaled curve that still counts as converged.
TOLERANCE = 1e-4
# Slope changes far below this are treated as zero.
SMALL_CHANGE = 1e-4
# Noise floor relative to the largest sale; it keeps the solves well conditioned.
MIN_SIGMA = 1e-3


def fourier(day: np.ndarray) -> np.ndarray:
    """Season features, one per line, of day numbers counted from 1970-01-01.

    Sines and then cosines of the yearly waves are followed by those of the weekly ones.
    """
    blocks = []
    for period, order in ((YEAR_DAYS, YEAR_ORDER), (WEEK_DAYS, WEEK_ORDER)):
        angle = np.outer(np.arange(1, order + 1) * (2 * np.pi / period), day)
        blocks += [np.sin(angle), np.cos(angle)]
    return np.vstack(blocks)


def bent(changes: np.ndarray) -> np.ndarray:
    """Penalty of slope changes: the Laplace prior, smoothed where changes are small.

    A reweighted ridge at these changes lies above it and touches it there, so the minimum of
    the ridge never has a higher cost along the linearised curve. With the plain prior it can
    have, and the search would end before it converged.
    """
    size = np.abs(changes)
    return size - SMALL_CHANGE * np.log1p(size / SMALL_CHANGE)


def changepoint_places(points: int) -> np.ndarray:
    """Evenly spread places in the first part of so many observations."""
    usable = int(np.floor(points * CHANGEPOINT_RANGE))
    count = max(min(CHANGEPOINTS, usable - 1), 0)
    return np.linspace(0, max(usable - 1, 0), count + 1).round().astype(int)[1:]


def changepoint_times(t: np.ndarray) -> np.ndarray:
    """Evenly spread observation times in the first part of the history."""
    return t[changepoint_places(len(t))]


def carried_over(start: dict, first: float, last: float, changes: np.ndarray, scale: float):
    """Weights of a stored curve on the axis, changepoints and scale of a longer series.

    ``start`` has the columns of a parameter row, days as numbers. Between two changepoints the
    trend runs straight between the values that the stored one has there, so that weights
    differ from it only where it bends elsewhere. The season is relative and stays.
    """
    knots = np.concatenate([[0.0], changes, [1.0]])
    span = float(start["last_ds"] - start["first_ds"]) or 1.0
    then = (first + knots * (last - first) - start["first_ds"]) / span
    bends = np.maximum(then - np.array(start["changepoints"], float).reshape(-1, 1), 0.0)
    trend = start["level"] + start["slope"] * then + np.array(start["deltas"], float) @ bends
    trend *= start["scale"] / scale
    slopes = np.diff(trend) / np.diff(knots)
    return np.concatenate([[slopes[0], trend[0]], np.diff(slopes), start["season"]])


def fit_curve(day: np.ndarray, y: np.ndarray) -> dict:
    """Parameters for observations on distinct, ascending days; one day gives a flat line.

    ``converged`` is False if the search ran out of rounds, or found no better point while
    the curve still moved. The parameters are the best ones seen either way.
    """
    scale = float(np.abs(y).max()) or 1.0
    if len(y) < 2:
        return _flat(float(y[0]) / scale, scale)
    t = (day - day[0]) / float(day[-1] - day[0])
    target = y / scale

    changes = changepoint_times(t)
    growth_features = np.vstack([t, np.ones_like(t), np.maximum(t - changes[:, None], 0.0)])
    season_features = fourier(day)
    bends = slice(2, len(growth_features))
    seasons = slice(bends.stop, bends.stop + len(season_features))
    prior = np.zeros(seasons.stop)
    prior[:2] = TREND_DEVIATION**-2
    prior[seasons] = SEASON_DEVIATION**-2

    def curve(weights):
        return weights[: bends.stop] @ growth_features, weights[seasons] @ season_features

    def cost(weights, noise):
        trend, season = curve(weights)
        misfit = target - trend * (1.0 + season)
        bending = 2.0 / CHANGE_SCALE * bent(weights[bends]).sum()
        return misfit @ misfit + noise * (prior @ (weights - center) ** 2 + bending)

    def ridge(gram, moment, noise, change_size):
        penalty = prior.copy()
        penalty[bends] = 1.0 / (CHANGE_SCALE * change_size)
        return np.linalg.solve(
            gram + np.diag(noise * penalty), moment + noise * penalty * center
        )

    # Start from a flat line through the mean. The level is also drawn towards it and not
    # towards zero, so that half a year of flat sales is not taken for half a wave.
    center = np.zeros(seasons.stop)
    center[1] = target.mean()
    weights = center
    change_size = np.full(len(changes), CHANGE_SCALE)
    jacobian = np.empty((seasons.stop, len(t)))
    fitted = np.full_like(t, np.inf)
    converged, rounds = False, 0
    while rounds < MAX_ROUNDS:
        trend, season = curve(weights)
        previous, fitted = fitted, trend * (1.0 + season)
        sigma = float(np.sqrt(np.mean((target - fitted) ** 2)))
        if np.abs(fitted - previous).max() <= TOLERANCE:
            converged = True
            break
        rounds += 1
        noise = max(sigma, MIN_SIGMA) ** 2
        np.multiply(growth_features, 1.0 + season, out=jacobian[: bends.stop])
        np.multiply(season_features, trend, out=jacobian[seasons])
        # The linearised curve at ``weights`` equals fitted + trend * season.
        gram, moment = jacobian @ jacobian.T, jacobian @ (target + trend * season)
        for _ in range(REWEIGHTINGS):
            best = ridge(gram, moment, noise, change_size)
            change_size = np.abs(best[bends]) + SMALL_CHANGE
        step, before = best - weights, cost(weights, noise)
        for _ in range(MAX_HALVINGS):
            if cost(weights + step, noise) <= before:
                break
            step = step / 2
        if cost(weights + step, noise) > before:
            trend, season = curve(weights + step)
            converged = bool(np.abs(trend * (1.0 + season) - fitted).max() <= TOLERANCE)
            break
        weights = weights + step
        change_size = np.abs(weights[bends]) + SMALL_CHANGE
    trend, season = curve(weights)
    sigma = float(np.sqrt(np.mean((target - trend * (1.0 + season)) ** 2)))
    return {
        "points": len(y),
        "scale": scale,
        "slope": float(weights[0]),
        "level": float(weights[1]),
        "changepoints": changes.tolist(),
        "deltas": weights[bends].tolist(),
        "season": weights[seasons].tolist(),
        "sigma": sigma,
        "converged": converged,
        "rounds": rounds,
    }


def _flat(level: float, scale: float) -> dict:
    """Parameters of a series that was seen on one day."""
    return {
        "points": 1,
        "scale": scale,
        "slope": 0.0,
        "level": level,
        "changepoints": [],
        "deltas": [],
        "season": [0.0] * (2 * (YEAR_ORDER + WEEK_ORDER)),
        "sigma": 0.0,
        "converged": True,
        "rounds": 0,
    }
