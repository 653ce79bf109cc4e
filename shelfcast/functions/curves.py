"""The fit of ``curve`` for many series at once, as stacked normal equations.

Series of the same number of days have designs of the same shape, so that every step of their
searches is one operation on stacked arrays. A step's five reweighted ridges differ only in the
penalty of the bends: the other coefficients are eliminated once a step, and what is solved
again is as large as the number of bends. Series leave the stack when their search ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from shelfcast.functions import curve

# Numbers that a stack of designs may hold.
STACK = 1 << 22
WAVE_COUNT = 2 * (curve.YEAR_ORDER + curve.WEEK_ORDER)


def _stacks(sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of series of equal size, as many at once as a stack may hold."""
    order = np.argsort(sizes, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(some):
            size = int(sizes[some[0]])
            many = max(1, STACK // ((curve.CHANGEPOINTS + WAVE_COUNT + 2) * max(size, 1)))
            for start in range(0, len(some), many):
                yield size, some[start : start + many]


def fit_curves(
    days: list[np.ndarray], totals: list[np.ndarray], starts: list[dict | None] | None = None
) -> list[dict]:
    """``curve.fit_curve`` of each series; days are distinct and ascend within a series.

    ``starts`` may have a stored model for a series, by which its search begins if the series
    has ``curve.DAYS_TO_START`` days.
    """
    out: list = [None] * len(days)
    for size, some in _stacks(np.array([len(day) for day in days], np.int64)):
        if size < 2:
            fitted = [curve.fit_curve(days[at], totals[at]) for at in some]
        else:
            fitted = _fit_stack(
                np.array([days[at] for at in some]),
                np.array([totals[at] for at in some]),
                [starts[at] for at in some] if starts else [],
            )
        for at, row in zip(some.tolist(), fitted):
            out[at] = row
    return out


class _Stack:
    """Designs of some series, and the curves and costs of their weights."""

    def __init__(self, day: np.ndarray, target: np.ndarray):
        t = (day - day[:, :1]) / (day[:, -1:] - day[:, :1])
        places = curve.changepoint_places(t.shape[1])
        self.target, self.changes = target, t[:, places]
        bends = np.maximum(t[:, None, :] - self.changes[:, :, None], 0.0)
        self.growth = np.concatenate([t[:, None], np.ones_like(t)[:, None], bends], axis=1)
        waves = curve.fourier(day.ravel()).reshape(WAVE_COUNT, *day.shape)
        self.season = np.ascontiguousarray(waves.transpose(1, 0, 2))
        self.first_wave = self.growth.shape[1]
        self.bends = np.arange(2, self.first_wave)
        self.others = np.r_[0, 1, self.first_wave : self.first_wave + WAVE_COUNT]
        self.prior = np.zeros(self.first_wave + WAVE_COUNT)
        self.prior[:2] = curve.TREND_DEVIATION**-2
        self.prior[self.first_wave :] = curve.SEASON_DEVIATION**-2
        self.center = np.zeros((len(day), len(self.prior)))
        self.center[:, 1] = target.mean(axis=1)

    def take(self, some: np.ndarray) -> _Stack:
        """The stack of some of its series."""
        part = object.__new__(_Stack)
        part.__dict__.update(self.__dict__)
        for name in ("target", "changes", "growth", "season", "center"):
            setattr(part, name, getattr(self, name)[some])
        return part

    def curves(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        growth, season = weights[:, None, : self.first_wave], weights[:, None, self.first_wave :]
        return (growth @ self.growth)[:, 0], (season @ self.season)[:, 0]

    def cost(self, weights: np.ndarray, noise: np.ndarray) -> np.ndarray:
        trend, season = self.curves(weights)
        misfit = self.target - trend * (1.0 + season)
        bending = 2.0 / curve.CHANGE_SCALE * curve.bent(weights[:, self.bends]).sum(axis=1)
        away = ((weights - self.center) ** 2) @ self.prior
        return (misfit**2).sum(axis=1) + noise * (away + bending)

    def ridges(self, trend, season, noise, change_size) -> tuple[np.ndarray, np.ndarray]:
        """The weights after the reweighted ridges of one step, and the sizes of the bends."""
        jacobian = np.concatenate(
            [self.growth * (1.0 + season)[:, None], self.season * trend[:, None]], axis=1
        )
        gram = jacobian @ jacobian.transpose(0, 2, 1)
        moment = (jacobian @ (self.target + trend * season)[:, :, None])[:, :, 0]
        moment += noise[:, None] * self.prior * self.center
        gram[:, np.arange(len(self.prior)), np.arange(len(self.prior))] += noise[:, None] * self.prior
        others, bends = self.others, self.bends
        across = gram[:, others[:, None], bends]
        known = np.concatenate([across, moment[:, others, None]], axis=2)
        solved = np.linalg.solve(gram[:, others[:, None], others], known)
        inner = gram[:, bends[:, None], bends] - across.transpose(0, 2, 1) @ solved[:, :, :-1]
        asked = moment[:, bends, None] - across.transpose(0, 2, 1) @ solved[:, :, -1:]
        diagonal, found = np.arange(len(bends)), np.zeros_like(asked)
        for _ in range(curve.REWEIGHTINGS if len(bends) else 0):
            ridge = inner.copy()
            ridge[:, diagonal, diagonal] += noise[:, None] / (curve.CHANGE_SCALE * change_size)
            found = np.linalg.solve(ridge, asked)
            change_size = np.abs(found[:, :, 0]) + curve.SMALL_CHANGE
        best = np.empty((len(gram), len(self.prior)))
        best[:, bends] = found[:, :, 0]
        best[:, others] = (solved[:, :, -1:] - solved[:, :, :-1] @ found)[:, :, 0]
        return best, change_size


def _fit_stack(day: np.ndarray, y: np.ndarray, starts: list[dict | None] = ()) -> list[dict]:
    scale = np.abs(y).max(axis=1)
    scale[scale == 0] = 1.0
    every = _Stack(day, y / scale[:, None])
    weights, many = every.center.copy(), len(day)
    change_size = np.full(every.changes.shape, curve.CHANGE_SCALE)
    for at, start in enumerate(starts if day.shape[1] >= curve.DAYS_TO_START else ()):
        if start is not None and start["points"] > 1:
            ends = float(day[at, 0]), float(day[at, -1])
            weights[at] = curve.carried_over(start, *ends, every.changes[at], scale[at])
            change_size[at] = np.abs(weights[at, every.bends]) + curve.SMALL_CHANGE
    fitted = np.full(day.shape, np.inf)
    converged, rounds = np.zeros(many, bool), np.zeros(many, int)
    active, stack = np.arange(many), every
    for _ in range(curve.MAX_ROUNDS):
        trend, season = stack.curves(weights[active])
        now = trend * (1.0 + season)
        still = np.abs(now - fitted[active]).max(axis=1) > curve.TOLERANCE
        fitted[active] = now
        converged[active[~still]] = True
        if not still.all():
            active, stack = active[still], stack.take(still)
            trend, season, now = trend[still], season[still], now[still]
        if not len(active):
            break
        rounds[active] += 1
        sigma = np.sqrt(np.mean((stack.target - now) ** 2, axis=1))
        noise = np.maximum(sigma, curve.MIN_SIGMA) ** 2
        best, change_size[active] = stack.ridges(trend, season, noise, change_size[active])
        at = weights[active]
        step, before = best - at, stack.cost(at, noise)
        worse = stack.cost(at + step, noise) > before
        for _ in range(curve.MAX_HALVINGS):
            if not worse.any():
                break
            step[worse] /= 2
            worse[worse] = stack.take(worse).cost((at + step)[worse], noise[worse]) > before[worse]
        if worse.any():
            # No better point: converged if the curve would hardly move.
            trend, season = stack.take(worse).curves((at + step)[worse])
            moved = np.abs(trend * (1.0 + season) - now[worse]).max(axis=1)
            converged[active[worse]] = moved <= curve.TOLERANCE
        weights[active[~worse]] = (at + step)[~worse]
        change_size[active] = np.abs(weights[active][:, every.bends]) + curve.SMALL_CHANGE
        if worse.any():
            active, stack = active[~worse], stack.take(~worse)
    trend, season = every.curves(weights)
    sigma = np.sqrt(np.mean((every.target - trend * (1.0 + season)) ** 2, axis=1))
    return [
        {
            "points": day.shape[1],
            "scale": float(scale[at]),
            "slope": float(weights[at, 0]),
            "level": float(weights[at, 1]),
            "changepoints": every.changes[at].tolist(),
            "deltas": weights[at, every.bends].tolist(),
            "season": weights[at, every.first_wave :].tolist(),
            "sigma": float(sigma[at]),
            "converged": bool(converged[at]),
            "rounds": int(rounds[at]),
        }
        for at in range(many)
    ]
