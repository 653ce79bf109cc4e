"""A small character convolutional network in numpy.

A candidate string and the characters around it are embedded, convolved and pooled: the
candidate by maximum and mean, what stands before and behind it by maximum. A convolution
never spans two of the three. One hidden layer and one unit on top give a score. Training is
Adam on the logistic loss with a fixed seed, so that reruns agree. Scores are calibrated on
findings that training did not see, and so is a threshold for each family of strings: the
highest score that still finds the wanted share of the family's true findings, moved half way
down, in logits, to the next score of a wrong one, which changes nothing on these findings and
is safest for others.

As no convolution depends on the candidate it is seen in, a text is convolved once for all of
its candidates, which are ranges of its characters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEFT, MIDDLE, RIGHT = 24, 48, 8
LENGTH = LEFT + MIDDLE + RIGHT
# Printable ASCII one by one; 0 is padding and 1 any other character.
CODES = 97
EMBED, WIDTH, INSIDE, AROUND, HIDDEN = 8, 5, 24, 8, 16
FILTERS = INSIDE + AROUND
FEATURES = 2 * INSIDE + 2 * AROUND + 1
# Places where a convolution lies within one of the three parts.
_LEFT_AT = np.arange(0, LEFT - WIDTH + 1)
_MIDDLE_AT = np.arange(LEFT, LEFT + MIDDLE - WIDTH + 1)
_RIGHT_AT = np.arange(LEFT + MIDDLE, LENGTH - WIDTH + 1)
# Families of strings, by the characters that they have.
DIGIT, LOWER, UPPER, MARK = 1, 2, 4, 8
FAMILIES = ("digits", "lower", "upper", "mixed", "marked")
FAMILY_OF_BITS = np.array(
    [4 if bits & MARK else 3 if bits & LOWER and bits & UPPER else 2 if bits & UPPER else 1 if bits & LOWER else 0 for bits in range(16)]
)
# Bins for each unit of a logit, and logits beyond which all are one bin.
BINS, FAR = 256, 64
# Characters that are convolved at once.
SPAN = 1 << 16


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def codes_of(points: np.ndarray) -> np.ndarray:
    """Codes of code points; a NUL is padding."""
    shown = np.where((points >= 32) & (points < 127), points - 30, 1)
    return np.where(points == 0, 0, shown).astype(np.uint8)


def _code_bits() -> np.ndarray:
    bits = np.zeros(CODES, np.uint8)
    for code in range(2, CODES):
        c = chr(code + 30)
        bits[code] = DIGIT if c.isdigit() else LOWER if c.islower() else UPPER if c.isupper() else MARK
    return bits


CODE_BITS = _code_bits()


def encode(windows: list[tuple[str, str, str]]) -> np.ndarray:
    """Codes of ``(left, candidate, right)``; only the first MIDDLE characters are seen."""
    texts = [
        (left[-LEFT:] if left else "").rjust(LEFT, "\0")
        + middle[:MIDDLE].ljust(MIDDLE, "\0")
        + right[:RIGHT].ljust(RIGHT, "\0")
        for left, middle, right in windows
    ]
    return codes_of(code_points("".join(texts))).reshape(len(windows), LENGTH)


def families(codes: np.ndarray) -> np.ndarray:
    """The family of each encoded window."""
    bits = np.bitwise_or.reduce(CODE_BITS[codes[:, LEFT : LEFT + MIDDLE]], axis=1, initial=0)
    return FAMILY_OF_BITS[bits]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _initial(random: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(scale: float, *shape: int) -> np.ndarray:
        return random.normal(0, scale, shape)

    return {
        "embed": normal(0.5, CODES, EMBED),
        "filters": normal(1 / np.sqrt(WIDTH * EMBED), WIDTH * EMBED, FILTERS),
        "bias": np.zeros(FILTERS),
        "hidden": normal(1 / np.sqrt(FEATURES), FEATURES, HIDDEN),
        "hidden_bias": np.full(HIDDEN, 0.1),
        "top": normal(1 / np.sqrt(HIDDEN), HIDDEN),
        "base": np.zeros(1),
    }


def _part(w: dict, x: np.ndarray, there: np.ndarray, at: np.ndarray, kernels: slice) -> tuple:
    """Columns, and what the filters give where all of their characters are there."""
    columns = np.concatenate([x[:, at + step] for step in range(WIDTH)], axis=2)
    valid = there[:, at] & there[:, at + WIDTH - 1]
    flat = columns.reshape(-1, WIDTH * EMBED) @ w["filters"][:, kernels] + w["bias"][kernels]
    a = np.maximum(flat, 0).reshape(*valid.shape, -1) * valid[:, :, None]
    return columns, a, valid


def _forward(w: dict, codes: np.ndarray) -> tuple:
    there = codes > 0
    x = w["embed"][codes] * there[:, :, None]
    parts = [
        _part(w, x, there, at, kernels)
        for at, kernels in (
            (_MIDDLE_AT, slice(0, INSIDE)),
            (_LEFT_AT, slice(INSIDE, None)),
            (_RIGHT_AT, slice(INSIDE, None)),
        )
    ]
    (_, middle, valid), (_, left, _), (_, right, _) = parts
    many = np.maximum(valid.sum(1), 1)[:, None]
    size = there[:, LEFT : LEFT + MIDDLE].sum(1)[:, None] / MIDDLE
    features = np.concatenate(
        [middle.max(1), middle.sum(1) / many, left.max(1), right.max(1), size], axis=1
    )
    inner = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
    return inner @ w["top"] + w["base"][0], parts, many, features, inner


def _gradients(w: dict, codes: np.ndarray, truth: np.ndarray, importance: np.ndarray) -> dict:
    logits, parts, many, features, inner = _forward(w, codes)
    error = (_sigmoid(logits) - truth) * importance / importance.sum()
    d_inner = error[:, None] * w["top"] * (inner > 0)
    d_features = d_inner @ w["hidden"].T
    rows = np.arange(len(codes))[:, None]
    d_x = np.zeros((len(codes), LENGTH, EMBED), d_features.dtype)
    d_filters, d_bias = np.zeros_like(w["filters"]), np.zeros_like(w["bias"])
    ends = np.cumsum([0, INSIDE, INSIDE, AROUND, AROUND])
    of_max = (d_features[:, ends[0] : ends[1]], d_features[:, ends[2] : ends[3]], d_features[:, ends[3] : ends[4]])
    kernels = (slice(0, INSIDE), slice(INSIDE, None), slice(INSIDE, None))
    for number, ((columns, a, valid), at) in enumerate(zip(parts, (_MIDDLE_AT, _LEFT_AT, _RIGHT_AT))):
        down = np.zeros_like(a)
        if number == 0:
            down += (d_features[:, ends[1] : ends[2]] / many)[:, None, :]
        down[rows, a.argmax(1), np.arange(a.shape[2])[None, :]] += of_max[number]
        down *= (a > 0) & valid[:, :, None]
        down_flat = down.reshape(-1, a.shape[2])
        d_filters[:, kernels[number]] += columns.reshape(-1, WIDTH * EMBED).T @ down_flat
        d_bias[kernels[number]] += down.sum((0, 1))
        flat = down.reshape(-1, a.shape[2]) @ w["filters"][:, kernels[number]].T
        d_columns = flat.reshape(*valid.shape, -1)
        for step in range(WIDTH):
            d_x[:, at + step] += d_columns[:, :, step * EMBED : (step + 1) * EMBED]
    d_embed = np.zeros_like(w["embed"])
    flat = d_x.reshape(-1, EMBED)
    for column in range(EMBED):
        d_embed[:, column] = np.bincount(codes.ravel(), flat[:, column], CODES)
    d_embed[0] = 0
    return {
        "embed": d_embed,
        "filters": d_filters,
        "bias": d_bias,
        "hidden": features.T @ d_inner,
        "hidden_bias": d_inner.sum(0),
        "top": inner.T @ error,
        "base": np.array([error.sum()]),
    }


def places_of(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of ranges one after the other, and where each range begins among them."""
    begins = np.cumsum(sizes) - sizes
    places = np.arange(int(sizes.sum())) + np.repeat(starts - begins, sizes)
    return places, begins


def _pooled(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, how) -> np.ndarray:
    """``how`` over ranges of rows; 0 for an empty range."""
    out = np.zeros((len(starts), values.shape[1]), values.dtype)
    some = sizes > 0
    if some.any():
        places, begins = places_of(starts[some], sizes[some])
        out[some] = how.reduceat(values[places], begins, axis=0)
    return out


@dataclass
class Network:
    """Weights, calibration and the threshold of every family."""

    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.full(len(FAMILIES), 0.5))

    def _tables(self) -> list[np.ndarray]:
        """What each pair of characters at its places of a convolution adds to the filters.

        The last place of an odd width stands alone.
        """
        w = self.weights
        plain = w["embed"].copy()
        plain[0] = 0
        each = np.einsum("ce,kef->kcf", plain, w["filters"].reshape(WIDTH, EMBED, FILTERS))
        each = each.astype(np.float32)
        pairs = [
            (each[at][:, None] + each[at + 1][None]).reshape(-1, FILTERS)
            for at in range(0, WIDTH - 1, 2)
        ]
        return [*pairs, each[-1]] if WIDTH % 2 else pairs

    def _convolved(self, tables: list[np.ndarray], part: np.ndarray) -> np.ndarray:
        """What the filters give at each place of the codes."""
        size = max(0, len(part) - WIDTH + 1)
        single = part.astype(np.int32)
        pairs = single[:-1] * CODES + single[1:]
        z = np.tile(self.weights["bias"].astype(np.float32), (size, 1))
        for number, table in enumerate(tables):
            keys = pairs if len(table) > CODES else single
            z += np.take(table, keys[2 * number : 2 * number + size], axis=0)
        return np.maximum(z, 0, out=z)

    def score_ranges(
        self, codes: np.ndarray, lows: np.ndarray, starts: np.ndarray, ends: np.ndarray, highs: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities and families of candidates ``starts`` to ``ends`` of one code array."""
        out, of = self.range_logits(codes, lows, starts, ends, highs)
        return _sigmoid(self.scale * out + self.shift), of

    def range_logits(
        self, codes: np.ndarray, lows: np.ndarray, starts: np.ndarray, ends: np.ndarray, highs: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Logits before calibration, and families, of the same candidates.

        What stands around a candidate reaches from ``lows`` to ``highs``. Ranges are in order
        of their starts; the array is convolved in spans, each once.
        """
        tables, out = self._tables(), np.zeros(len(starts))
        of = np.zeros(len(starts), np.int64)
        bits = CODE_BITS[codes]
        cuts = [*np.flatnonzero(np.diff(starts // SPAN, prepend=-1)), len(starts)]
        for first, last in zip(cuts, cuts[1:]):
            some = slice(first, last)
            begin, end = int(lows[some].min()), int(highs[some].max())
            z = self._convolved(tables, codes[begin:end])
            low, start, stop, high = (a[some] - begin for a in (lows, starts, ends, highs))
            short = lambda a, b: np.maximum(b - a - WIDTH + 1, 0)
            inside, around = z[:, :INSIDE], z[:, INSIDE:]
            many = short(start, stop)
            features = np.concatenate(
                [
                    _pooled(inside, start, many, np.maximum),
                    _pooled(inside, start, many, np.add) / np.maximum(many, 1)[:, None],
                    _pooled(around, low, short(low, start), np.maximum),
                    _pooled(around, stop, short(stop, high), np.maximum),
                    ((stop - start) / MIDDLE)[:, None],
                ],
                axis=1,
            )
            inner = np.maximum(features @ self.weights["hidden"] + self.weights["hidden_bias"], 0)
            out[some] = inner @ self.weights["top"] + self.weights["base"][0]
            seen = _pooled(bits[begin:end, None], start, stop - start, np.bitwise_or)
            of[some] = FAMILY_OF_BITS[seen[:, 0]]
        return out, of

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [_forward(self.weights, codes[at : at + 512])[0] for at in range(0, len(codes), 512)]
        return np.concatenate([np.zeros(0), *parts])

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(codes) + self.shift)

    def flagged(self, codes: np.ndarray) -> np.ndarray:
        """Which encoded windows reach the threshold of their family."""
        return self.probabilities(codes) >= self.thresholds[families(codes)]


def _calibrate(network: Network, codes: np.ndarray, truth: np.ndarray, recall: float) -> None:
    """Platt scaling, then the thresholds that keep ``recall`` of each family's true findings."""
    scores = network.logits(codes)
    positives, negatives = truth.sum(), (1 - truth).sum()
    goal = np.where(truth > 0, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    scale, shift = 1.0, 0.0
    for _ in range(200):
        now = _sigmoid(scale * scores + shift)
        miss, curve = now - goal, np.maximum(now * (1 - now), 1e-6)
        step_scale = (miss * scores).sum() / ((curve * scores**2).sum() + 1e-3)
        step_shift = miss.sum() / (curve.sum() + 1e-3)
        scale, shift = scale - 0.3 * step_scale, shift - 0.3 * step_shift
    network.scale, network.shift = float(max(scale, 1e-3)), float(shift)
    logits, family = scale * scores + shift, families(codes)
    limits = np.zeros(len(FAMILIES))
    for number in range(len(FAMILIES)):
        found = np.sort(logits[(truth > 0) & (family == number)])
        wrong = logits[(truth == 0) & (family == number)]
        if len(found):
            highest = found[int((1 - recall) * len(found))]
            below = wrong[wrong < highest]
            limits[number] = (highest + below.max()) / 2 if below.size else highest
        else:
            # A family without a true finding: well above all that is known to be wrong.
            limits[number] = max(0.0, wrong.max(initial=0.0)) + np.log(3)
    network.thresholds = _sigmoid(limits)


def binned(logits: np.ndarray) -> np.ndarray:
    """Bins of logits before calibration, by which they are counted."""
    return np.clip(np.floor(logits * BINS), -BINS * FAR, BINS * FAR).astype(np.int64)


def calibrate_by_counts(
    network: Network, codes: np.ndarray, truth: np.ndarray, counts: np.ndarray, recall: float
) -> None:
    """Thresholds that keep ``recall`` of each family's findings, of made ones and of counted ones.

    ``codes`` and ``truth`` are made findings that training did not see. ``counts`` has rows
    ``(truth, family, bin, number)`` of all findings of a table that training did not see. True
    ones stand at the lower end of their bin and wrong ones at the upper end, so that none is
    lost or let through by its place in a bin. Scale and shift decide no finding and stay.
    """
    scores, family = network.logits(codes), families(codes)
    limits = np.zeros(len(FAMILIES))
    for number in range(len(FAMILIES)):
        made = np.sort(scores[(truth > 0) & (family == number)])
        known, wrong = (
            counts[(counts[:, 0] == label) & (counts[:, 1] == number)] for label in (1, 0)
        )
        known = known[np.argsort(known[:, 2])]
        wrong = np.concatenate([scores[(truth == 0) & (family == number)], (wrong[:, 2] + 1) / BINS])
        least = [made[int((1 - recall) * len(made))]] if len(made) else []
        if len(known):
            reached = np.cumsum(known[:, 3])
            at = np.searchsorted(reached, int((1 - recall) * reached[-1]), "right")
            least.append(known[at, 2] / BINS)
        if least:
            below = wrong[wrong < min(least)]
            limits[number] = (min(least) + below.max()) / 2 if below.size else min(least)
        else:
            floor = -network.shift / network.scale
            limits[number] = max(floor, wrong.max(initial=floor)) + np.log(3) / network.scale
    network.thresholds = _sigmoid(network.scale * limits + network.shift)


def train(
    codes: np.ndarray,
    truth: np.ndarray,
    held: np.ndarray,
    recall: float = 0.95,
    epochs: int = 8,
    seed: int = 5,
    batch: int = 256,
    rate: float = 0.01,
) -> Network:
    """Train on the findings that are not ``held`` and calibrate on those that are.

    Both classes weigh the same in the loss. The caller sees to it that no finding is on both
    sides in another shape.
    """
    random = np.random.default_rng(seed)
    x, y = codes[~held], truth[~held].astype(np.float32)
    importance = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)).astype(np.float32)
    weights = {name: value.astype(np.float32) for name, value in _initial(random).items()}
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(x))
        pace = rate * (1 - 0.9 * epoch / epochs)
        for start in range(0, len(x), batch):
            chosen = order[start : start + batch]
            step += 1
            for name, slope in _gradients(weights, x[chosen], y[chosen], importance[chosen]).items():
                slope = slope + 1e-5 * weights[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                mean, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                weights[name] = weights[name] - pace * mean / (np.sqrt(spread) + 1e-8)
    network = Network({name: value.astype(float) for name, value in weights.items()})
    _calibrate(network, codes[held], truth[held].astype(float), recall)
    return network
