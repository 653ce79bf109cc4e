"""Secret scans: fixed patterns, and a character network for what they leave out.

A candidate is every run of at least MIN_CANDIDATE key characters outside the base spans; of a
longer run than the network sees, windows at every STEP characters. The texts of a batch are
one array of characters, and runs, candidates and what stands around them are ranges of it.

What the base patterns find is known to be secret, and a candidate that consists of words,
numbers and dates is known to be harmless (``harmless``). A bounded sample of both trains the
network. All other candidates may be secrets that no pattern names, so they are no training
data. As a table may hold few findings, each also enters where harmless strings stood, and
fresh random strings of every family (hex, base 32, 62 and 64) enter in such places, bare and
inside of paths. Harmless words also enter joined, in capitals and put together anew from
their parts. A quarter of the findings, with all shapes of theirs, is held out for calibration.

The texts are read three times, for the sample, for the thresholds and for the scores, as the
windows of all candidates are larger than the texts. The sample trains the weights; thresholds
are those of the held-out findings of all texts. The first pass takes to Python only texts that
may hold a finding, and those that a hash chooses for harmless ones.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import charnet
from shelfcast.llm.batches import ranges, with_columns

# The base patterns, in their order.
KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
KEY_WORDS = ("passw", "secret", "token", "key")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
# Runs that reach the least length at once are the same ones, as both runs are maximal.
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}")
MIN_CANDIDATE = 8
# Places from one window of a long run to the next.
STEP = 16
# Parts that a harmless run may have between its marks: numbers, with the T of a time, and
# words, in lower or upper case or with a capital, with a short number behind. Words have
# vowels and no long row of consonants.
PART = re.compile(r"[0-9]{1,19}(?:T[0-9]{2})?Z?|(?:[A-Z]?[a-z]{1,19}|[A-Z]{1,19})[0-9]{0,3}", re.ASCII)
MARKS = re.compile(r"[+/_.=-]+")
ODD_WORD = re.compile(r"[^aeiouy0-9]{5}|[aeiou]{4}", re.IGNORECASE)

# Findings of each label that the network is trained on at most, and texts, about, that
# harmless ones are taken from.
LABELLED, HARMLESS_TEXTS = 2000, 2000
# Strings that are drawn for each family, and harmless strings that are made of words.
DRAWN = 700
RECALL = 0.95
SEED = 11
# The characters of the families that fresh strings are drawn from.
DIGITS, CAPITALS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    CAPITALS + "234567",
    CAPITALS + CAPITALS.lower() + DIGITS,
    CAPITALS + CAPITALS.lower() + DIGITS + "+/",
)
FRESH_SIZES = (16, 65)

SPANS = pa.schema([(name, pa.list_(pa.list_(pa.int32()))) for name in ("base", "spans")])
SPAN_TYPES = "base array<array<int>>, spans array<array<int>>"
# Kinds of training data: secrets, and harmless words, numbers and runs of several parts.
SECRET, WORD, NUMBER, PARTS = range(4)
LABELS = pa.schema([("label", pa.int32()), ("rank", pa.string()), ("w", pa.list_(pa.string()))])
COUNTS = pa.schema([(name, pa.int64()) for name in ("truth", "family", "bin", "number")])
COUNT_TYPES = "truth long, family long, bin long, number long"
LABEL_TYPES = "label int, rank string, w array<string>"


def _of_ascii(characters: str) -> np.ndarray:
    table = np.zeros(129, bool)
    table[[ord(c) for c in characters]] = True
    return table


_KEY = _of_ascii(CAPITALS + CAPITALS.lower() + DIGITS + "+/_.=-")
_HEX = _of_ascii(DIGITS + "abcdef")


def _runs(points: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` characters of the table."""
    inside = table[np.minimum(points, 128)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _places(start: int, end: int) -> list[tuple[int, int]]:
    """The run, or the windows that cover a longer one than the network sees."""
    if end - start <= charnet.MIDDLE:
        return [(start, end)]
    last = end - charnet.MIDDLE
    return [(at, at + charnet.MIDDLE) for at in (*range(start, last, STEP), last)]


class Found:
    """Base spans and candidates of some texts.

    ``points`` has the texts one after the other, NUL between them, and text ``i`` begins at
    ``begins[i]``. ``base`` has ``(start, kind, end)`` of each text in order of start and kind;
    ``starts`` and ``ends`` are the candidates of all texts, as places of ``points``.
    """

    def __init__(self, texts: list[str]):
        self.texts = texts
        sizes = np.array([len(text) for text in texts], np.int64)
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        self.finishes = self.begins + sizes
        self.points = charnet.code_points("\0".join(texts))
        self.base: list[list[list[int]]] = [_named(text) for text in texts]
        for start, end in zip(*_runs(self.points, _HEX, MIN_HEX)):
            at = self._text_at(start)
            self.base[at].append([int(start - self.begins[at]), 2, int(end - self.begins[at])])
        for spans in self.base:
            spans.sort()
        self.starts, self.ends = self._candidates()

    def _text_at(self, place) -> np.ndarray:
        return np.searchsorted(self.begins, place, "right") - 1

    def _candidates(self) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = _runs(self.points, _KEY, MIN_CANDIDATE)
        taken = [
            (begin + start, begin + end)
            for begin, spans in zip(self.begins.tolist(), self.base)
            for start, _, end in spans
        ]
        special = ends - starts > charnet.MIDDLE
        touching: dict[int, list] = {}
        for start, end in taken:
            first, last = np.searchsorted(ends, start, "right"), np.searchsorted(starts, end)
            for run in range(first, last):
                special[run] = True
                touching.setdefault(run, []).append((start, end))
        more = []
        for run in np.flatnonzero(special).tolist():
            start, end = int(starts[run]), int(ends[run])
            # Base spans may begin before a run or end behind it; what they leave of it counts.
            for a, b in sorted(touching.get(run, [])):
                if a - start >= MIN_CANDIDATE:
                    more += _places(start, a)
                start = max(start, b)
            if end - start >= MIN_CANDIDATE:
                more += _places(start, end)
        extra = np.array(more, np.int64).reshape(-1, 2)
        starts = np.concatenate([starts[~special], extra[:, 0]])
        ends = np.concatenate([ends[~special], extra[:, 1]])
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order]

    def around(self) -> tuple[np.ndarray, np.ndarray]:
        """How far what stands around each candidate reaches within its text."""
        at = self._text_at(self.starts)
        return (
            np.maximum(self.starts - charnet.LEFT, self.begins[at]),
            np.minimum(self.ends + charnet.RIGHT, self.finishes[at]),
        )

    def places(self) -> list[list[list[int]]]:
        """The candidates of each text, in its own places."""
        out: list[list] = [[] for _ in self.texts]
        at = self._text_at(self.starts)
        own = zip(at.tolist(), (self.starts - self.begins[at]).tolist(), (self.ends - self.begins[at]).tolist())
        for text, start, end in own:
            out[text].append([start, end])
        return out


def _named(text: str) -> list[list[int]]:
    """Spans of assignments and access keys."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in KEY_WORDS):
        spans += [
            [m.start(), 0, m.end()]
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= MIN_ASSIGNED
        ]
    if "AKIA" in text:
        spans += [[m.start(), 1, m.end()] for m in ACCESS.finditer(text)]
    return spans


def _window(text: str, start: int, end: int) -> list[str]:
    left = text[max(0, start - charnet.LEFT) : start]
    return [left, text[start:end], text[end : end + charnet.RIGHT]]


def _values(text: str, span: list[int]) -> list[list[str]]:
    """Windows of the secret in a base span: of an assignment, what is assigned."""
    start, kind, end = span
    if kind == 0:
        start = ASSIGN.match(text, start, end).start(2)
    return [_window(text, *place) for place in _places(start, end)]


def harmless(run: str) -> int | None:
    """WORD, NUMBER or PARTS if the run is known to be no secret, else None."""
    parts = [part for part in MARKS.split(run) if part]
    for part in parts:
        if not PART.fullmatch(part) or (not part[0].isdigit() and ODD_WORD.search(part)):
            return None
    if len(parts) == 1 and len(parts[0]) == len(run):
        return NUMBER if run.isdigit() else WORD
    return PARTS


def find(text: str) -> tuple[list, list, list, list]:
    """Base spans and their windows, and the candidates outside of them with theirs."""
    found = Found([text])
    (base,), (places,) = found.base, found.places()
    return (
        base,
        [window for span in base for window in _values(text, span)],
        places,
        [_window(text, *place) for place in places],
    )


def _labelled(rows, labelled: int) -> pa.RecordBatch:
    """The first training data of each label by hash, of ``(text, for harmless ones)``."""
    chosen = [{} for _ in range(PARTS + 1)]
    for text, harmless_too in rows:
        found = Found([text])
        (base,) = found.base
        known = [(SECRET, w) for span in base for w in _values(text, span)]
        if harmless_too:
            (places,) = found.places()
            known += [
                (label, _window(text, *place))
                for place in places
                if (label := harmless(text[slice(*place)])) is not None
            ]
        for label, w in known:
            key = tuple(w)
            if key not in chosen[label]:
                joined = "\0".join(key).encode("utf-8", "surrogatepass")
                chosen[label][key] = hashlib.md5(joined).hexdigest()
            if len(chosen[label]) > 8 * labelled:
                chosen[label] = dict(heapq.nsmallest(labelled, chosen[label].items(), lambda x: (x[1], x[0])))
    out = [
        (label, rank, list(w))
        for label, ranks in enumerate(chosen)
        for w, rank in heapq.nsmallest(labelled, ranks.items(), lambda x: (x[1], x[0]))
    ]
    columns = zip(*out) if out else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, LABELS)], LABELS.names
    )


def _sample(labels: DataFrame, label: int, rows: int) -> list[tuple[str, str, str]]:
    """At most ``rows`` different windows, the first ones by hash: the same in every run."""
    windows = labels.where(F.col("label") == label).select("rank", "w").distinct()
    return [tuple(row["w"]) for row in windows.orderBy("rank", "w").limit(rows).collect()]


def _held(middle: str) -> bool:
    """Whether a finding is kept for calibration, in whatever shape and place it comes."""
    return hashlib.md5(middle.encode("utf-8", "surrogatepass")).digest()[0] < 64


class _Drawing:
    """Training data made of findings; places and words are of one side of the split alone."""

    def __init__(self, others: list[tuple[str, str, str]], held: bool):
        self._random, self._side = np.random.default_rng(SEED + held), held
        self._places = [(left, right) for left, _, right in others] or [("", "")]
        self._paths = [m for _, m, _ in others if MARKS.search(m)] or ["path/of/words"]
        words = [word for _, m, _ in others for word in MARKS.split(m) if word.isalpha()]
        self._words = [word.lower() for word in words] or ["words", "around"]

    def _pick(self, some):
        return some[int(self._random.integers(0, len(some)))]

    def fresh(self, letters: str) -> tuple[str, str, str]:
        """A random string where a harmless one stood, one in three inside of a path."""
        size = int(self._random.integers(*FRESH_SIZES))
        text = "".join(letters[i] for i in self._random.integers(0, len(letters), size))
        text += self._pick(("", "", "=", "==")) if "/" in letters else ""
        left, right = self._pick(self._places)
        if self._random.random() < 1 / 3:
            path, mark = self._pick(self._paths), self._pick("/=.-_")
            shown = path[-int(self._random.integers(1, 25)) :] + mark + text
            return left, shown[: charnet.MIDDLE], right
        if len(text) > charnet.MIDDLE:
            start = int(self._random.integers(0, len(text) - charnet.MIDDLE + 1))
            left = (left + text[:start])[-charnet.LEFT :]
            right = (text[start + charnet.MIDDLE :] + right)[: charnet.RIGHT]
            text = text[start : start + charnet.MIDDLE]
        return left, text, right

    def moved(self, middle: str) -> tuple[str, str, str]:
        left, right = self._pick(self._places)
        return left, middle, right

    def words(self) -> str:
        """Words joined, some put together anew of their parts, in one of many spellings.

        The string itself decides, as a finding does, on which side of the split it is.
        """
        while _held(spelled := self._spelled()) != self._side:
            pass
        return spelled

    def _spelled(self) -> str:
        picked = [self._pick(self._words) for _ in range(int(self._random.integers(1, 4)))]
        if self._random.random() < 0.6:
            joined = "".join(picked)
            parts = [joined[at : at + 3] for at in range(0, len(joined), 3)]
            self._random.shuffle(parts)
            picked = ["".join(parts)]
        style = int(self._random.integers(0, 5))
        spelled = [
            lambda: "".join(picked).upper(),
            lambda: "".join(picked).capitalize(),
            lambda: "".join(word.capitalize() for word in picked),
            lambda: self._pick("_-./").join(picked),
            lambda: "".join(picked),
        ][style]()
        if self._random.random() < 0.3:
            spelled += self._pick((".", "=", "2", ".77", "-12", "/"))
        return spelled[: charnet.MIDDLE].ljust(MIN_CANDIDATE, "e")


def _training(secrets: list, others: list, held: bool, drawn: int) -> tuple[list, list]:
    """Secret and harmless windows of one side of the split."""
    secrets = [w for w in secrets if _held(w[1]) == held]
    others = [w for w in others if _held(w[1]) == held]
    drawing = _Drawing(others, held)
    positives = secrets + [drawing.moved(middle) for _, middle, _ in secrets]
    positives += [drawing.fresh(letters) for letters in ALPHABETS for _ in range(drawn)]
    negatives = others + [drawing.moved(drawing.words()) for _ in range(3 * drawn)]
    # Wrong in the other direction: harmless strings after a secret's key word stay harmless.
    for at, (_, middle, right) in enumerate(others[::2] if secrets else []):
        negatives.append((secrets[at % len(secrets)][0], middle, right))
    return positives, negatives


def _held_counts(texts: list[str], network: charnet.Network) -> np.ndarray:
    """Rows ``(truth, family, bin)`` of all findings that are held out, in whatever text."""
    found = Found(texts)
    joined = "\0".join(texts)
    keys = zip(found.starts.tolist(), found.ends.tolist())
    runs = [joined[start:end] for start, end in keys]
    own = np.array([_held(run) and harmless(run) is not None for run in runs], bool)
    lows, highs = found.around()
    lows, starts, ends, highs = (a[own] for a in (lows, found.starts, found.ends, highs))
    # Only what stands in and around these is convolved.
    seen, begins = charnet.places_of(lows, highs - lows)
    moved = begins - lows
    logits, family = network.range_logits(
        charnet.codes_of(found.points[seen]), begins, starts + moved, ends + moved, highs + moved
    )
    windows = [w for text, spans in zip(texts, found.base) for span in spans for w in _values(text, span)]
    codes = charnet.encode([w for w in windows if _held(w[1])])
    truth = np.repeat([0, 1], [len(logits), len(codes)])
    family = np.concatenate([family, charnet.families(codes)])
    bins = charnet.binned(np.concatenate([logits, network.logits(codes)]))
    return np.stack([truth, family, bins], axis=1)


def counted(docs: DataFrame, network: charnet.Network) -> np.ndarray:
    """``truth, family, bin, number`` of the held-out findings of all texts.

    A task returns a row for each bin that it met, and Spark adds them up. Findings count as
    often as they occur.
    """

    def run(batches):
        total = Counter()
        for batch in batches:
            for start, stop in ranges(batch.column(0)):
                texts = batch.column(0).slice(start, stop - start).to_pylist()
                rows, numbers = np.unique(_held_counts(texts, network), axis=0, return_counts=True)
                total.update(dict(zip(map(tuple, rows.tolist()), numbers.tolist())))
        columns = zip(*((*row, number) for row, number in total.items())) if total else ([],) * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=COUNTS)

    texts = docs.where("text IS NOT NULL").select("text")
    summed = texts.mapInArrow(run, COUNT_TYPES).groupBy("truth", "family", "bin").agg(F.sum("number"))
    return np.array([tuple(row) for row in summed.collect()], np.int64).reshape(-1, 4)


def trained(docs: DataFrame, labelled: int = LABELLED, recall: float = RECALL, drawn: int = DRAWN):
    """The network, or None if the texts have fewer than 8 harmless strings.

    At most ``labelled`` findings of each label come to the driver and train the weights; no
    window but the chosen ones leaves its Python worker. The thresholds are those of the
    held-out findings of all texts, which are counted where they are (``counted``).
    """

    def run(batches):
        for batch in batches:
            for start, stop in ranges(batch.column(0)):
                part = batch.slice(start, stop - start)
                yield _labelled(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), labelled)

    texts = docs.where("text IS NOT NULL").select("text")
    every = max(1, texts.count() // HARMLESS_TEXTS)
    lowered = F.lower("text")
    named = F.contains("text", F.lit("AKIA")) | F.rlike("text", F.lit(f"[0-9a-f]{{{MIN_HEX}}}"))
    for word in KEY_WORDS:
        named = named | F.contains(lowered, F.lit(word))
    asked = texts.withColumn("harmless", F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    labels = asked.where(F.col("harmless") | named).mapInArrow(run, LABEL_TYPES).persist()
    secrets = _sample(labels, SECRET, labelled)
    # Every kind of harmless runs has a share, however common words are.
    kinds = [_sample(labels, kind, labelled) for kind in (WORD, NUMBER, PARTS)]
    labels.unpersist()
    share = -(-labelled // len(kinds))
    others = [w for kind in kinds for w in kind[:share]]
    others = (others + [w for kind in kinds for w in kind[share:]])[:labelled]
    if len(others) < 8:
        return None
    windows, truth, held = [], [], []
    for side in (False, True):
        sides = _training(secrets, others, side, drawn // 3 if side else drawn)
        for label, some in zip((1, 0), sides):
            windows += some
            truth += [label] * len(some)
            held += [side] * len(some)
    codes, truth, held = charnet.encode(windows), np.array(truth), np.array(held)
    network = charnet.train(codes, truth, held, recall)
    charnet.calibrate_by_counts(network, codes[held], truth[held], counted(docs, network), recall)
    return network


def _merged(places) -> list[list[int]]:
    """Spans of candidates; windows of one run that overlap are one."""
    model, spans = len(KINDS) - 1, []
    for start, end in places:
        if spans and start <= spans[-1][2]:
            spans[-1][2] = max(end, spans[-1][2])
        else:
            spans.append([start, model, end])
    return spans


def scan(docs: DataFrame, labelled: int = LABELLED, recall: float = RECALL) -> DataFrame:
    """All documents but their text, with ``base`` and ``spans``.

    Both are arrays of ``[start, kind, end]`` in code points, the end exclusive, ordered by
    start and kind (a place in KINDS); ``spans`` has the base spans and the network's. A NULL
    text counts as an empty one: no spans. Rows are scanned one by one, so repeated ids and
    rows stay, and long texts are convolved in parts. Other columns stay, those of the new
    names are replaced. An empty table gives an empty result, and one with hardly any harmless
    strings the base spans only.
    """
    kept = [c for c in docs.columns if c not in ("base", "spans", "text")]
    network = trained(docs, labelled, recall)

    def work(texts: list[str]) -> dict:
        found, new = Found(texts), [[] for _ in texts]
        if network is not None and len(found.starts):
            lows, highs = found.around()
            codes = charnet.codes_of(found.points)
            scores, family = network.score_ranges(codes, lows, found.starts, found.ends, highs)
            sure = scores >= network.thresholds[family]
            hits = np.flatnonzero(sure)
            at = found._text_at(found.starts[hits])
            for text in dict.fromkeys(at.tolist()):
                own = hits[at == text]
                starts, ends = found.starts[own], found.ends[own]
                places = zip((starts - found.begins[text]).tolist(), (ends - found.begins[text]).tolist())
                new[text] = _merged(places)
        return {
            "base": found.base,
            "spans": [sorted(base + more) for base, more in zip(found.base, new)],
        }

    return with_columns(docs, SPANS, SPAN_TYPES, lambda: work, keep=kept)


def as_text(spans):
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s[1]), s[0], s[2])
    return F.array_join(F.transform(spans, one), ",")
