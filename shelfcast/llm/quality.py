"""Quality rules as a short-circuit cascade.

Some measures of a text are always taken, and two rules on them decide the base verdict. The
other rules run one after the other until one rejects the text. Their order is chosen for the
corpus: a sample tells what each rule costs and how often it rejects, and the rules that
reject most per second come first. A text is kept if no rule rejects it, so the order
changes the time and never the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.batches import with_columns
from shelfcast.llm.parsing import mix
from shelfcast.llm.text import whole

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
# One-byte characters that are neither letter nor white space.
NO_LETTERS = bytes(c for c in range(128) if c not in LETTERS and c not in SPACES)
WINDOW = 8
MIN_WORDS = 20
# Documents on which costs and rejections are estimated.
SAMPLE_ROWS = 2000
SAMPLE_SEED = 17

_WEIGHTS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


class Text:
    """A text with the measures that rules share, each taken when first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.data = text.encode("utf-8", "surrogatepass")
        self.words = self.data.split()
        self.n_words = len(self.words)

    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES.decode()))

    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    def lines(self) -> tuple[int, int]:
        """Lines with a word, and how many of them equal an earlier one."""
        lines = [line for line in self.data.split(b"\n") if line.strip()]
        return len(lines), len(lines) - len(set(lines))

    def n_repeat_words(self) -> int:
        """Words that stand in a window of 8 words found twice or more."""
        count = self.n_words - WINDOW + 1
        if count < 2:
            return 0
        hashes = np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)
        sums = np.zeros(count, np.uint64)
        for place in range(WINDOW):
            sums += mix(hashes[place : place + count]) * _WEIGHTS[place]
        order = np.argsort(sums, kind="stable")
        same = sums[order[1:]] == sums[order[:-1]]
        if not same.any():
            return 0
        # Equal hashes only propose; the words decide.
        proposed = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
        windows = [tuple(self.words[at : at + WINDOW]) for at in proposed]
        times = Counter(windows)
        covered = np.zeros(self.n_words + 1, np.int64)
        for at, window in zip(proposed, windows):
            if times[window] > 1:
                covered[at] += 1
                covered[at + WINDOW] -= 1
        return int((np.cumsum(covered) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _symbols(text: Text) -> bool:
    """More than one symbol in ten words."""
    return 10 * text.n_symbols() > text.n_words


def _capitals(text: Text) -> bool:
    """Over 30% of the words have A-Z and no a-z."""
    return 10 * sum(map(bytes.isupper, text.words)) > 3 * text.n_words


def _letterless(text: Text) -> bool:
    """Over 30% of the words have neither an ASCII letter nor a character beyond ASCII."""
    lettered = len(text.data.translate(None, NO_LETTERS).split())
    return 10 * (text.n_words - lettered) > 3 * text.n_words


def _stutters(text: Text) -> bool:
    """Over 20% of the words equal the word before."""
    return 5 * sum(map(eq, text.words, text.words[1:])) > text.n_words


def _repeated_lines(text: Text) -> bool:
    """Over half of the lines equal an earlier one."""
    lines, repeated = text.lines()
    return 2 * repeated > lines


def _word_length(text: Text) -> bool:
    """Words of less than 2 or more than 15 characters on average."""
    chars = text.word_chars()
    return chars < 2 * text.n_words or chars > 15 * text.n_words


RULES = (
    Rule("symbols", _symbols),
    Rule("capitals", _capitals),
    Rule("letterless", _letterless),
    Rule("stutters", _stutters),
    Rule("repeated_lines", _repeated_lines),
    Rule("word_length", _word_length),
)


def estimates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> dict:
    """``{rule: (nanoseconds a text, share rejected)}`` on a sample of about ``rows`` texts.

    Tasks measure; the driver gets one row of sums for each rule and task.
    """
    total = docs.count()
    sample = docs.select(whole(F.col("text")).alias("text"))
    if total > rows:
        sample = sample.sample(fraction=rows / total, seed=SAMPLE_SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, count = [0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for text in map(Text, batch.column(0).to_pylist()):
                count += 1
                for at, rule in enumerate(rules):
                    start = time.perf_counter_ns()
                    rejected[at] += bool(rule.rejects(text))
                    spent[at] += time.perf_counter_ns() - start
        if count:
            columns = [[rule.name for rule in rules], spent, rejected, [count] * len(rules)]
            names = ["rule", "spent", "rejected", "texts"]
            yield pa.RecordBatch.from_pydict(dict(zip(names, columns)))

    measured = sample.mapInArrow(run, "rule string, spent bigint, rejected bigint, texts bigint")
    sums = measured.groupBy("rule").agg(F.sum("spent"), F.sum("rejected"), F.sum("texts"))
    return {row[0]: (row[1] / row[3], row[2] / row[3]) for row in sums.collect()}


def in_order(rules: tuple[Rule, ...], measured: dict) -> tuple[Rule, ...]:
    """Rules by falling rejections per cost. Rules without an estimate keep their place last."""

    def gain(rule: Rule) -> float:
        cost, share = measured.get(rule.name, (1.0, -1.0))
        return share / max(cost, 1.0)

    return tuple(sorted(rules, key=gain, reverse=True))


MEASURES = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)
SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All documents with their measures, ``base_failed`` and ``kept``.

    A NULL or empty text has no words, fails the base rules and is not kept. Rows are judged
    one by one, so ties and repeated rows play no part. Other columns stay, those of the
    new names are replaced. An empty table gives an empty result.
    """
    cascade = in_order(rules, estimates(docs, rules))

    def make():
        def work(texts: list[str]) -> dict:
            made: dict[str, list] = {name: [] for name in MEASURES.names}
            for text in map(Text, texts):
                repeats = text.n_repeat_words()
                failed = text.n_words < MIN_WORDS or 100 * repeats > 30 * text.n_words
                made["n_words"].append(text.n_words)
                made["word_chars"].append(text.word_chars())
                made["n_symbols"].append(text.n_symbols())
                made["n_dup_lines"].append(text.lines()[1])
                made["n_repeat_words"].append(repeats)
                made["base_failed"].append(failed)
                made["kept"].append(not failed and not any(r.rejects(text) for r in cascade))
            return made

        return work

    return with_columns(docs, MEASURES, SCHEMA, make)
