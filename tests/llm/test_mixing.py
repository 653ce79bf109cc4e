import re

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import mixing
from shelfcast.llm.text import DOCUMENTS


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshared(sizes, weights=(3, 1, 2), share=1.5, passes=2):
    """Targets by sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[at % len(weights)] for at, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= passes * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = float(passes * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def check(docs, rows):
    """Brute force over collected ``doc_id, text, source``."""
    sizes = {}
    for row in docs:
        sizes[row["source"]] = sizes.get(row["source"], 0) + words(row["text"])
    goals = reshared(sizes)
    taken = {}
    assert len(rows) == len(docs)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(goals[row["source"]], rel=1e-12)
        assert row["size"] == words(row["text"])
        assert 0 <= row["taken"] <= 2 * row["size"]
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
    for source, goal in goals.items():
        assert goal - 1 < taken[source] <= goal
    return goals


def test_targets_and_shares(documents):
    goals = check(documents.collect(), mixing.plan(documents).collect())
    assert sum(goals.values()) > 0


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1, "b": 1000, "c": 10},
        {"a": 1000, "b": 1, "c": 1, "d": 5, None: 30},
        {"a": 10},
        {"a": 10, "b": 10, "c": 10, "d": 10},
        {"é": 7, "z": 3, "Z": 900, None: 2},
    ],
)
def test_resharing(spark, sizes):
    rows = []
    for source, size in sizes.items():
        rows += [(len(rows), "w " * part, "en", source, 0) for part in (size - size // 2, size // 2)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    check(docs.collect(), mixing.plan(docs).collect())


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs.collect(), mixing.plan(odd_docs).collect())
    assert mixing.plan(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_reruns_and_partitions_agree(documents):
    a = mixing.plan(documents).select("doc_id", "taken").collect()
    b = mixing.plan(documents.repartition(7)).select("doc_id", "taken").collect()
    assert sorted(a) == sorted(b)


def test_budget_and_order(documents):
    planned = mixing.plan(documents, budget=10_000)
    assert abs(planned.agg(F.sum("taken")).first()[0] - 10_000) < 25
    finish = [row["finish"] for row in mixing.plan(documents).select("finish").collect()]
    known = [f for f in finish if f is not None]
    assert known == sorted(known)


def test_slices_change_nothing(documents, monkeypatch):
    a = mixing.plan(documents).select("doc_id", "taken").collect()
    monkeypatch.setattr(mixing, "slices_for", lambda rows: 57)
    b = mixing.plan(documents).select("doc_id", "taken").collect()
    assert sorted(a) == sorted(b)


def test_mixed_keeps_columns_and_copies(documents):
    out = mixing.mixed(documents.withColumn("size", F.lit("mine")))
    assert out.columns == [*documents.columns, "size"]
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    # A third of the words more than a half of all: whole texts come near the targets.
    total = documents.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    mixed_words = out.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert abs(mixed_words / total - 1.5) < 0.2
