import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import neardup, shingles
from tests.llm.test_phrases import prose


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[at : at + size]) for at in range(len(words) - size + 1))


def brute(rows, size, percent):
    """Components of ``(doc_id, text)`` rows by comparing all of them."""
    sets = [sets_of(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * len(sets[a] | sets[b]) and sets[b]:
                root[find(a)] = find(b)
    smallest = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(at)] = min(smallest.get(find(at), doc_id), doc_id)
    out = []
    for at, (doc_id, _) in enumerate(rows):
        component = smallest.get(find(at)) if sets[at] else doc_id
        out.append((doc_id, len(sets[at]), component, doc_id == component))
    return out


def by_value(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v) for v in row))


def check(docs, size, percent):
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    found = neardup.near_duplicates(docs, size, percent).drop(neardup.TEXT_HASH).collect()
    assert by_value(map(tuple, found)) == by_value(brute(rows, size, percent))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_against_all_pairs(documents, size, percent):
    check(documents, size, percent)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, 3, 85)
    assert neardup.near_duplicates(no_docs).count() == 0
    assert neardup.deduplicated(no_docs).count() == 0
    clash = odd_docs.withColumn("node", F.lit(1)).withColumn("label", F.lit("mine"))
    check(clash, 5, 80)


def altered(text, changes, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_that_no_star_sees(make_docs):
    """Neighbours of a chain are similar, its ends are not."""
    texts = [prose(9, 300)]
    for step in range(12):
        texts.append(altered(texts[-1], 7, step))
    ends = shingles.linked(*(shingles.shingle_set(t, 3) for t in (texts[0], texts[-1])), 85)
    assert not ends
    random.Random(3).shuffle(texts)
    docs = make_docs(texts + [prose(50 + at, 80) for at in range(10)])
    check(docs, 3, 85)
    kept = neardup.near_duplicates(docs, 3, 85).where("kept").count()
    assert kept == 11


def test_group_with_many_copies_and_near_copies(make_docs):
    base = prose(5, 200)
    texts = [base] * 60 + [altered(base, 2, at) for at in range(60)] + [altered(base, 9, at) for at in range(60)]
    check(make_docs(texts), 3, 85)


def test_deduplicated_keeps_one_row_of_each_group(odd_docs):
    out = neardup.deduplicated(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [row["doc_id"] for row in out.collect()]
    assert ids.count(4) == 1 and set(range(3)) <= set(ids)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(at, at + 1) for at in range(0, 90)] + [(200, 199)], "a bigint, b bigint")
    labels = {row["node"]: row["label"] for row in neardup.components(links).collect()}
    assert all(labels[at] == 0 for at in range(91)) and labels[200] == labels[199] == 199


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for size in (8, 40, 400):
        agreed, wanted = [], []
        for _ in range(60):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            b = a.copy()
            b[: size // 8] = rng.integers(0, 2**63, size // 8, dtype=np.uint64)
            x, y = shingles.signatures([np.unique(a), np.unique(b)], 120)
            agreed.append((x == y).mean())
            wanted.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(agreed) - np.mean(wanted)) < 0.05


def test_bands_for_the_threshold():
    for similarity in (0.8, 0.85):
        bands = shingles.bands_for(similarity)
        assert (1 - similarity**shingles.ROWS) ** bands <= shingles.MISS


def test_divided_buckets_without_a_last_comparison(make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "REST_EDGES", -1)
    texts = [prose(9, 300)]
    for step in range(12):
        texts.append(altered(texts[-1], 7, step))
    check(make_docs(texts), 3, 85)
