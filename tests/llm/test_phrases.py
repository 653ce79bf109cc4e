import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import parsing, phrases


def texts_of(docs):
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    return [(row["doc_id"], row["text"] or "") for row in rows]


def check(docs):
    """Every row against the pairs worked out one by one."""
    rows = texts_of(docs)
    expected = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        changed = phrases.edited(text, after)
        own, new, other = (parsing.fingerprints([t]) for t in (text, changed, after))
        expected.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(changed.encode()).digest(),
                own.tobytes(),
                new.tobytes(),
                float(parsing.likeness(own, new)[0]),
                float(parsing.likeness(own, other)[0]),
            )
        )
    got = [
        tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in row)
        for row in phrases.compare_with_next(docs).collect()
    ]
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_next_document(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs, make_docs):
    check(odd_docs)
    check(make_docs(["alone"]))
    assert phrases.compare_with_next(no_docs).count() == 0
    clash = odd_docs.withColumn("fingerprint", F.lit("mine")).withColumn("part", F.lit(1))
    assert phrases.fingerprint(clash).count() == odd_docs.count()
    check(clash)


def prose(seed, words=400):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join(
        "".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words)
    )


def test_likeness_follows_what_is_shared():
    a, b = prose(1), prose(2)
    near = lambda x, y: float(parsing.likeness(*(parsing.fingerprints([t]) for t in (x, y)))[0])
    assert near(a, a) == 1.0
    assert near(a, b) < 0.1
    assert near(a, "zq " + a) > 0.9
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    assert 0.15 < near(a, half) < 0.6
    assert near("", "") == 1.0 and near("", a) == 0.0


def test_equal_substrings_share_phrases_wherever_they_stand():
    shared = prose(3)

    def names(text, level):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        symbols, starts = codes, np.array([0])
        for number in range(1, level + 1):
            symbols, starts = parsing.next_level(symbols, starts, number)
        return symbols.tolist()

    for level in (1, 2, 3):
        a, b = names("x" + shared, level), names(prose(4, 7) + shared + "!", level)
        inner = a[8:-8]
        assert any(b[at : at + len(inner)] == inner for at in range(len(b)))


def test_batching_changes_nothing(documents):
    texts = [row["text"] for row in documents.limit(60).collect()]
    texts[7:7] = ["", "a", "ab", "aaaaaaa", "aaaabbbb"]
    together = parsing.fingerprints(texts)
    alone = np.concatenate([parsing.fingerprints([text]) for text in texts])
    assert (together == alone).all()
    assert len({row.tobytes() for row in alone}) == len(set(texts))
