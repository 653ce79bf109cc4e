from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import quality


def brute(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[at : at + 8]) for at in range(len(words) - 7))
    covered = set()
    for at in range(len(words) - 7):
        if windows[tuple(words[at : at + 8])] > 1:
            covered |= set(range(at, at + 8))
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(len(word.decode()) for word in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        repeated,
        len(covered),
        failed,
    )


def check(docs):
    rows = quality.judge(docs.select("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        got = tuple(row[name] for name in quality.MEASURES.names[:6])
        assert got == brute(row["text"])
        kept = not row["base_failed"] and not any(
            rule.rejects(quality.Text(row["text"] or "")) for rule in quality.RULES
        )
        assert row["kept"] == kept


def test_measures(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert quality.judge(no_docs).count() == 0
    clash = odd_docs.withColumn("n_words", F.lit("mine")).withColumn("more", F.lit(1))
    out = quality.judge(clash)
    assert dict(out.dtypes)["n_words"] == "bigint" and out.where("more = 1").count() == odd_docs.count()


CLEAN = "The old boat lay on the beach while people walked home from the small market town, "


@pytest.mark.parametrize(
    "rule, text",
    [
        ("symbols", CLEAN + " ".join(f"w{at}$" for at in range(30))),
        ("capitals", CLEAN + " ".join(f"LOUD{at}!!" for at in range(30))),
        ("letterless", CLEAN + " ".join(str(at) for at in range(30))),
        ("stutters", " ".join(f"word{at // 4}x" for at in range(60))),
        ("repeated_lines", "\n".join(["one line here"] * 6 + [CLEAN])),
        ("word_length", "".join(f"{'ab' * 20}{at} " for at in range(25))),
    ],
)
def test_each_rule_rejects(rule, text):
    rules = {r.name: r for r in quality.RULES}
    assert rules[rule].rejects(quality.Text(text))
    good = " ".join(f"{CLEAN} number{at}" for at in "abc")
    assert not any(r.rejects(quality.Text(good)) for r in quality.RULES)


def test_labelled_documents(spark, sf_dir):
    """Good documents stay and bad ones go, but for those that the base rules decide."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert len(rows) > 50
    wrong = [row["doc_id"] for row in rows if row["kept"] != (row["quality"] == 1)]
    assert len(wrong) <= 0.02 * len(rows)
    assert not [row for row in rows if row["quality"] == 1 and not row["kept"]]


def test_order_is_rejections_per_cost():
    rules = quality.RULES[:3]
    measured = {"symbols": (100.0, 0.1), "capitals": (10.0, 0.05), "letterless": (10.0, 0.0)}
    order = [rule.name for rule in quality.in_order(rules, measured)]
    assert order == ["capitals", "symbols", "letterless"]


def test_estimates_cover_all_rules(documents):
    measured = quality.estimates(documents)
    assert set(measured) == {rule.name for rule in quality.RULES}
    assert all(cost > 0 and 0 <= share <= 1 for cost, share in measured.values())
