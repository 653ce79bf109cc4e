import re

from pyspark.sql import functions as F

from shelfcast.llm import pii
from shelfcast.llm.text import DOCUMENTS

# The base patterns as they are stated; matches that fail their test are dropped.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for at, c in enumerate(reversed(digits)):
        value = int(c) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    spans = []
    for number, (kind, pattern) in enumerate(STATED.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(part) <= 255 for part in match.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((number, match.start(), match.end()))
    return spans


def check(docs):
    key = F.xxhash64("text").alias("h")
    wanted = [
        (row["doc_id"], row["h"], brute(row["text"]))
        for row in docs.select("doc_id", key, "text").collect()
    ]
    rows = pii.personal_data(docs).collect()
    got = [(row["doc_id"], row[1], [tuple(s) for s in row["base"]]) for row in rows]
    in_order = lambda row: ((row[0] is not None, row[0]), row[1])
    assert sorted(got, key=in_order) == sorted(wanted, key=in_order)
    for row in rows:
        assert set(row["base"]) <= set(row["spans"])


TRICKY = [
    "a@b.c_x@y.z a@b@c.d .@-.- x@y. x@.y me%+@sub.dom-ain.org.",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 0255.1.1.1 00256.1.1.1 1.2.3 1.2.3.4 999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111x4111111111111111 4111  1111 1111 1111",
    "4111 1111 1111 1111 1 4111111111111112 12345678901234567890 4222222222222222227",
    "+1 (555) 010-9999. +12 +1-2-3 +49 30 1234567 8901234 +1 (555) 010-9999+2 (555) 010-9999",
    "é💥 a@b.cd 💥 1.1.1.1 日本+81 3-1234-5678é",
    "1" * 3000 + "." + "9" * 500,
    "+" + "1" * 2000,
    "a." * 5000 + "@x",
    "12 " * 4000,
]


def test_documents(documents):
    check(documents)


def test_tricky_texts(make_docs):
    check(make_docs(TRICKY))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs.withColumn("base", F.lit(1)).withColumn("spans", F.lit("mine")))
    assert pii.personal_data(no_docs).count() == 0
    assert pii.redact(no_docs).count() == 0


def contacts(spark, strange):
    """Addresses behind a phrase that announces them, strange ones too, and other numbers."""
    rows = [f"Some words, contact: user{at}@mail{at}.org thanks number {at}." for at in range(40)]
    rows += [f"Some words, contact: {text} thanks number 3." for text in strange]
    rows += [f"The part no. 77{at:04d}x of the list." for at in range(60)]
    return spark.createDataFrame(
        [(at, text, "en", "s", len(text)) for at, text in enumerate(rows)], DOCUMENTS
    )


def test_patterns_find_what_no_rule_describes(spark):
    strange = ["u90210(at)mail(dot)org", "user-2217#chat"]
    docs = contacts(spark, strange)
    found = {}
    for row in pii.personal_data(docs).collect():
        for span in set(row["spans"]) - set(row["base"]):
            found[row["doc_id"]] = span
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    values = sorted(texts[at][s["start"] : s["end"]] for at, s in found.items())
    assert values == sorted(strange)
    assert {s["kind"] for s in found.values()} == {0}


def test_weak_patterns_find_nothing(spark):
    """A word before few seeds, or before as many other tokens, is no pattern."""
    rows = [f"write to user{at}@mail.org or to line{at}4444 now" for at in range(30)]
    rows += ["rare: one@mail.org", "rare: 55512345x"]
    docs = spark.createDataFrame([(at, t, "en", "s", 0) for at, t in enumerate(rows)], DOCUMENTS)
    for row in pii.personal_data(docs).collect():
        assert row["base"] == row["spans"]


def test_copies_add_no_support(spark):
    rows = ["contact: user1@mail.org thanks"] * 50 + ["contact: u90210(at)mail thanks"]
    docs = spark.createDataFrame([(at, t, "en", "s", 0) for at, t in enumerate(rows)], DOCUMENTS)
    assert all(row["base"] == row["spans"] for row in pii.personal_data(docs).collect())


def test_redact(spark):
    docs = contacts(spark, ["u90210(at)mail(dot)org"]).withColumn("more", F.lit(1))
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {row["doc_id"]: row["text"] for row in out.collect()}
    assert texts[0] == "Some words, contact: [EMAIL] thanks number 0."
    assert texts[40] == "Some words, contact: [EMAIL] thanks number 3."
    assert texts[41].startswith("The part no. 77")
    assert all(row["n_chars"] == len(row["text"]) for row in out.collect())


def test_redact_odd_rows(odd_docs):
    before = sorted(str(row["text"]) for row in odd_docs.collect())
    assert sorted(str(row["text"]) for row in pii.redact(odd_docs).collect()) == before


def test_overlapping_spans(make_docs):
    text = "see +1.22.33.44 and 4111 1111 1111 1111"
    assert pii.redact(make_docs([text])).first()["text"].startswith("see ")


def test_no_python(documents):
    plan = pii.redact(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_seed_before_many_words_is_one_seed(spark):
    rows = [f"contact: user1@mail.org word{chr(97 + at)} more" for at in range(20)]
    rows += [f"word{chr(97 + at)} user1@mail.org thanks" for at in range(20)]
    rows += ["contact: 2024-05-06 then", "see 2024-05-06 thanks"]
    docs = spark.createDataFrame([(at, t, "en", "s", 0) for at, t in enumerate(rows)], DOCUMENTS)
    assert all(row["base"] == row["spans"] for row in pii.personal_data(docs).collect())
