import re

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [
        (at, label)
        for label, phrase in licenses.PHRASES
        for at in range(len(words))
        if tuple(words[at : at + len(phrase)]) == phrase
    ]
    starts = [at for at, _ in places]
    base = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), base


def check(docs):
    expected = sorted(
        ((row["doc_id"], *brute(row["text"])) for row in docs.collect()),
        key=lambda row: tuple((v is not None, v) for v in row),
    )
    rows = licenses.scan(docs).collect()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    got = [tuple(row[name] for name in names) for row in rows]
    assert sorted(got, key=lambda row: tuple((v is not None, v) for v in row)) == expected
    for row in rows:
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs.withColumn("words", F.lit(1)).withColumn("place", F.lit("x")))
    assert licenses.scan(no_docs).count() == 0


MIT = dict((label, text) for label, text in licenses.TEMPLATES)["mit"]
FILL = "some prose that stands around "


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", "mit"),
        ("THE MIT/LICENSE: mit-license", "mit"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("Licensed under CC BY 4.0.", "cc-by"),
        (FILL * 3 + MIT + " " + FILL, "mit"),
        (FILL + MIT.replace("without restriction", "").replace("charge", "charge at all times"), "mit"),
        (FILL + " ".join(MIT.split()[:14]), ""),
        ("a license to publish under the general terms", ""),
        ("licensed under the", ""),
        ("GNU General Public License and the Apache License", "apache,gpl"),
    ],
)
def test_labels(make_docs, text, labels):
    assert licenses.scan(make_docs([text])).first()["labels"] == labels


def test_spans_are_where_the_template_is(make_docs):
    text = FILL * 2 + MIT + " " + FILL * 5 + MIT.upper()
    spans = licenses.spans(make_docs([text])).orderBy("first_word").collect()
    size, lead = len(MIT.split()), len(FILL.split())
    assert [(s["first_word"], s["end_word"], s["cover"]) for s in spans] == [
        (2 * lead, 2 * lead + size, 1.0),
        (7 * lead + size, 7 * lead + 2 * size, 1.0),
    ]


def test_no_python_and_no_text_in_exchanges(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def own_labels(make_docs, texts):
    """Labels of the method for each text, without those of base phrases."""
    rows = licenses.scan(make_docs(texts)).collect()
    found = {r["doc_id"]: set(r["labels"].split(",")) - set(r["base_labels"].split(",")) for r in rows}
    return [found[at] for at in range(len(texts))]


def test_any_part_of_a_license(make_docs):
    """Passages from the middle of licenses, at odd places: their own label and no other."""
    wanted, texts = [], []
    data = open(licenses.__file__.replace("licenses.py", "license_texts.txt")).read()
    for text in data.split("# ")[1:]:
        label, _, body = text.partition("\n")
        words = body.split()
        at = len(words) // 2 - 37
        if label in ("apache", "bsd", "gpl", "mit", "mpl", "cc0", "artistic", "gfdl"):
            wanted.append(label)
            texts.append(FILL + " ".join(words[max(at, 0) :][:75]) + " " + FILL)
    rows = licenses.scan(make_docs(texts)).collect()
    assert {row["doc_id"]: row["labels"] for row in rows} == dict(enumerate(wanted))
    assert len(set(wanted)) == 8


FAMILIES = [
    ("released under the gnu general public license version 3", {"gpl"}),
    ("released under the GNU Affero General Public License, version 3", {"agpl"}),
    ("released under the GNU Lesser General Public License 2.1", {"lgpl"}),
    ("under the Eclipse Public License", {"epl"}),
    ("under the Mozilla Public License, v. 2.0", {"mpl"}),
    ("released under the MIT label", set()),
    ("a gnu foo general public license", set()),
    ("Creative Commons 4.0", set()),
]
FAMILIES += [
    (shown.format(code.replace(" ", "-").upper(), "-".join(map(str.title, names)), v), {f"cc-{code.replace(' ', '-')}"})
    for code in licenses.CC_CODES
    for names in [[licenses.CC_NAMES[part] for part in code.split()]]
    for shown, v in (
        ("Licensed under CC {0} {2}.", "4.0"),
        ("This work is licensed under a Creative Commons {1} {2} International License.", "4.0"),
        ("Creative Commons {1} {2} Unported", "3.0"),
    )
]


def test_each_family_against_every_other(make_docs):
    base = {"gpl": "general public license", "mit": "mit license", "apache": "apache license"}
    got = own_labels(make_docs, [text for text, _ in FAMILIES])
    for (text, wanted), found in zip(FAMILIES, got):
        said = {label for label, phrase in base.items() if phrase in text.lower()}
        assert found - {""} == wanted - said, text


def test_notices_that_differ_in_one_word(make_docs):
    notices = dict((label, text) for label, text in (*licenses.TEMPLATES, *licenses.NOTICES) if "free software" in text)
    worn = {k: v.replace("you can redistribute it", "you may pass it on").replace("published by", "by") for k, v in notices.items()}
    foreign = notices["gpl"].replace("gnu general", "gnu lesser general")
    got = own_labels(make_docs, [notices["gpl"], notices["agpl"], worn["gpl"], worn["agpl"], foreign])
    assert [found - {""} for found in got] == [set(), {"agpl"}, set(), {"agpl"}, {"lgpl"}]


def test_copies_without_a_gap(make_docs):
    texts = ["the isc license " * 5, ("cc by 4 0 " * 7), (dict(licenses.TEMPLATES)["bsd"] + " ") * 3]
    assert own_labels(make_docs, texts) == [{"isc"}, {"cc-by"}, {"bsd"}]


def test_short_and_long_edits(make_docs):
    """A long notice may lose words up to its share, a short one none."""
    bsd = dict(licenses.TEMPLATES)["bsd"].split()
    rows = licenses.scan(make_docs([" ".join(bsd[:-6]), " ".join(bsd[: len(bsd) // 2]), "gnu lesser public license"]))
    got = {row["doc_id"]: (row["labels"], round(row["score"], 3)) for row in rows.collect()}
    assert got == {0: ("bsd", round(1 - 6 / len(bsd), 3)), 1: ("", 0.0), 2: ("", 0.0)}


def test_against_sql_where_licenses_stand(spark, make_docs):
    """Every family, worn notices and passages, in Spark and in DuckDB."""
    import duckdb

    from shelfcast.llm.oracles import licenses_sql

    texts = [text for text, _ in FAMILIES] + [text for _, text in licenses.all_templates()[::25]]
    texts += [" ".join(text.split()[3:] + text.split()[:9]) for _, text in licenses.passages()[::40]]
    texts += [None, "", "the mit license " * 40, FILL.join(text for text, _ in FAMILIES)]
    docs = make_docs(texts)
    documents = docs.toPandas()  # noqa: F841
    expected = duckdb.sql(licenses_sql())
    rows = licenses.scan(docs).select(*expected.columns).collect()
    plain = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    assert sorted(map(plain, rows)) == sorted(map(plain, expected.fetchall()))
    assert sum(row["labels"] != row["base_labels"] for row in rows) > 40
