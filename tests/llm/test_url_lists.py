import datetime

from pyspark.sql import functions as F

from shelfcast.llm import url_lists
from tests.conftest import day

CHANGES = "list string, entry string, action string, day date"
CAPTURES = "page_id bigint, url string, fetched date"


def brute(captures, changes):
    """Walk every entry's changes up to each capture's day."""
    held = {}
    for name, entry, action, when in changes:
        if None not in (name, entry, action, when):
            held.setdefault((name, entry), {}).setdefault(when, set()).add(action)
    out = []
    for page, url, fetched in captures:
        active = []
        host = rest = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            for end in "?#":
                rest = rest.split(end, 1)[0]
            host, _, path = rest.partition("/")
            host = host.rsplit("@", 1)[-1].split(":", 1)[0].lower()
            parts = path.split("/")
        for (name, entry), dated in held.items():
            before = [when for when in dated if fetched and when <= fetched]
            if not host or not before or "add" not in dated[max(before)]:
                continue
            labels = host.split(".")
            above = [".".join(labels[at:]) for at in range(1, len(labels) - 1)]
            below = [
                host + "/" + "/".join(parts[:depth])
                for depth in (1, 2)
                if len(parts) >= depth and all(parts[:depth])
            ]
            if entry in [host, *above, *below]:
                active.append((len(entry), name == "allow", name, entry))
        verdict = max(active)[2] if active else "none"
        shown = ",".join(sorted(f"{name}:{entry}" for _, _, name, entry in active))
        out.append((page, url, fetched, len(active), shown, verdict, verdict == "deny"))
    return out


def by_value(rows):
    return sorted(map(tuple, rows), key=lambda row: tuple((v is not None, v) for v in row))


def check(spark, captures, changes):
    pages = spark.createDataFrame(captures, CAPTURES)
    lists = spark.createDataFrame(changes, CHANGES)
    found = url_lists.judge(pages, lists).collect()
    assert by_value(found) == by_value(brute(captures, changes))


LISTS = [
    ("deny", "bad.org", "add", day("2020-02-01")),
    ("deny", "bad.org", "remove", day("2020-03-01")),
    ("deny", "bad.org", "add", day("2021-01-01")),
    ("allow", "news.bad.org", "add", day("2020-02-10")),
    ("deny", "news.bad.org/ads", "add", day("2020-02-10")),
    ("allow", "news.bad.org/ads", "add", day("2020-02-20")),
    ("deny", "twice.org", "add", day("2020-01-01")),
    ("deny", "twice.org", "add", day("2020-01-05")),
    ("deny", "twice.org", "remove", day("2020-01-09")),
    ("deny", "twice.org", "remove", day("2020-01-11")),
    ("deny", "same.org", "remove", day("2020-01-01")),
    ("deny", "same.org", "add", day("2020-01-01")),
    ("deny", None, "add", day("2020-01-01")),
    ("deny", "no.day", "add", None),
]
URLS = [
    "http://bad.org/x",
    "https://user:pw@NEWS.bad.org:8080/ads/1?q=/y#z",
    "http://news.bad.org/",
    "http://a.b.bad.org",
    "http://twice.org//double",
    "http://same.org/a/b/c",
    "http://localhost/a",
    "no url",
    "",
    None,
]
DAYS = ["2019-12-31", "2020-01-01", "2020-01-08", "2020-01-09", "2020-01-31", "2020-02-01"]
DAYS += ["2020-02-10", "2020-02-29", "2020-03-01", "2022-05-05"]


def test_every_url_on_every_day(spark):
    captures = [(at, url, day(d)) for at, url in enumerate(URLS) for d in DAYS]
    check(spark, [*captures, (None, URLS[0], day(DAYS[7])), (5, URLS[0], None)], LISTS)


def test_repeated_rows_and_empty_tables(spark):
    row = (1, "http://bad.org/x", day("2020-02-05"))
    check(spark, [row, row, row], LISTS)
    check(spark, [row], [])
    check(spark, [], LISTS)
    check(spark, [], [])


def test_extra_columns_do_not_matter(spark):
    pages = spark.createDataFrame([(1, "http://bad.org/x", day("2020-02-05"))], CAPTURES)
    pages = pages.withColumn("entry", F.lit("mine")).withColumn("list", F.lit(1))
    lists = spark.createDataFrame(LISTS, CHANGES).withColumn("url", F.lit("x"))
    assert url_lists.judge(pages, lists).first()["blocked"]


def test_a_host_with_most_captures(spark):
    first = datetime.date(2020, 1, 1)
    captures = [(at, f"http://hot.org/p{at % 3}", first + datetime.timedelta(at % 500)) for at in range(3000)]
    changes = [
        ("deny", "hot.org", ("add", "remove")[at % 2], first + datetime.timedelta(at * 37))
        for at in range(12)
    ]
    check(spark, captures, changes)


def test_intervals(spark):
    rows = url_lists.intervals(spark.createDataFrame(LISTS, CHANGES)).where("list = 'deny'").collect()
    spans = {(r["entry"], str(r["valid_from"]), str(r["valid_to"])) for r in rows}
    assert ("bad.org", "2020-02-01", "2020-03-01") in spans
    assert ("bad.org", "2021-01-01", "9999-12-31") in spans
    assert ("twice.org", "2020-01-01", "2020-01-09") in spans
    assert ("same.org", "2020-01-01", "9999-12-31") in spans and len(spans) == 5


def test_deep_entries_and_parent_domains(spark):
    """Entries of any depth hold, with those of the domains above the host."""
    start, seen = day("2020-01-01"), day("2020-06-01")
    entries = ["org", "b.org", "a.b.org/1/2/3", "a.b.org/1/2/3/4/5", "a.b.org/1//3", "a.b.org/x/y/z"]
    changes = [("deny", entry, "add", start) for entry in entries]
    urls = ["https://a.b.org/1/2/3/4/5/6?q#f", "http://u@A.b.org:80/1/2/3", "http://a.b.org/1/2", "http://a.b.org/1//3"]
    captures = spark.createDataFrame([(at, url, seen) for at, url in enumerate(urls)], CAPTURES)
    rows = url_lists.judge(captures, spark.createDataFrame(changes, CHANGES)).collect()
    assert {row["page_id"]: row["active"] for row in rows} == {
        0: "deny:a.b.org/1/2/3,deny:a.b.org/1/2/3/4/5,deny:b.org",
        1: "deny:a.b.org/1/2/3,deny:b.org",
        2: "deny:b.org",
        3: "deny:b.org",
    }
