"""URL filters by a temporal list join.

Lists change: an entry is added on one day and removed on another. The dated changes of each
entry become intervals in which it is valid, and every capture is judged by the entries that
were valid on the day it was fetched, not by the lists of today.

An entry names a host, which stands for its subdomains too, or a host and the start of a
path. A capture looks for its own host, the domains above it and the starts of its path, as
deep as the deepest entry, so the as-of join is an equality on the entry and on a time slice, and a comparison of days.
Slices spread a host with very many captures over the time in which they were made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADD, REMOVE = "add", "remove"
ALLOW, DENY = "allow", "deny"
# Days of a time slice.
SLICE_DAYS = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
ENDLESS = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty without one."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def path_start(url: Column, depth: int) -> Column:
    """The first ``depth`` path segments, empty if there are fewer."""
    return F.regexp_extract(url, PATH + "(" + "/[^/?#]+" * depth + ")", 1)


def keys_of(url: Column, depth: int) -> Column:
    """Every entry that would cover the URL: host, domains above it, starts of the path.

    Of the path at most ``depth`` segments.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    count = F.size(labels)
    none = F.array().cast("array<int>")
    above = F.transform(
        F.when(count > 2, F.sequence(F.lit(2), count - 1)).otherwise(none),
        lambda at: F.array_join(F.slice(labels, at, count - at + 1), "."),
    )
    # The first piece is the empty one before the first slash.
    pieces = F.split(F.regexp_extract(url, PATH + "((?:/[^/?#]+)*)", 1), "/")
    deepest = F.least(F.size(pieces) - 1, F.lit(depth))
    below = F.transform(
        F.when(deepest > 0, F.sequence(F.lit(1), deepest)).otherwise(none),
        lambda at: F.concat(host, F.array_join(F.slice(pieces, 1, at + 1), "/")),
    )
    keys = F.array_compact(F.concat(F.array(host), above, below))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def depth_of(changes: DataFrame) -> int:
    """Path segments of the deepest entry."""
    slashes = F.length(F.regexp_replace("entry", "[^/]", ""))
    return changes.agg(F.max(slashes)).first()[0] or 0


def intervals(changes: DataFrame) -> DataFrame:
    """``list, entry, valid_from, valid_to``: days ``valid_from <= day < valid_to``.

    ``changes`` has ``list, entry, action, day``. A change holds until the next one of its
    entry; of several on one day, add wins. Adding twice or removing what is not there
    changes nothing. Changes with a NULL in any of the four count for nothing.
    """
    known = changes.select("list", "entry", "action", "day").dropna()
    daily = known.groupBy("list", "entry", "day").agg(
        F.max((F.col("action") == ADD).cast("int")).alias("added")
    )
    in_turn = Window.partitionBy("list", "entry").orderBy("day")
    turned = daily.withColumn("before", F.coalesce(F.lag("added").over(in_turn), F.lit(0))).where(
        "added <> before"
    )
    until = F.coalesce(F.lead("day").over(in_turn), F.lit(ENDLESS).cast("date"))
    return (
        turned.withColumn("valid_to", until)
        .where("added = 1")
        .select("list", "entry", F.col("day").alias("valid_from"), "valid_to")
    )


def _slice(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SLICE_DAYS).cast("int")


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """The captures with ``n_active, active, verdict, blocked``.

    ``captures`` has ``page_id, url, fetched``. ``active`` joins the entries that were valid
    as ``list:entry``, sorted, by commas. The longest entry decides, of equally long ones
    an allowing one; ``verdict`` is its list, or ``none``. A NULL or odd URL has no host and
    matches nothing, and so does a NULL day. Rows that repeat a page, a URL and a day are
    judged alike and all returned. Other columns do not matter and are not returned.
    """
    rows = captures.select("page_id", "url", "fetched")
    depth = depth_of(changes)
    asked = rows.distinct().select(
        "page_id",
        "url",
        "fetched",
        F.explode(keys_of(F.col("url"), depth)).alias("entry"),
        _slice(F.col("fetched")).alias("time_slice"),
    )
    valid = intervals(changes)
    # Open intervals end with the last capture, so that they have as many slices as matter.
    span = rows.agg(F.min("fetched").alias("first"), F.max("fetched").alias("last")).first()
    low, high = F.lit(span["first"]), F.lit(span["last"])
    sliced = valid.where((F.col("valid_from") <= high) & (F.col("valid_to") > low)).withColumn(
        "time_slice",
        F.explode(
            F.sequence(
                _slice(F.greatest(F.col("valid_from"), low)),
                _slice(F.least(F.date_sub("valid_to", 1), high)),
            )
        ),
    )
    hits = asked.join(sliced, ["entry", "time_slice"]).where(
        (F.col("fetched") >= F.col("valid_from")) & (F.col("fetched") < F.col("valid_to"))
    )
    rank = F.struct(F.length("entry"), (F.col("list") == ALLOW).cast("int"), "list")
    found = hits.groupBy("page_id", "url", "fetched").agg(
        F.count("*").alias("n_active"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "list", "entry"))), ",").alias("active"),
        F.max_by("list", rank).alias("verdict"),
    )
    found = found.select(
        F.col("page_id").alias("_id"),
        F.col("url").alias("_url"),
        F.col("fetched").alias("_day"),
        "n_active",
        "active",
        "verdict",
    )
    same = (
        rows["page_id"].eqNullSafe(found["_id"])
        & rows["url"].eqNullSafe(found["_url"])
        & rows["fetched"].eqNullSafe(found["_day"])
    )
    verdict = F.coalesce("verdict", F.lit("none"))
    return rows.join(found, same, "left").select(
        "page_id",
        "url",
        "fetched",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("active", F.lit("")).alias("active"),
        verdict.alias("verdict"),
        (verdict == DENY).alias("blocked"),
    )
