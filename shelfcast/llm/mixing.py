"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a queue that is served at a rate equal to its target, so that all of them
reach their targets at virtual time 1. Within its queue a document waits in shuffled order;
its virtual finish time is the queue's cumulative size, itself included, divided by the
target. A second pass over the queue follows the first. Ordering by finish time interleaves
the sources in their target proportions, and cutting at the virtual time at which the total
budget is used up gives every source its share, to the word.

No window holds more than a slice of a source: a queue is dealt into slices of the shuffle
key, whose totals are summed first. A slice then starts from the sum of the slices before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import put_back, set_aside, word_count
from shelfcast.sources.settled import settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
# How often a document may be used.
PASSES = 2
ROWS_PER_SLICE = 2000
HEX_DIGITS = 5

KEY, SLICE, SOURCE = "_shuffle_key", "_slice", "_source"
PLANNED = ("size", "source_size", "target", "finish", "last_finish", "taken")


def shuffle_key(seed: int = 0) -> Column:
    """Hex key that orders a queue; it depends on the id alone, so that reruns agree."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def slices_for(rows: int, rows_per_slice: int = ROWS_PER_SLICE) -> int:
    """Number of key ranges, a power of 16 fraction, so that a slice stays small."""
    wanted = max(1, math.ceil(rows / rows_per_slice))
    return min(wanted, 16**HEX_DIGITS)


def queued(docs: DataFrame, slices: int, seed: int = 0) -> DataFrame:
    """Documents with size, shuffle key and the key range that they fall into.

    Sources are wrapped in a struct, so that NULL is a source like any other in joins.
    """
    prefix = F.conv(F.substring(KEY, 1, HEX_DIGITS), 16, 10).cast("long")
    return (
        docs.withColumn("size", word_count(F.col("text")))
        .withColumn(KEY, shuffle_key(seed))
        .withColumn(SLICE, F.floor(prefix * slices / 16**HEX_DIGITS).cast("int"))
        .withColumn(SOURCE, F.struct(F.col("source").alias("name")))
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES):
    """Target of every source: ``share`` of all sizes by weight, at most ``passes`` times its own.

    ``sizes`` has one row per source. With L words per unit of weight, a source takes
    ``min(passes * size, L * weight)``. Sources fill up in order of ``passes * size /
    weight``, so L follows from running sums in that order. Whole numbers are summed, so
    the order of summing cannot change a result. The two windows hold one row per source.
    """
    by_name = Window.orderBy(F.col(f"{SOURCE}.name").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(cycle, (place + 1).cast("int")).cast("long"))
    by_fill = Window.orderBy(F.col("ratio"), F.col(f"{SOURCE}.name").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        weighted.withColumn("ratio", F.lit(passes) * F.col("source_size") / F.col("weight"))
        .withColumn("full_size", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    level = (F.lit(float(share)) * F.col("all_size") - passes * F.col("full_size")) / (
        F.col("all_weight") - F.col("full_weight")
    )
    # The first source, in order of filling up, that the level does not fill. Counting a
    # source as full that is not takes too much from the rest, so later levels are lower.
    levels = ranked.withColumn("level", level).withColumn("open", level < F.col("ratio"))
    found = levels.withColumn("water", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    cap = (F.lit(passes) * F.col("source_size")).cast("double")
    target = F.least(cap, F.coalesce(F.col("water") * F.col("weight"), cap))
    return found.select(SOURCE, "source_size", target.alias("target"))


def _planned(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    budget: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The rows of ``plan`` in no order, with their shuffle key."""
    docs = docs.drop(*PLANNED)
    slices = slices_for(docs.count())
    rows = queued(docs, slices, seed)
    totals = settle(rows.groupBy(SOURCE, SLICE).agg(F.sum("size").alias("slice_size")))
    sizes = totals.groupBy(SOURCE).agg(F.sum("slice_size").alias("source_size"))
    goals = settle(targets(sizes, weights, share, passes))
    stop = 1.0
    if budget is not None:
        wanted = goals.agg(F.sum("target")).first()[0] or 0.0
        stop = min(1.0, budget / wanted) if wanted else 0.0

    earlier = Window.partitionBy(SOURCE).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        totals.withColumn("start", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
        .drop("slice_size")
        .join(goals, SOURCE)
    )
    in_slice = Window.partitionBy(SOURCE, SLICE).orderBy(KEY, "size")
    until_here = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(starts, [SOURCE, SLICE]).withColumn(
        "end", F.col("start") + F.sum("size").over(until_here)
    )
    served = F.floor(F.lit(stop) * F.col("target")).cast("long")

    def words(copy: int) -> Column:
        begin = copy * F.col("source_size") + F.col("end") - F.col("size")
        return F.greatest(F.lit(0), F.least(F.col("size"), served - begin))

    copies = [words(copy) for copy in range(passes)]
    taken = copies[0]
    for more in copies[1:]:
        taken = taken + more
    goal = F.when(F.col("target") > 0, F.col("target"))
    last = F.coalesce(
        *[
            F.when(copies[copy] > 0, (copy * F.col("source_size") + F.col("end")) / goal)
            for copy in reversed(range(passes))
        ]
    )
    return placed.select(
        *docs.columns,
        "size",
        "source_size",
        "target",
        (F.col("end") / goal).alias("finish"),
        last.alias("last_finish"),
        taken.cast("long").alias("taken"),
        KEY,
    )


def plan(docs: DataFrame, **settings) -> DataFrame:
    """All documents with ``size, source_size, target, finish, last_finish, taken``.

    Settings are ``weights, share, passes, budget, seed``.

    ``finish`` is the virtual finish time in the first pass, ``last_finish`` that of the
    last copy with words in the mix (NULL without one), ``taken`` the words that the mix
    takes, counting every pass. The mix stops when ``budget`` words (by default the sum of
    all targets) are used. The document at the stop counts with the words that still fit.

    NULL or empty texts have size 0 and take nothing; NULL is a source of its own; repeated
    rows queue one after the other; other columns stay, those of the names above are
    replaced. An empty table gives an empty result. Rows come range-sorted by ``finish``.
    """
    rows = _planned(docs, **settings).repartitionByRange("finish", KEY)
    return rows.sortWithinPartitions("finish", KEY).drop(KEY)


def mixed(docs: DataFrame, passes: int = PASSES, **settings) -> DataFrame:
    """The mix: a row for every copy that is taken, in order of virtual finish time.

    Texts stay whole: the copy at the stop is taken if at least half of it fits. Columns
    are those of ``docs`` and may have any name. NULL and empty texts have no words and are not
    taken, so an empty table gives an empty result; long texts count all of their words; NULL
    is a source; repeated rows queue one after the other.
    """
    needed = ("doc_id", "text", "source")
    planned = _planned(set_aside(docs, *needed), passes=passes, **settings)
    size = F.col("size")
    copies = F.when(size > 0, F.floor(F.col("taken") / size + 0.5)).otherwise(0).cast("int")
    passed = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    out = planned.withColumn("_copies", copies).where("_copies > 0").withColumn("_copy", passed)
    finish = F.col("finish") + (F.col("_copy") - 1) * F.col("source_size") / F.col("target")
    ordered = out.withColumn("_finish", finish)
    ranged = ordered.repartitionByRange("_finish").sortWithinPartitions("_finish")
    return put_back(ranged, docs, *needed)
