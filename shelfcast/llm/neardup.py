"""Near-duplicate groups by MinHash bands with star-shaped candidate edges.

1. One pass over the texts gives the name and size of each shingle set and its band keys,
   from one-permutation hashing. Texts with the same set form a class: copies are never
   compared with each other.
2. Classes that share a band key form a bucket. Its first member is the centre of a star:
   only the edges from the centre are candidates, as many as the bucket has members.
3. Candidates are confirmed on the full sets, and confirmed links give components.
4. A star cannot see a link between two members that are both too far from the centre. So
   buckets that still hold several components go on. Shingles that no other member of such
   buckets has cannot be shared: their number, and the number of the others in each of 64
   parts of the name space, bound the similarity of two members from above, exactly. The
   members with the fewest such shingles become centres of further stars, and in the end
   every pair of different components that the bounds allow is confirmed or refuted. Nothing
   is capped.

Tables between the steps are stored in the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.batches import with_columns
from shelfcast.llm.shingles import (
    ROWS,
    band_keys,
    bands_for,
    linked,
    set_name,
    shingle_set,
    signatures,
)
from shelfcast.llm.text import put_back, set_aside
from shelfcast.sources.settled import settle

WORDS = 5
PERCENT = 80
# Edges a member up to which what is left of divided buckets is compared at once.
REST_EDGES = 8
# Centres of a divided bucket's second star.
FIRST_CENTRES = 2
# Parts of the name space, by the first bits of a name.
PART_BITS = 6
TEXT_HASH = "_text_hash"

SIGNED = pa.schema(
    [
        ("n_shingles", pa.int64()),
        ("_set", pa.binary()),
        ("_keys", pa.list_(pa.int64())),
    ]
)


def _signed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Id, text hash, set size, set name and band keys of every document."""
    bands = bands_for(percent / 100)

    def make():
        def work(texts: list[str]) -> dict:
            sets = [shingle_set(text, words) for text in texts]
            keys: list = [None] * len(sets)
            full = [at for at, names in enumerate(sets) if len(names)]
            if full:
                found = band_keys(signatures([sets[at] for at in full], bands * ROWS), bands)
                for at, row in zip(full, found):
                    keys[at] = row
            return {
                "n_shingles": [len(names) for names in sets],
                "_set": [set_name(names) if len(names) else None for names in sets],
                "_keys": keys,
            }

        return work

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias(TEXT_HASH))
    schema = "n_shingles bigint, _set binary, _keys array<bigint>"
    return with_columns(rows, SIGNED, schema, make, keep=["doc_id", TEXT_HASH])


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, with a number of its own and the document to read it from."""
    found = (
        signed.where("_set IS NOT NULL")
        .groupBy("_set")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("doc_id", TEXT_HASH, "n_shingles", "_keys")).alias("r"),
        )
    )
    return found.select(
        "_set",
        F.monotonically_increasing_id().alias("node"),
        "first_id",
        F.col("r.n_shingles").alias("n"),
        F.col("r.doc_id").alias("doc_id"),
        F.col(f"r.{TEXT_HASH}").alias(TEXT_HASH),
        F.col("r._keys").alias("_keys"),
    )


def _buckets(classes: DataFrame) -> DataFrame:
    """``key, node, n, place`` of every member of a bucket with two members or more."""
    members = classes.select(F.explode("_keys").alias("key"), "node", "n")
    shared = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    in_key = Window.partitionBy("key").orderBy("node")
    return (
        members.join(shared.select("key"), "key")
        .withColumn("place", F.row_number().over(in_key) - 1)
        .select("key", "node", "n", "place")
    )


def _texts(docs: DataFrame, classes: DataFrame, buckets: DataFrame) -> DataFrame:
    """``node, text`` of the classes that stand in a bucket."""
    wanted = classes.join(buckets.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("doc_id").alias("_id"), F.col(TEXT_HASH).alias("_hash"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias(TEXT_HASH))
    same = rows["doc_id"].eqNullSafe(wanted["_id"]) & (rows[TEXT_HASH] == wanted["_hash"])
    return rows.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Texts of members travel with their edges to the centre, whose text is sent once.
    """
    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, names = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b, text_a, text_b = (column.to_pylist() for column in batch.columns)
            keep = []
            for at, node in enumerate(a):
                if node != centre:
                    centre, names = node, shingle_set(text_a[at], words)
                if linked(names, shingle_set(text_b[at], words), percent):
                    keep.append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())],
                schema=edge,
            )

    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of an undirected graph ``a, b``.

    The label is the smallest node that can be reached. Labels go to neighbours and then
    jump to the label's own label, so that long chains shorten quickly.
    """
    both = settle(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = settle(labels.select(F.col("a").alias("node"), "label"))
    while True:
        offered = both.join(labels, both["b"] == labels["node"]).select("a", "label")
        heard = offered.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        lower = labels.join(heard, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "heard").alias("label")
        )
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        # What the label itself was labelled with one step ago is reachable as well.
        jumped = settle(
            lower.join(own, "label", "left").select(
                "node", "was", F.least("label", F.coalesce("beyond", "label")).alias("label")
            )
        )
        labels = jumped.select("node", "label")
        if not jumped.where("label < was").limit(1).count():
            return labels


def _sizes_allow(percent: int) -> Column:
    return 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")


def _first_stars(members: DataFrame, percent: int) -> DataFrame:
    """Edges from the first member of each bucket to the others."""
    centres = members.where("place = 0").select(
        "key", F.col("node").alias("a"), F.col("n").alias("n_a")
    )
    edges = members.where("place > 0").join(centres, "key").where(_sizes_allow(percent))
    return edges.select("a", F.col("node").alias("b")).distinct()


def _divided(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold several components, with their labels."""
    rows = members.drop("label")
    if labels is None:
        rows = rows.withColumn("label", F.col("node"))
    else:
        label = F.coalesce("label", "node").alias("label")
        rows = rows.join(labels, "node", "left").select(*rows.columns, label)
    ends = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(ends.where("low < high").select("key"), "key", "left_semi")


def _profiles(texts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``node, parts``: how many of a member's shingles others have too, by part."""
    shown = texts.join(members.select("node").distinct(), "node", "left_semi")
    fields = pa.schema([("node", pa.int64()), ("name", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(*(column.to_pylist() for column in batch.columns)):
                names = shingle_set(text, words).view(np.int64)
                nodes = np.full(len(names), node, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(names)], schema=fields)

    named = shown.select("node", "text").mapInArrow(run, "node bigint, name bigint")
    part = F.shiftrightunsigned("name", 64 - PART_BITS).cast("int").alias("part")
    every = named.groupBy("node", part).agg(F.count("*").alias("amount"))
    single = (
        named.groupBy("name")
        .agg(F.min("node").alias("node"), F.count("*").alias("times"))
        .where("times = 1")
        .groupBy("node", part)
        .agg((-F.count("*")).alias("amount"))
    )
    shared = every.unionByName(single).groupBy("node", "part").agg(F.sum("amount").alias("amount"))
    entries = F.map_from_entries(F.collect_list(F.struct("part", "amount")))
    places = F.sequence(F.lit(0), F.lit(2**PART_BITS - 1))
    parts = F.transform(
        places, lambda at: F.coalesce(F.element_at("amounts", at), F.lit(0)).cast("int")
    )
    return shared.groupBy("node").agg(entries.alias("amounts")).select("node", parts.alias("parts"))


def _profiled(members: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Members that can have a link at all, in place by their number of lone shingles."""
    in_key = Window.partitionBy("key").orderBy("alone", "node")
    shared = F.aggregate("parts", F.lit(0), lambda x, y: x + y)
    possible = 100 * (F.col("n") - F.col("alone")) >= percent * F.col("n")
    rows = members.drop("place", "label").join(profiles, "node")
    rows = rows.withColumn("alone", F.col("n") - shared).where(possible)
    return rows.withColumn("place", F.row_number().over(in_key) - 1)


def _bounded(rows: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a < b`` of the two sides with different labels that bounds allow."""
    others = others.select(
        "key", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "label", "alone", "parts")]
    )

    def allow(common: Column) -> Column:
        return 100 * common >= percent * (F.col("n") + F.col("n_a") - common)

    most = F.least(F.col("n") - F.col("alone"), F.col("n_a") - F.col("alone_a"))
    by_part = F.aggregate(
        F.zip_with("parts", "parts_a", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y
    )
    edges = rows.join(others, "key").where(
        (F.col("label") != F.col("label_a")) & allow(most) & allow(by_part)
    )
    ends = F.least("node", "node_a").alias("a"), F.greatest("node", "node_a").alias("b")
    return edges.select(*ends).distinct()


def _outside(members: DataFrame) -> DataFrame:
    """Members outside of the largest component of their bucket."""
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("key").agg(F.max_by("label", "members").alias("main"))
    return members.join(largest, "key").where("label <> main").drop("main")


def _labels(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Component of every class that is linked with another one; None without links."""
    buckets = settle(_buckets(classes))
    pairs = settle(_first_stars(buckets, percent))
    if not pairs.limit(1).count():
        return None
    texts = settle(_texts(docs, classes, buckets))
    links = settle(_confirmed(pairs, texts, words, percent))
    labels = components(links)
    members = settle(_divided(buckets, labels))
    if not members.limit(1).count():
        return labels
    members = settle(_profiled(members, settle(_profiles(texts, members, words)), percent))
    tested, centres = pairs, FIRST_CENTRES
    while True:
        members = settle(_divided(members, labels))
        count, last = members.agg(F.count("*"), F.max("place")).first()
        if not count:
            return labels
        at_once = centres > FIRST_CENTRES
        if at_once:
            edges = _bounded(members, _outside(members), percent)
            pairs = settle(edges.join(tested, ["a", "b"], "left_anti"))
            at_once = pairs.count() <= REST_EDGES * count
        if not at_once:
            stars = members.where(F.col("place") < centres)
            edges = _bounded(members, stars, percent)
            pairs = settle(edges.join(tested, ["a", "b"], "left_anti"))
        if pairs.limit(1).count():
            found = _confirmed(pairs, texts, words, percent)
            links = settle(links.unionByName(found))
            labels = components(links)
            tested = tested.unionByName(pairs)
        if at_once or centres > last:
            return labels
        centres *= 2


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, _text_hash, n_shingles, component_id, kept`` for every document.

    Documents are linked if their sets of ``words``-word shingles have at least ``percent``
    in common. ``component_id`` is the smallest ``doc_id`` that links reach, NULL ids aside;
    ``kept`` marks the row that has it. A text that is NULL or has no words has an empty set
    and is linked with nothing: it is its own component. Rows that repeat an id keep each
    their own component. A component with NULL ids only has a NULL ``component_id``, and its
    rows are kept. An empty table gives an empty result. Other columns play no part.
    """
    signed = settle(_signed(docs, words, percent))
    classes = settle(_classes(signed))
    labels = _labels(docs, classes, words, percent)
    named = classes.select("_set", "node", "first_id")
    if labels is None:
        named = named.withColumn("label", F.col("node"))
    else:
        label = F.coalesce("label", "node").alias("label")
        named = named.join(labels, "node", "left").select("_set", "first_id", label)
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_set = settle(named.join(smallest, "label").select("_set", "component_id"))
    rows = signed.select("doc_id", TEXT_HASH, "n_shingles", "_set").join(of_set, "_set", "left")
    component = F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id",
        TEXT_HASH,
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def deduplicated(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that are kept, one of each group; columns stay.

    Of rows that repeat both id and text one stays, whatever their other columns hold. A NULL or
    empty text has no near duplicate; long texts are compared as a whole; of a group the row
    with the smallest id stays. An empty table gives an empty result. Columns may have any name.
    """
    rows = set_aside(docs, "doc_id", "text").withColumn(TEXT_HASH, F.xxhash64("text"))
    found = near_duplicates(docs.select("doc_id", "text"), words, percent).where("kept")
    keys = found.select(F.col("doc_id").alias("_id"), F.col(TEXT_HASH).alias("_hash"))
    same = rows["doc_id"].eqNullSafe(keys["_id"]) & (rows[TEXT_HASH] == keys["_hash"])
    kept = rows.join(keys.distinct(), same, "left_semi")
    return put_back(kept.dropDuplicates(["doc_id", TEXT_HASH]), docs, "doc_id", "text")
