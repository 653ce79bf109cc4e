"""Merkle manifests: a digest of every row, a tree of them per group, a proof for every row.

Rows are ranked within their tree over all tasks: sorted into ranges, counted by range, and
numbered within a range. The digits of the rank to base WIDTH name the nodes above a row.
Blocks of WIDTH ** DIGITS rows are rolled up by grouping away one digit column after the other;
each grouping nests the structs of the children, so that a finished block holds its whole part
of the tree. The digests of blocks are rolled up in the same way, block of blocks by block of
blocks, up to the root. Proofs then come out of the nested structs by ``transform`` and
``explode``: within a block nothing is joined. Only a block's own path, one row for
WIDTH ** DIGITS rows, is joined to the block, as the nested struct of a whole tree has no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import ascii_lower
from shelfcast.sources.settled import settle

WIDTH = 16
# Levels in a block. A block nests WIDTH ** DIGITS rows of some hundred bytes.
DIGITS = 3
TAMPER_EVERY = 5

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def _field(value: Column) -> Column:
    shown = value.cast("string")
    sized = F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown)
    return F.coalesce(sized, F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Digest of the values: ``-`` for NULL, else byte count, ``:`` and the value."""
    return digest(F.concat(*map(_field, values)))


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, tampered`` of documents.

    ``tampered`` is the leaf with A-Z of the text in lower case where TAMPER_EVERY divides the
    CRC-32 of the decimal ``doc_id``, else NULL; a NULL ``doc_id`` is never chosen, and a NULL
    text stays NULL. Other columns play no part.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    return docs.select(
        "source",
        "doc_id",
        leaf_of(*map(F.col, FIELDS)).alias("leaf"),
        F.when(chosen, leaf_of(*lowered)).alias("tampered"),
    )


def _height(count: Column) -> Column:
    """Levels above the leaves of a tree: the digits of its last place to base WIDTH."""
    return F.when(count > 1, F.length(F.conv((count - 1).cast("string"), 10, WIDTH))).otherwise(0)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` with ``at``, the place in their ``tree`` from 0, and its ``height``.

    Equal rows get places next to each other in any order, which no result can tell apart; the
    place in the stored table separates them, so that a range of them can be divided too.
    """
    keys = ["tree", *order]
    split = rows.withColumn("twin", F.monotonically_increasing_id())
    ranged = settle(
        split.repartitionByRange(*keys, "twin").withColumn("range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("size"))
    ahead = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(
        "tree",
        "range",
        F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("begins"),
        _height(F.sum("size").over(Window.partitionBy("tree"))).alias("height"),
    )
    inside = Window.partitionBy("tree", "range").orderBy(*order, "twin")
    numbered = ranged.withColumn("number", F.row_number().over(inside) - 1)
    return (
        numbered.join(begins, ["tree", "range"])
        .withColumn("at", F.col("begins") + F.col("number"))
        .drop("range", "twin", "begins", "number")
    )


def _rolled_up(nodes: DataFrame, below: int, digits: int) -> DataFrame:
    """Blocks ``tree, at, height, node, kids`` of nodes that have ``below`` levels under them.

    ``kids`` nests ``digits`` levels, each an array of ``digit, node, kids`` in order of digits;
    at the lowest level ``kids`` is what the nodes had there. A level above the height of a tree
    has one child and is that child.
    """
    names = [f"digit{step}" for step in range(digits)]
    rest = F.col("at")
    for name in names:
        nodes = nodes.withColumn(name, (rest % WIDTH).cast("int"))
        rest = F.shiftright(rest, WIDTH.bit_length() - 1)
    nodes = nodes.withColumn("at", rest).repartition("tree", "at")
    for step, name in enumerate(names):
        child = F.struct(F.col(name).alias("digit"), "node", "kids")
        nodes = nodes.groupBy("tree", "at", "height", *names[step + 1 :]).agg(
            F.array_sort(F.collect_list(child)).alias("kids")
        )
        whole = digest(F.array_join(F.col("kids.node"), ""))
        exists = F.col("height") >= below + step + 1
        nodes = nodes.withColumn("node", F.when(exists, whole).otherwise(F.col("kids")[0]["node"]))
    return nodes


def _siblings(kids: Column, at: Column) -> Column:
    """The digests before and behind a child, each side as one string."""

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda kid: kid["node"]), "")

    return F.struct(
        joined(F.slice(kids, F.lit(1), at)).alias("left"),
        joined(F.slice(kids, at + 2, F.lit(WIDTH))).alias("right"),
    )


def _spread(blocks: DataFrame, below: int, digits: int) -> DataFrame:
    """The nodes of blocks with a ``path``, again with their ``at`` and their own longer path."""
    for step in reversed(range(digits)):
        kids = F.transform(
            "kids", lambda kid, at: F.struct(kid.alias("kid"), _siblings(F.col("kids"), at).alias("level"))
        )
        rows = blocks.withColumn("one", F.explode(kids))
        nothing = F.slice("path", F.lit(1), F.lit(0))
        level = F.when(F.col("height") > below + step, F.array("one.level")).otherwise(nothing)
        blocks = rows.select(
            "tree",
            (F.col("at") * WIDTH + F.col("one.kid.digit")).alias("at"),
            "height",
            F.col("one.kid.node").alias("node"),
            F.col("one.kid.kids").alias("kids"),
            F.concat(level, "path").alias("path"),
            "subroot",
            "root",
        )
    return blocks


PATH = "array<struct<left: string, right: string>>"


def _blocks(leaves: DataFrame, order: list[str], digits: int) -> list[DataFrame]:
    """Stored blocks of rows, blocks of blocks, and so on up to one block of every tree."""
    nodes, tiers = _ranked(leaves, order), []
    while True:
        tiers.append(settle(_rolled_up(nodes, digits * len(tiers), digits)))
        nodes = tiers[-1].select("tree", "at", "height", "node", F.lit(None).alias("kids"))
        if tiers[-1].where("at > 0").isEmpty():
            return tiers


def _proved(tiers: list[DataFrame], tops: DataFrame, digits: int) -> DataFrame:
    """Leaves with their paths; ``tops`` has the path, subroot and root of every tree."""
    paths = tops
    for number in reversed(range(len(tiers))):
        keys = ["tree"] if number == len(tiers) - 1 else ["tree", "at"]
        blocks = tiers[number].select("tree", "at", "height", "kids").join(paths, keys)
        spread = _spread(blocks, digits * number, digits)
        paths = spread.select("tree", "at", "path", "subroot", "root") if number else spread
    return paths


def proofs(leaves: DataFrame, group: str, order: str, digits: int = DIGITS) -> DataFrame:
    """Every row of ``leaves`` with ``subroot``, ``root`` and ``proof``.

    Rows have a digest ``leaf``. Rows of one ``group`` value stand in order of ``order`` (NULL
    first) and of ``leaf`` where that is equal; while several nodes remain, each WIDTH that
    follow each other become the digest of their digests, the last ones even if fewer. What
    remains is ``subroot``. Subroots in order of their group (NULL first, else by bytes) make up
    ``root`` in the same way. ``proof`` is an array of ``left, right`` from the leaf to the root: the
    digests of a node's siblings before and behind it, each side as one string, empty for a node
    without any. ``folded`` gives the root of a leaf and its proof.

    Repeated rows are several leaves. A single leaf is its own root, with an empty proof. An
    empty table gives an empty result. Columns ``subroot``, ``root`` and ``proof`` are
    replaced, others stay. No row is larger than a block, whatever group holds most rows.
    """
    kept = [c for c in leaves.columns if c not in ("subroot", "root", "proof")]
    sortable = leaves.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(order).alias("key"),
        F.col("leaf").alias("node"),
        F.struct(*kept).alias("kids"),
    )
    tiers = _blocks(settle(sortable), ["key", "node"], digits)
    subroots = tiers[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "node", F.col("tree").alias("kids")
    )
    above = _blocks(subroots, ["key"], digits)
    start = above[-1].select(
        "tree",
        F.array().cast(PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("node").alias("root"),
    )
    tops = _proved(above, start, digits).select(
        F.col("kids").alias("tree"), "path", F.col("node").alias("subroot"), "root"
    )
    return _proved(tiers, settle(tops), digits).select(
        *[F.col("kids")[c].alias(c) for c in kept], "subroot", "root", F.col("path").alias("proof")
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof,
        leaf,
        lambda node, level: digest(F.concat(level["left"], node, level["right"])),
    )


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings from the leaf to the root."""
    sides = F.transform(proof, lambda level: F.concat(level["left"], level["right"]))
    return digest(F.array_join(sides, ""))


def manifest(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """``doc_id, leaf, tampered, subroot, root, proof`` of every document, see ``proofs``."""
    proved = proofs(tampered_leaves(docs), "source", "doc_id", digits)
    return proved.select("doc_id", "leaf", "tampered", "subroot", "root", "proof")
