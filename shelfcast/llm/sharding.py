"""Sharding by histogram sort.

Rows are ordered by a hash of their text, then of their id, so that copies of a text lie
together. Splitters of that order are found by counting, not by sorting: each round counts
the exact bytes and rows in the cells of a grid of candidate boundaries, and cells that hold
a wanted boundary are divided further, until every boundary is within its tolerance. Only
then are the rows exchanged, once, straight into their place.

Shards get nearly equal bytes. A boundary is put between two texts where the tolerance
allows it, and inside a group of copies only where the group itself is larger than that.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.text import OWN, set_aside, whole
from shelfcast.sources.settled import settle

SHARDS = 8
# Share of a shard, or of a part of one, by which a boundary may miss its place.
SHARD_TOLERANCE = 0.002
PART_TOLERANCE = 0.1
PART_BYTES = 64 << 20
KEY_BITS = 63
CELL_BITS = 8
LAW = "bytes"

TEXT_KEY, ROW_KEY, PART = "_text_key", "_row_key", "_part"
GIVEN = ("size", "shard", "slot")


def _positive(number: Column) -> Column:
    return F.shiftrightunsigned(number, 1)


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with their size and the two halves of their sort key, both of 63 bits."""
    text = whole(F.col("text"))
    return docs.withColumns(
        {
            "size": F.octet_length(text).cast("long") + 1,
            TEXT_KEY: _positive(F.xxhash64(text)),
            ROW_KEY: _positive(F.xxhash64(F.col("doc_id"), text)),
        }
    )


class _Grid:
    """Boundaries of one key half, refined until each is within its tolerance.

    A boundary is found as ``(prefix start, bytes below, rows below)``. ``rows`` has the
    key half and ``size``; it is counted, never collected.
    """

    def __init__(self, rows: DataFrame, key: str, first_bits: int):
        self.rows, self.key, self.first_bits = rows, key, first_bits

    def _histogram(self, bits: int, inside: list[int] | None, parent_bits: int) -> dict[int, list]:
        """Cells of ``bits`` bits by their parent cell: ``[(cell, bytes, rows)]`` in order."""
        cell = F.shiftright(self.key, KEY_BITS - bits)
        parent = F.shiftright(self.key, KEY_BITS - parent_bits) if parent_bits else F.lit(0)
        rows = self.rows if inside is None else self.rows.where(parent.isin(inside))
        counted = rows.groupBy(parent.alias("parent"), cell.alias("cell")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows")
        )
        cells: dict[int, list] = {}
        # At most 2 ** CELL_BITS cells for each boundary that is still open.
        for row in counted.collect():
            cells.setdefault(row["parent"], []).append((row["cell"], row["bytes"], row["rows"]))
        return {parent: sorted(found) for parent, found in cells.items()}

    def find(self, wanted: dict[int, tuple[float, float]]) -> tuple[dict, dict]:
        """Place ``{number: (target bytes, tolerance)}``.

        Returns the boundaries found, and those that need the other key half, as they fall
        into one single key: ``{number: (key, bytes below the key, rows below the key)}``.
        """
        found, stuck = {}, {}
        open_cells = {0: (0, 0, list(wanted))}  # parent cell: bytes and rows below it
        parent_bits, bits = 0, min(self.first_bits, KEY_BITS)
        while open_cells:
            inside = list(open_cells) if parent_bits else None
            cells = self._histogram(bits, inside, parent_bits)
            shift = KEY_BITS - bits
            deeper: dict[int, tuple[int, int, list[int]]] = {}
            for parent, (below, rows_below, numbers) in open_cells.items():
                edges = [(None, below, rows_below)]
                starts = []
                for cell, size, rows in cells.get(parent, []):
                    starts.append((cell, edges[-1][1], edges[-1][2]))
                    edges.append((cell, edges[-1][1] + size, edges[-1][2] + rows))
                ends = [edge[1] for edge in edges[1:]]
                for number in numbers:
                    target, tolerance = wanted[number]
                    at = min(bisect.bisect_left(ends, target), len(starts) - 1)
                    cell, low, low_rows = starts[at]
                    _, high, high_rows = edges[at + 1]
                    near_low = abs(target - low) <= abs(high - target)
                    if near_low and abs(target - low) <= tolerance:
                        found[number] = (cell << shift, low, low_rows)
                    elif not near_low and abs(high - target) <= tolerance:
                        found[number] = ((cell + 1) << shift, high, high_rows)
                    elif bits == KEY_BITS:
                        stuck[number] = (cell, low, low_rows)
                    else:
                        deeper.setdefault(cell, (low, low_rows, []))[2].append(number)
            open_cells, parent_bits = deeper, bits
            bits = min(bits + CELL_BITS, KEY_BITS)
        return found, stuck


def splitters(keys: DataFrame, shards: int, parts: int) -> list[tuple[int, int, int]]:
    """Start of each part but the first: ``(text key, row key, rows below)``, ascending.

    ``keys`` has ``size`` and both key halves. Each shard has ``parts`` parts. The driver
    sees counts of cells only: some hundreds for each part.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    count = shards * parts
    if not total or count < 2:
        return []
    share = total / count
    wanted = {
        number: (
            number * share,
            SHARD_TOLERANCE * share * parts if number % parts == 0 else PART_TOLERANCE * share,
        )
        for number in range(1, count)
    }
    first_bits = math.ceil(math.log2(count)) + CELL_BITS
    found, stuck = _Grid(keys, TEXT_KEY, first_bits).find(wanted)
    places = {number: (key, 0, rows) for number, (key, _, rows) in found.items()}
    # Groups of copies that are larger than a tolerance are divided by row key.
    groups: dict[int, list[int]] = {}
    for number, (key, _, _) in stuck.items():
        groups.setdefault(key, []).append(number)
    for key, numbers in groups.items():
        _, below, rows_below = stuck[numbers[0]]
        inner = {n: (wanted[n][0] - below, wanted[n][1]) for n in numbers}
        copies = keys.where(F.col(TEXT_KEY) == F.lit(key))
        exact, repeated = _Grid(copies, ROW_KEY, first_bits).find(inner)
        for number, (row_key, _, rows) in {**exact, **repeated}.items():
            places[number] = (key, row_key, rows_below + rows)
    ordered = [places[number] for number in sorted(places)]
    for at in range(1, len(ordered)):  # two boundaries may share a large row
        ordered[at] = max(ordered[at], ordered[at - 1])
    return ordered


def _count_at_or_below(bounds: list[tuple[int, int]], key: Column) -> Column:
    """How many of the ascending bounds are at or below the key, in two short steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    runs = [bounds[at : at + step] for at in range(0, len(bounds), step)]

    def literal(pairs) -> Column:
        return F.array(*[F.struct(F.lit(a).cast("long"), F.lit(b).cast("long")) for a, b in pairs])

    def reached(pairs: Column) -> Column:
        return F.size(F.filter(pairs, lambda pair: pair <= key))

    full_runs = F.greatest(reached(literal([run[0] for run in runs])) - 1, F.lit(0))
    chosen = F.element_at(F.array(*[literal(run) for run in runs]), full_runs + 1)
    return full_runs * step + reached(chosen)


def shard(docs: DataFrame, shards: int = SHARDS, parts: int | None = None) -> DataFrame:
    """All documents with ``size, shard, slot``.

    ``size`` is the UTF-8 length of the text and one byte more (NULL: 1). ``shard`` runs
    from 0 and ``slot`` numbers the rows of a shard from 0 without gaps, in key order. Rows
    that repeat both id and text share a key and stay together; they are equal, so any order
    among them is the same result. Long texts count all of their bytes. Other columns stay,
    whatever their names, but those of the three names are replaced. An empty table gives an
    empty result.
    """
    spark, needed = docs.sparkSession, ("doc_id", "text")
    given = docs.drop(*GIVEN)
    rows = keyed(set_aside(given, *needed))
    keys = settle(rows.select("size", TEXT_KEY, ROW_KEY))
    if parts is None:
        total = keys.agg(F.sum("size")).first()[0] or 0
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = math.ceil(max(total / PART_BYTES, tasks) / shards)
    bounds = splitters(keys, shards, parts)
    rows_below = [0, *(rows for _, _, rows in bounds)]
    rows_below += [rows_below[-1]] * (shards * parts - len(rows_below))
    offsets = [
        rows_below[part] - rows_below[part - part % parts] for part in range(shards * parts)
    ]
    key = F.struct(F.col(TEXT_KEY), F.col(ROW_KEY))
    part = _count_at_or_below([(a, b) for a, b, _ in bounds], key)
    placed = rows.withColumn(PART, part.cast("int")).repartitionById(shards * parts, F.col(PART))
    in_part = Window.partitionBy(PART).orderBy(TEXT_KEY, ROW_KEY)
    offset = F.element_at(F.array(*[F.lit(rows) for rows in offsets]), F.col(PART) + 1)
    back = [F.col(c) if c in needed else F.col(OWN)[c].alias(c) for c in given.columns]
    return placed.select(
        *back,
        "size",
        F.floor(F.col(PART) / parts).cast("int").alias("shard"),
        (offset + F.row_number().over(in_part) - 1).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Store every shard as a folder of files in slot order."""
    shard(docs, shards).write.mode("overwrite").partitionBy("shard").parquet(path)
