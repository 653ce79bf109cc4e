"""Document fingerprints by locally consistent parsing, and comparison with the next document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.parsing import FINGERPRINT_BYTES, fingerprints, likeness
from shelfcast.llm.text import whole
from shelfcast.sources.settled import settle

# Characters of texts that are parsed together.
BATCH_CHARS = 1 << 18

RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
WHOLE_ROW, FIRST, LAST = 0, 1, 2
EDGE_FIELDS = pa.schema(
    [*FIELDS, ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())]
)


def _spans(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, chars = 0, 0
    for at, text in enumerate(texts):
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield start, at + 1
            start, chars = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _parsed(texts: list[str]) -> np.ndarray:
    parts = [fingerprints(texts[a:b]) for a, b in _spans(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, FINGERPRINT_BYTES), np.uint8)


def _rows(marks: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in marks]


def fingerprint(docs: DataFrame) -> DataFrame:
    """All documents with ``fingerprint``, 72 bytes. A NULL text counts as an empty one."""
    docs = docs.drop("fingerprint")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(at).to_pylist()]
            marks = pa.array(_rows(_parsed(texts)), pa.binary())
            names = [*batch.schema.names, "fingerprint"]
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, fingerprint binary")


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], following: list[str], own, after) -> dict:
    changed = [edited(a, b) for a, b in zip(texts, following)]
    marks = _parsed(changed)
    return {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(text) for text in texts], pa.int64()),
        "edited_sha256": pa.array(
            [hashlib.sha256(text.encode()).digest() for text in changed], pa.binary()
        ),
        "fingerprint": pa.array(_rows(own), pa.binary()),
        "edited_fingerprint": pa.array(_rows(marks), pa.binary()),
        "near_edited": pa.array(likeness(own, marks)),
        "near_next": pa.array(likeness(own, after)),
    }


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with the one after it.

    The last row has its next one in another partition: it is passed on with its text, and
    so is the first row, for the partition before.
    """
    part = TaskContext.get().partitionId()

    def edge(kind: int, doc_id, text: str) -> pa.RecordBatch:
        row = {"doc_id": doc_id, "kind": kind, "part": part, "text": text}
        return pa.RecordBatch.from_pylist([row], EDGE_FIELDS)

    held = None  # id, text and fingerprint of the row before the batch
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for start, stop in _spans(texts):
            some_ids, some = ids[start:stop], texts[start:stop]
            marks = _parsed(some)
            if held is None:
                yield edge(FIRST, some_ids[0], some[0])
            else:
                some_ids, some = [held[0], *some_ids], [held[1], *some]
                marks = np.concatenate([held[2], marks])
            if len(some) > 1:
                done = _compare(some_ids[:-1], some[:-1], some[1:], marks[:-1], marks[1:])
                count = len(some) - 1
                done["kind"] = pa.array([WHOLE_ROW] * count, pa.int32())
                done["part"] = pa.array([part] * count, pa.int32())
                done["text"] = pa.nulls(count, pa.string())
                yield pa.RecordBatch.from_pydict(done, EDGE_FIELDS)
            held = some_ids[-1], some[-1], marks[-1:]
    if held is not None:
        yield edge(LAST, held[0], held[1])


def _in_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, following = (column.to_pylist() for column in batch.columns)
        done = _compare(ids, texts, following, _parsed(texts), _parsed(following))
        yield pa.RecordBatch.from_pydict(done, FIELDS)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are.

    The next document is the one after it by ascending ``doc_id`` (NULL first, equal ids by
    a hash of the text), and the first one after the last. The edited text is the text with
    its second half replaced by as much of the next document's start. A NULL text counts as
    an empty one; an empty table gives an empty result; a lone document follows itself.

    Texts move once, into ranges of ids; each range is compared in order as it is read. Only
    the two ends of a range need another range, so these rows are matched afterwards.
    """
    rows = docs.select("doc_id", whole(F.col("text")).alias("text")).withColumn(
        "_hash", F.xxhash64("text")
    )
    ranged = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash")
    edges = f"{RESULT}, kind int, part int, text string"
    table = settle(ranged.select("doc_id", "text").mapInArrow(_in_order, edges))
    whole_rows = table.where(F.col("kind") == WHOLE_ROW).drop("kind", "part", "text")

    # One row for each range: its own and the next one's number.
    firsts = table.where(F.col("kind") == FIRST).select("part", F.col("text").alias("following"))
    in_turn = Window.orderBy("part")
    follow = firsts.select("part").select(
        "part",
        F.coalesce(
            F.lead("part").over(in_turn),
            F.min("part").over(Window.partitionBy()),
        ).alias("next_part"),
    )
    pairs = (
        table.where(F.col("kind") == LAST)
        .select("doc_id", "text", "part")
        .join(follow, "part")
        .join(firsts.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "following")
    )
    return whole_rows.unionByName(pairs.mapInArrow(_in_pairs, RESULT))
