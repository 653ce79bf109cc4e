"""Packing of token ids into sequences of one length, by differencing.

A document's ids are cut into whole sequences and a rest. Rests, in parts of at most PART ids,
are packed in blocks of BLOCK parts: the windows of a block get near-equal sums by multiway
differencing, and one more window whenever one exceeds the capacity. The last parts of a
block move on to the next one, so that a block's ids fill its windows but for SLACK ids each,
which is what differencing needs to end without another window.

Tasks pack what they read. Nothing is shuffled, a task holds one block and one batch, and a
task that is run again gives the same sequences. Their ids tell tasks apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfcast.llm.batches import ranges
from shelfcast.llm.byte_tokens import ByteEncoder
from shelfcast.llm.differencing import packed

CAPACITY = 1024
# Parts of a block, the ids of the largest part, and the ids that a window may stay short.
BLOCK, PART, SLACK = 512, 512, 16
END_ID = 0
# Sequences that a task may have.
TASK_BITS = 40
# Ids that are returned in one batch, about.
BATCH_IDS = 1 << 19

PIECE = pa.schema(
    [
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
PIECE_TYPES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids array<int>"
)


class Packer:
    """Sequences of one task. A part is ``(document, start, ids, tokens of the document)``."""

    def __init__(self, first: int, capacity: int, block: int, part: int, slack: int):
        self._next, self._capacity, self._block = first, capacity, block
        self._part, self._slack = min(part, capacity), slack
        self._waiting: list[tuple] = []

    def add(self, document, ids: np.ndarray) -> Iterator[tuple]:
        """Pieces ``(part, sequence, offset)`` that are settled with this document."""
        whole = len(ids) // self._capacity * self._capacity
        for start in range(0, whole, self._capacity):
            yield (document, start, ids[start : start + self._capacity], len(ids)), self._next, 0
            self._next += 1
        for start in range(whole, len(ids), self._part):
            self._waiting.append((document, start, ids[start : start + self._part], len(ids)))
            if len(self._waiting) >= self._block:
                yield from self._packed(self._cut_off())

    def rest(self) -> Iterator[tuple]:
        """Pieces of all that still waits."""
        yield from self._packed([])

    def _cut_off(self) -> list[tuple]:
        """Takes from the block the last ids that would begin another window."""
        fill = self._capacity - self._slack
        sizes = sum(len(part[2]) for part in self._waiting)
        extra, later = sizes % fill if sizes > fill else 0, []
        while extra:
            document, start, ids, tokens = self._waiting.pop()
            stay = max(0, len(ids) - extra)
            extra -= len(ids) - stay
            later.append((document, start + stay, ids[stay:], tokens))
            if stay:
                self._waiting.append((document, start, ids[:stay], tokens))
        return later[::-1]

    def _packed(self, later: list[tuple]) -> Iterator[tuple]:
        parts, self._waiting = self._waiting, later
        if not parts:
            return
        window, windows = packed(np.array([len(part[2]) for part in parts]), self._capacity)
        offsets = [0] * windows
        for part, at in zip(parts, window.tolist()):
            yield part, self._next + at, offsets[at]
            offsets[at] += len(part[2])
        self._next += windows


def _batch(pieces: list[tuple], id_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    parts = [part for part, _, _ in pieces]
    columns = [
        [part[0] for part in parts],
        [part[1] for part in parts],
        [len(part[2]) for part in parts],
        [zlib.crc32(part[2].astype("<u4").tobytes()) for part in parts],
        [part[3] for part in parts],
        [sequence for _, sequence, _ in pieces],
        [offset for _, _, offset in pieces],
    ]
    arrays = [pa.array(columns[0], id_type)]
    arrays += [pa.array(c, f.type) for c, f in zip(columns[1:], PIECE)]
    if with_ids:
        ends = np.cumsum([0, *columns[2]], dtype=np.int32)
        flat = np.concatenate([part[2] for part in parts]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", *PIECE.names][: len(arrays)])


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
    block: int = BLOCK,
    part: int = PART,
    slack: int = SLACK,
) -> DataFrame:
    """A row for every piece of a document in a sequence of at most ``capacity`` ids.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if wanted, the
    ``ids`` themselves. A document's ids are those of the vocabulary at ``path`` and ``end_id``;
    a NULL text counts as an empty one and has ``end_id`` alone. Every id is in exactly one
    piece, and pieces of a sequence follow each other without a gap. ``ids_crc32`` is taken over
    little-endian 32-bit ids. Repeated ids and rows are packed each; long texts fill sequences of
    their own but for their rest; an empty table gives no piece. Other columns play no part.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ", ".join(PIECE_TYPES.split(", ")[: len(PIECE) if with_ids else -1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(path)
        first = TaskContext.get().partitionId() << TASK_BITS
        packer, out, held, kind = Packer(first, capacity, block, part, slack), [], 0, None
        for batch in batches:
            kind = batch.column(0).type
            for start, stop in ranges(batch.column(1)):
                rows = batch.slice(start, stop - start)
                documents = rows.column(0).to_pylist()
                texts = [text or "" for text in rows.column(1).to_pylist()]
                for document, ids in zip(documents, encoder.encode(texts)):
                    for piece in packer.add(document, np.append(ids, np.uint32(end_id))):
                        out.append(piece)
                        held += len(piece[0][2])
                        if held >= BATCH_IDS:
                            yield _batch(out, kind, with_ids)
                            out, held = [], 0
        out += packer.rest()
        if out:
            yield _batch(out, kind, with_ids)

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {id_type}, {names}")
