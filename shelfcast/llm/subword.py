"""Subword ids of whole texts, and the texts decoded from them again.

The ids come from our own agenda, which cuts texts where no piece of the model has the two
characters side by side. The sentencepiece library merges such neighbours no more than we do, so
its ids of a text are its ids of the segments: it encodes every distinct segment that is new to a
task, and decodes the ids of every whole text. A text that is not spelled again, and every text
from the first segment on that differs, is encoded whole by the library too; if that differs
anywhere the text gets the library's result and is marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.agenda import SPACE, Agenda
from shelfcast.llm.batches import ranges
from shelfcast.llm.text import sha256

# Segments that a task remembers; all are dropped when there are more.
REMEMBERED = 300_000
ADDED = "ids array<int>, decoded string, agreed boolean"


class Encoder:
    """The agenda with a memory of segments, next to the library."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.agenda = Agenda(self.library)
        self.known: dict[str, bytes] = {}
        # Whether the library gave the same ids for all segments so far.
        self.confirmed = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.agenda.segments(text) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*cut).difference(self.known))
        ids = self.agenda.encode_all(new)
        self.confirmed = self.confirmed and self._same(new, ids)
        self.known.update(zip(new, ids))
        look = self.known.__getitem__
        return [b"".join(map(look, segments)) for segments in cut]

    def _same(self, segments: list[str], ids: list[bytes]) -> bool:
        """Whether the library gives these ids for the segments, each between two separators.

        The separator before the first one keeps it from the space that the model puts first.
        """
        mark = self.agenda.separator
        joined = mark + "".join(segment + mark for segment in segments)
        if self.library.normalize(joined) != SPACE + joined:
            return False
        space, marked = self.agenda.encode_all([SPACE, mark])
        expected = space + marked + b"".join(one + marked for one in ids)
        return np.array(self.library.encode(joined), np.int32).tobytes() == expected

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str], list[bool]]:
        """Ids (bytes of int32), decoded text and agreement for each text."""
        normal = [self.library.normalize(text) for text in texts]
        ids = self._encode(normal)
        lists = [np.frombuffer(x, np.int32).tolist() for x in ids]
        # The first character is the space that the model puts before a text.
        decoded = [self.agenda.decode(x).replace(SPACE, " ")[1:] for x in lists]
        back = self.library.decode(lists) if texts else []
        agreed = [a == b for a, b in zip(decoded, back)]
        asked = [
            at
            for at, (text, spelled) in enumerate(zip(normal, back))
            if not self.confirmed or text[1:].replace(SPACE, " ") != spelled
        ]
        if asked:
            theirs = self.library.encode([texts[at] for at in asked], num_threads=1)
            for at, right in zip(asked, theirs):
                if lists[at] != right:
                    ids[at], agreed[at] = np.array(right, np.int32).tobytes(), False
                    back[at] = self.library.decode(right)
        return ids, back, agreed


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """All documents with ``ids``, ``decoded`` and ``agreed``.

    A NULL text counts as an empty one: no ids, an empty decoded text. No begin or end ids,
    no sampling. Other columns stay; those of the three names are replaced. Rows are handled
    one by one, so repeated ids and rows are kept as they are. The model file is read by the
    driver and travels with the tasks.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    docs = docs.drop("ids", "decoded", "agreed")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            texts = batch.column(at)
            for start, stop in ranges(texts):
                part = batch.slice(start, stop - start)
                ids, decoded, agreed = encoder.run(
                    [text or "" for text in part.column(at).to_pylist()]
                )
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32))
                )
                added = [lists, pa.array(decoded, pa.string()), pa.array(agreed, pa.bool_())]
                names = [*part.schema.names, "ids", "decoded", "agreed"]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, {ADDED}")


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens, ids_sha256, decoded_sha256`` in place of ids and text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": sha256(joined),
            "decoded_sha256": sha256(F.col("decoded")),
        }
    ).drop("ids", "decoded")
