"""Arrow batches cut by the size of their texts, so that a task's memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Texts are taken together until they have this many bytes.
BATCH_BYTES = 1 << 21


def ranges(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes; a longer text is alone at last."""
    total, start = 0, 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        total += size
        if total >= limit:
            yield start, at + 1
            start, total = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def with_columns(
    docs: DataFrame,
    fields: pa.Schema,
    schema: str,
    make: Callable[[], Callable[[list[str]], dict]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents with columns worked out from ``text`` in Arrow batches.

    ``make`` is called once in each task and returns a function of a list of texts (NULL
    comes as an empty one) to the new columns. ``keep`` names the columns that stay; all do
    by default. Columns that stand in ``fields`` are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in fields.names]
    rows = docs.select("text", *[docs[c] for c in kept if c != "text"])
    outgoing = [c for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start, stop in ranges(batch.column(0)):
                part = batch.slice(start, stop - start)
                made = work([text or "" for text in part.column(0).to_pylist()])
                columns = [part.column(part.schema.get_field_index(c)) for c in outgoing]
                columns += [pa.array(made[f.name], f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(columns, [*outgoing, *fields.names])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([*(f"`{c}` {types[c]}" for c in outgoing), schema])
    return rows.mapInArrow(run, out)
