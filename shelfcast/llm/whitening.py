"""Whitening of embeddings by a blockwise QR factorisation and a bidiagonal qd solver.

Entries become whole numbers, so that equal vectors are found and sums are exact. The
different vectors are the fit list. Each task reduces its centred rows to one triangle by QR,
triangles are stacked and reduced again, FAN_IN at a time, until few enough are left for the
driver; a triangle has the dimension's size, whatever the number of rows. ``bidiagonal`` takes
the last one apart. Rows are then projected one batch at a time, and the covariance of the
projected fit list shows how near it is to the identity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.bidiagonal import EPS, largest_right_vectors
from shelfcast.sources.settled import settle

STEPS, ZERO = 64, 1_000_000
# Entries beyond this are taken for it, so that whole numbers stay in range.
LARGEST = float(1 << 55)
COMPONENTS = 16
FAN_IN = 16
# Numbers that a task works on at once.
CHUNK = 1 << 21
LIMB = 32
WHOLE = 1 << 62
# Standard deviations below this share of the largest, times the dimension, are rounding.
ROUNDING = 1e4 * EPS

WHITE = "deviation bigint, whitened array<double>"


def as_steps(vector: Column) -> Column:
    """Each entry in whole steps."""

    def step(entry: Column) -> Column:
        scaled = entry.cast("double") * STEPS
        held = F.greatest(F.least(scaled, F.lit(LARGEST)), F.lit(-LARGEST))
        return F.floor(held).cast("long") + ZERO

    return F.transform(vector, step)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and whole steps ``x`` of rows whose vector has finite entries only."""

    def finite(entry: Column) -> Column:
        value = entry.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))

    fine = F.col(vector).isNotNull() & F.forall(vector, finite)
    return rows.where(fine).select(F.col(key).alias("key"), as_steps(F.col(vector)).alias("x"))


def _padded(rows: DataFrame, size: int) -> DataFrame:
    more = F.array_repeat(F.lit(ZERO).cast("long"), F.lit(size) - F.size("x"))
    return rows.withColumn("x", F.concat("x", more))


def _matrices(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Rows of an array column, some at a time."""
    rows = max(1, CHUNK // size)
    for start in range(0, len(column), rows):
        part = column.slice(start, rows)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), size)


def _from_sums(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """``count * x - sums``, exact: as 64-bit numbers if all fit, else as Python's."""
    highest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if count * highest + max(map(abs, sums), default=0) < WHOLE:
        return count * x - np.array(sums, np.int64)
    return count * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    return (_from_sums(x, count, sums) / count).astype(float)


def _deviations(apart: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; NULL beyond a BIGINT."""
    if apart.dtype != object:
        highest = max(int(apart.max(initial=0)), -int(apart.min(initial=0)))
        if highest * highest * max(1, apart.shape[1]) < WHOLE:
            return np.einsum("ij,ij->i", apart, apart).tolist()
        apart = apart.astype(object)
    found = (apart * apart).sum(axis=1).tolist()
    return [value if value < 1 << 63 else None for value in found]


def _sums(fit: DataFrame, size: int) -> list[int]:
    """Exact sums of every dimension, from partial sums in two halves of a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for x in _matrices(batch.column(0), size):
                high += (x >> LIMB).sum(axis=0)
                low += (x & ((1 << LIMB) - 1)).sum(axis=0)
        columns = [pa.array(np.arange(size)), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(columns, ["dimension", "high", "low"])

    partial = fit.select("x").mapInArrow(run, "dimension bigint, high bigint, low bigint")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = partial.groupBy("dimension").agg(*wide).orderBy("dimension").collect()
    return [(int(row["high"]) << LIMB) + int(row["low"]) for row in rows]


def _reduced(
    fit: DataFrame,
    size: int,
    start: Callable[[Iterator[np.ndarray]], np.ndarray],
    merge: Callable[[list[np.ndarray]], np.ndarray],
) -> np.ndarray:
    """One array of bounded size out of all rows: one for each task, merged FAN_IN at a time."""
    schema = pa.schema([("part", pa.int64()), ("held", pa.list_(pa.float64()))])
    types = "part bigint, held array<double>"

    def one(part: int, held: np.ndarray) -> pa.Table:
        return pa.table([[part], [held.ravel().tolist()]], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for batch in batches for x in _matrices(batch.column(0), size))
        yield from one(TaskContext.get().partitionId(), start(rows)).to_batches()

    def merged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        held = [np.array(row) for row in table.column("held").to_pylist()]
        return one(table.column("part")[0].as_py() // FAN_IN, merge(held))

    parts = settle(fit.select("x").mapInArrow(run, types))
    while parts.count() > FAN_IN:
        group = F.floor(F.col("part") / FAN_IN)
        parts = settle(parts.groupBy(group).applyInArrow(merged, types))
    held = [np.array(row["held"]) for row in parts.orderBy("part").collect()]
    return merge(held) if held else merge([start(iter(()))])


def _triangle(fit: DataFrame, size: int, count: int, sums: list[int]) -> np.ndarray:
    """R of a QR factorisation of the centred rows."""

    def stacked(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((size, size))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        return r

    found = _reduced(
        fit,
        size,
        lambda rows: stacked(_centred(x, count, sums) for x in rows),
        lambda parts: stacked(part.reshape(size, size) for part in parts),
    )
    return found.reshape(size, size)


def _covariance(fit: DataFrame, model: Whitening) -> np.ndarray:
    """The covariance of the whitened fit list, centred before multiplying."""
    size, many = len(model.sums), model.directions.shape[1]

    def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts, means and sums of products of two sets of rows together."""
        count = first[0] + second[0]
        if count == 0:
            return first
        apart = second[1 : many + 1] - first[1 : many + 1]
        mean = first[1 : many + 1] + apart * (second[0] / count)
        between = np.outer(apart, apart).ravel() * (first[0] * second[0] / count)
        return np.concatenate([[count], mean, first[many + 1 :] + second[many + 1 :] + between])

    def of(x: np.ndarray) -> np.ndarray:
        white = model.project(_from_sums(x, model.count, model.sums))
        mean = white.mean(axis=0)
        return np.concatenate([[len(x)], mean, ((white - mean).T @ (white - mean)).ravel()])

    def all_of(parts) -> np.ndarray:
        held = np.zeros(1 + many + many * many)
        for part in parts:
            held = joined(held, part)
        return held

    found = _reduced(fit, size, lambda rows: all_of(map(of, rows)), all_of)
    return found[many + 1 :].reshape(many, many) / max(1.0, found[0])


@dataclass
class Whitening:
    """What the fit list has: its rows, sums, directions, their variances, and all variance."""

    count: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, apart: np.ndarray) -> np.ndarray:
        """Whitened rows of ``count * x - sums``."""
        centred = (apart / max(1, self.count)).astype(float)
        return centred @ (self.directions / np.sqrt(self.variances))

    @property
    def explained(self) -> list[float]:
        return (self.variances / self.trace).tolist()


def _sized(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Rows and their fit list, all of one size, with that size and the list's length."""
    fit = settle(rows.select("x").distinct())
    sizes = fit.agg(F.min(F.size("x")), F.max(F.size("x")), F.count(F.lit(1))).first()
    least, size, count = sizes
    if least != size:
        fit = settle(_padded(fit, size).distinct())
        count = fit.count()
        rows = _padded(rows, size)
    return rows, fit, size or 0, count


def _fitted(fit: DataFrame, size: int, count: int, components: int) -> Whitening:
    sums = _sums(fit, size) if size else []
    triangle = _triangle(fit, size, count, sums) if size else np.zeros((0, 0))
    squares, directions = np.zeros(0), np.zeros((size, 0))
    if size:
        squares, directions = largest_right_vectors(triangle, components)
        real = np.sqrt(squares) > ROUNDING * size * np.sqrt(squares[0])
        squares, directions = squares[real], directions[:, real]
    trace = float((triangle**2).sum()) / max(1, count)
    model = Whitening(count, sums, directions, squares / max(1, count), trace)
    if len(squares):
        # Of either sign; the largest entry is taken to be positive.
        highest = np.abs(directions).argmax(axis=0)
        model.directions = directions * np.sign(directions[highest, np.arange(len(squares))])
        model.identity_error = float(np.abs(_covariance(fit, model) - np.eye(len(squares))).max())
    return model


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening]:
    """``key, deviation, whitened`` of every usable row, and the model.

    Rows whose vector is NULL or holds a NULL or an entry that is not finite are left out. The
    fit list has each different vector of whole steps once, so repeated rows weigh nothing, and
    all come back. ``whitened`` has an entry for each component of the ``components`` largest
    variances, falling; one whose variance is zero, or not to be told from rounding, is left
    out, so that equal or single vectors have none. Shorter vectors are filled up with zeros to
    the longest one, and entries beyond 2 ** 49 count as that. ``deviation`` is the exact sum of
    the squares of ``count * x - sums``, NULL beyond a BIGINT. An empty table gives an empty
    result. Other columns play no part.
    """
    sized, fit, size, count = _sized(usable(rows, key, vector))
    model = _fitted(fit, size, count, components)
    many = model.directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices(batch.column(1), size):
                apart = _from_sums(x, model.count, model.sums)
                white = model.project(apart).ravel()
                ends = np.arange(0, len(white) + 1, many, dtype=np.int32)
                columns = [
                    batch.column(0).slice(at, len(x)),
                    pa.array(_deviations(apart), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(white)),
                ]
                at += len(x)
                yield pa.RecordBatch.from_arrays(columns, [key, "deviation", "whitened"])

    types = f"`{key}` {rows.schema[key].dataType.simpleString()}, {WHITE}"
    if not many:
        nothing = sized.select(
            F.col("key").alias(key),
            F.lit(0).cast("bigint").alias("deviation"),
            F.array().cast("array<double>").alias("whitened"),
        )
        return nothing, model
    return sized.mapInArrow(run, types), model


def components_of(white: DataFrame, model: Whitening) -> DataFrame:
    """A row for every row and component, with what holds for all rows of the component."""
    explained = F.array(*[F.lit(value) for value in model.explained] or [F.lit(0.0)])
    key = white.columns[0]
    return white.select(key, "deviation", F.posexplode("whitened").alias("at", "value")).select(
        key,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.count).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
