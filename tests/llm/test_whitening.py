from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import whitening
from shelfcast.llm.bidiagonal import bidiagonalised, dqds, largest_right_vectors

TABLE = "vec_id bigint, embedding array<float>, label int"


def brute(rows, many=16):
    """Exact steps and sums in Python, numpy's own solver of the exact covariance."""
    kept = []
    for row in rows:
        vector = row["embedding"]
        if vector is None or any(c is None or not np.isfinite(c) for c in vector):
            continue
        kept.append((row["vec_id"], tuple(int(np.floor(64.0 * float(c))) + 1_000_000 for c in vector)))
    size = max((len(x) for _, x in kept), default=0)
    kept = [(key, x + (1_000_000,) * (size - len(x))) for key, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(size)]
    apart = {x: [n * c - s for c, s in zip(x, sums)] for x in fit}
    centred = np.array([[float(Fraction(v, n)) for v in apart[x]] for x in fit]).reshape(n, size)
    variances, directions = np.linalg.eigh(centred.T @ centred / max(1, n))
    variances, directions = variances[::-1][:many], directions[:, ::-1][:, :many]
    trace = np.trace(centred.T @ centred / max(1, n))
    white = dict(zip(fit, centred @ directions / np.sqrt(np.maximum(variances, 1e-300))))
    return {
        "n": n,
        "rows": [(key, sum(v * v for v in apart[x]), white[x]) for key, x in kept],
        "explained": variances / trace if trace else variances,
    }


def check(frame, sure=16):
    wanted = brute(frame.collect())
    white, model = whitening.whiten(frame)
    rows = whitening.components_of(white, model).collect()
    assert model.count == wanted["n"] and model.identity_error < 1e-6
    many = len(model.variances)
    assert np.allclose(model.explained, wanted["explained"][:many], rtol=1e-9)
    by_row = {}
    for row in rows:
        assert row["n"] == wanted["n"] and row["identity_error"] == model.identity_error
        by_row.setdefault((str(row["vec_id"]), row["deviation"]), []).append(row)
    expected = {}
    for key, deviation, values in wanted["rows"]:
        expected.setdefault((str(key), deviation), []).append(values)
    assert {k: len(v) for k, v in by_row.items()} == {k: many * len(v) for k, v in expected.items()}
    got, truth = [], []
    for key, some in expected.items():
        values = sorted(by_row[key], key=lambda row: row["component"])
        got.append([values[at * len(some)]["whitened"] for at in range(many)])
        truth.append(some[0][:many])
    got, truth = np.array(got)[:, :sure], np.array(truth)[:, :sure]
    signs = np.sign((got * truth).sum(axis=0))
    assert np.allclose(got * signs, truth, atol=1e-7)
    return many


@pytest.fixture(scope="module")
def embeddings(spark, sf_dir):
    return spark.read.schema(TABLE).parquet(f"{sf_dir}/embeddings.parquet")


def test_embeddings(embeddings):
    assert check(embeddings) == 16


def test_copies_weigh_nothing(embeddings):
    hot = embeddings.where("vec_id = 3").withColumn("vec_id", F.explode(F.sequence(F.lit(5000), F.lit(6000))))
    first, second = (whitening.whiten(t)[1] for t in (embeddings, embeddings.union(hot)))
    assert first.count == second.count and np.allclose(first.variances, second.variances, rtol=1e-12)
    check(embeddings.limit(100).union(hot.limit(50)).union(embeddings.where("vec_id = 7")))


def test_many_tasks_are_merged_in_rounds(embeddings, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "settle", lambda rows: rows.repartition(7, "x").cache() if "x" in rows.columns else rows.cache())
    assert check(embeddings) == 16


def test_odd_rows(spark):
    """Missing vectors and entries, infinities, a short vector, a repeated row, large entries."""
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0, 3.5], 0),
        (2, [0.5, -2.0, 1.0], None),
        (2, [0.5, -2.0, 1.0], None),
        (3, None, 1),
        (4, [1.0, None, 2.0], 1),
        (5, [nan, 1.0, 1.0], 1),
        (6, [1.0, inf, -inf], 1),
        (7, [4.0, 4.0], 1),
        (8, [], 1),
        (None, [9.0, 1.0, -1.0], 1),
        (9, [1000.0, -30.0, 0.015625], 1),
    ]
    frame = spark.createDataFrame(rows, TABLE).withColumn("x", F.lit("mine")).withColumn("key", F.lit(1))
    assert check(frame) == 3


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [], 0)], [(1, [2.0], 0), (2, [2.0], 1)]])
def test_nothing_to_whiten(spark, rows):
    white, model = whitening.whiten(spark.createDataFrame(rows, TABLE))
    assert whitening.components_of(white, model).collect() == [] and len(model.variances) == 0


def test_fewer_components_than_dimensions(spark):
    random = np.random.default_rng(1)
    basis = random.integers(-3, 4, (3, 8))
    rows = [(at, [float(v) for v in random.integers(-50, 50, 3) @ basis], 0) for at in range(60)]
    assert check(spark.createDataFrame(rows, TABLE)) == 3


def test_deviation_beyond_64_bits(spark):
    """Exact with large entries; what a BIGINT cannot hold is NULL."""
    rows = [(1, [float(1 << 40), 1.0], 0), (2, [0.0, 2.0], 0), (3, [1.0, 7.0], 0), (4, [1e30, 0.0], 0)]
    white, model = whitening.whiten(spark.createDataFrame(rows, TABLE))
    assert model.sums[0] == (1 << 46) + 64 + 4_000_000 + (1 << 55)
    assert [row["deviation"] for row in white.orderBy("vec_id").collect()].count(None) == 4
    small = [(1, [float(1 << 20), 1.0], 0), (2, [0.0, 2.0], 0)]
    white, _ = whitening.whiten(spark.createDataFrame(small, TABLE))
    assert {row["deviation"] for row in white.collect()} == {(1 << 52) + 64 * 64}


def test_sums_are_exact_beyond_doubles():
    x = np.array([[1 << 54, 3], [(1 << 54) + 1, 5]], np.int64)
    assert whitening._from_sums(x, 1000, [7, 9]).tolist() == [
        [1000 * (1 << 54) - 7, 2991],
        [1000 * ((1 << 54) + 1) - 7, 4991],
    ]


def _orthogonal(random, size):
    return np.linalg.qr(random.normal(size=(size, size)))[0]


SPREADS = {
    "even": np.linspace(0.1, 2, 40),
    "graded": 10.0 ** -np.arange(0, 14, 0.5),
    "cluster": np.r_[1 + 1e-9 * np.arange(20), np.linspace(0.1, 0.5, 20)],
    "near": np.r_[1 + 1e-5 * np.arange(20), np.linspace(0.1, 0.5, 20)],
    "pairs": np.repeat(np.linspace(1, 2, 16), 2),
    "equal": np.ones(20),
}


@pytest.mark.parametrize("name", SPREADS)
def test_solver(name):
    random, spread = np.random.default_rng(2), SPREADS[name]
    size = len(spread)
    matrix = _orthogonal(random, size) * spread @ _orthogonal(random, size)
    squares, vectors = largest_right_vectors(matrix, 16)
    assert np.allclose(np.sqrt(squares), np.sort(spread)[::-1][:16], rtol=1e-12, atol=1e-14)
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-11)
    assert np.allclose(matrix.T @ (matrix @ vectors), vectors * squares, atol=1e-12)


def test_small_values_are_accurate():
    """A graded band: the product of all values is that of the diagonal, over 30 decades."""
    diagonal, above = 10.0 ** -np.arange(0, 30, 2), 10.0 ** -np.arange(1, 29, 2)
    found = dqds(diagonal**2, above**2)
    assert np.isclose(np.log10(found).sum(), 2 * np.log10(diagonal).sum(), atol=1e-11)
    assert (np.diff(found) > 0).all() and found[0] < 1e-55


def test_bidiagonalised():
    matrix = np.random.default_rng(3).normal(size=(9, 9))
    diagonal, above, right = bidiagonalised(matrix)
    band = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(right @ (band.T @ band) @ right.T, matrix.T @ matrix)
    assert np.allclose(right.T @ right, np.eye(9))
