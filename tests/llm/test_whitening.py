"""Whitening against a plain computation with fractions, and its results on odd rows."""

import math
from fractions import Fraction

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import whitening

FOLDER = "/root/testdata/sf0.01"


def plain_numbers(vectors):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]


def plain_covariances(x):
    """n^3 times the covariances, each product taken after centring."""
    n, size = len(x), len(x[0])
    sums = [sum(row[k] for row in x) for k in range(size)]
    t = [[n * v - s for v, s in zip(row, sums)] for row in x]
    return [[sum(r[i] * r[j] for r in t) for j in range(size)] for i in range(size)], t


def test_query_against_plain_version(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    x = plain_numbers(rows.values())
    squares, t = plain_covariances(x)
    n = len(x)
    v = np.array([[float(Fraction(c, n**3)) for c in row] for row in squares])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    found = {}
    from tradeloom.llm import queries

    for r in queries.QUERIES["op12_embedding_whitening"](spark, FOLDER).collect():
        found[r.vec_id, r.component] = r
    assert set(found) == {(i, c) for i in rows for c in range(1, 33)}
    have = np.array([[found[i, c].whitened for c in range(1, 33)] for i in rows])
    want = (np.array(t, float) / n) @ axes[:, :32] / np.sqrt(e[:32])
    sign = np.sign((have * want).sum(0))
    assert np.allclose(have, want * sign, atol=1e-8)
    assert [found[i, 1].deviation for i in rows] == [sum(c * c for c in row) for row in t]
    for c in range(1, 33):
        assert found[0, c].explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
    assert {r.n for r in found.values()} == {n}
    errors = {r.identity_error for r in found.values()}
    assert len(errors) == 1
    cov = have.T @ have / n - np.outer(have.mean(0), have.mean(0))
    assert errors.pop() == pytest.approx(np.abs(cov - np.eye(32)).max(), abs=1e-11) and np.abs(cov - np.eye(32)).max() < 1e-9


@pytest.mark.parametrize("scale", [1, 10**6, 10**9, 10**12])
def test_sums_are_exact_at_every_size(scale):
    rng = np.random.default_rng(scale)
    t = rng.integers(-scale, scale, (300, 5)) * rng.integers(1, 900, (300, 1))
    want = [sum(int(v) ** 2 for v in t[:, k]) for k in range(5)]
    assert whitening.square_sums(t) == want == whitening.square_sums(t.astype(object))


def test_covariances_are_exact(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(700, 6)) * [1, 10, 1e3, 1e-4, 1e5, 1]).tolist()
    rows = spark.createDataFrame([(v,) for v in vectors], "vector array<double>").repartition(5)
    n, sums = whitening.fit_sums(rows)
    x = plain_numbers(vectors)
    assert (n, sums) == (700, [sum(r[k] for r in x) for k in range(6)])
    assert whitening.covariance_sums(rows, n, sums) == plain_covariances(x)[0]


def table(spark, rows):
    clash = {c: F.lit(c) for c in (*cases.CLASHING, "vector", "size", "entry", "total", "component", "n", "a`b")}
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(clash)


def test_odd_rows(spark):
    good = [(k % 7 if k % 5 else None, [float(k % 3), k / 9, -k * k / 50]) for k in range(40)]
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 1.0, 2.0]),
        (105, [1.0, 2.0]), (106, [1e300, 1.0, 1.0]), (None, None),
    ]
    found = whitening.whiten(table(spark, good + bad + good[:5]).repartition(6))
    assert found.count() == 45 * 3
    assert sorted(cases.pairs(found.filter("component = 1"), "vec_id"), key=repr) == sorted([(v,) for v, _ in good + good[:5]], key=repr)
    row = found.first()
    assert row.n == 45 and row.identity_error < 1e-9
    assert sum(r.explained for r in found.limit(3).collect()) == pytest.approx(1)


def test_vectors_without_variation(spark):
    found = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(found) == 4
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in found} == {(None, None, None, 0)}
    line = whitening.whiten(table(spark, [(k, [float(k), 2.0 * k]) for k in range(9)])).collect()
    assert {r.component for r in line if r.whitened is None} == {2}
    assert {r.identity_error < 1e-9 for r in line} == {True}


def test_empty_table(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0


def test_lengths_and_dropped_entries():
    batch = pa.record_batch({"vector": pa.array([[1.0, 2.0], None, [1.0], [], [None, 1.0], [0.5, -0.01]], pa.list_(pa.float64()))})
    found = {(tuple(rows), tuple(map(tuple, x.tolist()))) for rows, x in whitening.whole_numbers(batch)}
    assert found == {((0, 5), ((1_000_064, 1_000_128), (1_000_032, 999_999))), ((2,), ((1_000_064,),))}
