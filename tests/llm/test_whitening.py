import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import queries, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def complete(rows):
    return [
        (i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]


def brute_force(rows, most=32):
    """By exact fractions and numpy's eigenvectors of the whole covariance."""
    kept = complete(rows)
    x = [[math.floor(64 * float(c)) + 1000000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = {}
    for (i, _), own, row in zip(kept, x, centred, strict=True):
        deviation = sum((n * c - s) ** 2 for c, s in zip(own, sums, strict=True))
        out.setdefault(i, []).append((n, deviation, row @ vectors / np.sqrt(values)))
    return out, values / np.trace(v)


def compare(found, rows, most=32):
    expected, explained = brute_force(rows, most)
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, []).append(r)
    assert set(by_row) == set(expected)
    signs = None
    for i, own in by_row.items():
        own.sort(key=lambda r: (r.component, r.whitened))
        wanted = expected[i]
        assert len(own) == len(explained) * len(wanted)
        if len(wanted) > 1:
            continue
        assert [r.component for r in own] == list(range(1, len(explained) + 1))
        assert {(r.n, r.deviation) for r in own} == {wanted[0][:2]}
        assert np.allclose([r.explained for r in own], explained, rtol=1e-9)
        white = np.array([r.whitened for r in own])
        if signs is None:
            signs = np.sign(white * wanted[0][2])
        assert np.allclose(white, signs * wanted[0][2], atol=1e-8)
    assert max(r.identity_error for r in found) < 1e-10


def test_whole_table(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    found = queries.queries()["op12_whitening"](spark, small)
    assert found.columns == COLUMNS and dict(found.dtypes)["deviation"] == "bigint"
    compare(found.collect(), [(r.vec_id, r.embedding) for r in vectors.collect()])


ROWS = [
    (1, [0.5, 1.0, -2.0]), (2, [0.25, 3.0, 1.0]), (3, [1.5, -1.0, 0.125]), (4, [2.0, 0.0, 7.0]), (5, [9.0, 2.0, 1.0]),
    (6, None), (7, [1.0, None, 2.0]), (8, [1.0, float("nan"), 2.0]), (9, [1.0, float("inf"), 2.0]), (None, [4.0, 4.5, 1.0]),
    (5, [9.0, 2.0, 1.0]), (10, [-0.001, 1e5, 3.0]),
]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(5)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_odd_rows(spark, kind):
    vectors = frame(spark, ROWS, kind).withColumns({n: F.lit("x") for n in ("id", "n", "whitened", "at", "white", "length")})
    found = whitening.whiten(vectors)
    assert found.columns == COLUMNS
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    compare(found.collect(), rows)


def test_offsets_do_not_cost_digits(spark):
    """A mean a million times the spread, and entries beyond the exact range of doubles."""
    random = np.random.default_rng(1)
    rows = [(i, (1e6 + random.standard_normal(4)).tolist()) for i in range(200)]
    compare(whitening.whiten(frame(spark, rows)).collect(), rows)
    rows = [(i, (random.standard_normal(3) * [1e12, 1, 1e6]).tolist()) for i in range(50)]
    fitted = whitening.fit(frame(spark, rows))
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    assert fitted.n == 50 and fitted.sums == [sum(c) for c in zip(*x, strict=True)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id: int(r.deviation) for r in found} == {
        i: sum((50 * c - s) ** 2 for c, s in zip(v, fitted.sums, strict=True)) for i, v in enumerate(x)
    }
    with pytest.raises(Exception, match="too large"):
        whitening.fit(frame(spark, [(1, [1e30])]))


def test_no_variance_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0, 2.0])] * 4, [(1, []), (2, [])]):
        found = whitening.whiten(frame(spark, rows))
        assert found.columns == COLUMNS and found.count() == 0
    found = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0]), (4, [1.0]), (5, [])])).collect()
    assert {(r.vec_id, r.component, r.explained) for r in found} == {(i, 1, 1.0) for i in (1, 2, 3)}


def test_factor_and_rotations():
    random = np.random.default_rng(3)
    a = random.standard_normal((40, 17)) * np.logspace(0, -6, 17)
    v = a.T @ a
    factor = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v, atol=1e-12 * np.trace(v))
    order = np.argsort([np.flatnonzero(row)[-1] for row in factor], kind="stable")
    assert np.allclose(np.triu(factor[order], 1), 0)
    values, vectors = whitening.principal_components(v)
    wanted = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values, wanted, rtol=1e-6) and np.allclose(vectors.T @ vectors, np.eye(17), atol=1e-9)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    flat = np.ones((4, 4))
    values, vectors = whitening.principal_components(flat)
    assert np.allclose(values, [4.0]) and np.allclose(flat @ vectors, 4 * vectors)
    pairs = [tuple(sorted(p)) for r in whitening._tournament(7) for p in zip(*r, strict=True)]
    assert len(pairs) == len(set(pairs)) == 21
