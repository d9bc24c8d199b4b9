"""Whitening against exact integers and a plain eigenvalue solver."""

import math

import numpy as np
import pytest
from conftest import SF_DIR

from millrace.llm import whitening
from millrace.llm.queries import QUERIES


def plain_integers(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [i for i, _ in kept], np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept], dtype=object)


def check(got, rows, components):
    ids, x = plain_integers(rows)
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    deviations = {i: int(d) for i, d in zip(ids, (y * y).sum(axis=1))}
    centred = (y / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == n * components
    for k in range(components):
        mine = np.array([table[i, k + 1].whitened for i in ids])
        plain = centred @ vectors[:, k] / math.sqrt(values[k])
        assert np.abs(mine * np.sign(mine @ plain) - plain).max() < 1e-6
    for r in got:
        assert r.n == n and r.deviation == deviations[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)


def test_query_equals_a_plain_solver(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op12_embedding_whitening"](spark, SF_DIR).collect(), rows, 8)


def test_odd_rows_are_left_out_and_large_entries_stay_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in draw.normal(size=5) * [1, 10, 1e3, 1e6, 1e9]]) for i in range(200)]
    odd = [(-1, None), (-2, [1.0, None, 2.0, 3.0, 4.0]), (-3, [math.nan] * 5), (-4, [math.inf, 1.0, 1.0, 1.0, 1.0]), (-5, [1.0]), (-6, [])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id bigint, embedding array<double>, vector string, value int")
    got = whitening.whitened(table).collect()
    ids, x = plain_integers(rows)
    y = len(x) * x - x.sum(axis=0)
    exact = {i: int(d) for i, d in zip(ids, (y * y).sum(axis=1))}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in exact.items()}
    assert len(got) == 1000 and got[0].identity_error < 1e-6


def test_tables_without_variance_or_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    same = whitening.whitened(spark.createDataFrame([(None, [0.5, -0.5])] * 4, schema)).collect()
    assert len(same) == 8 and all((r.whitened, r.explained, r.deviation, r.identity_error) == (0.0, None, 0, 0.0) for r in same)
    line = whitening.whitened(spark.createDataFrame([(i, [i / 8, 0.0]) for i in range(9)], schema)).collect()
    assert {(r.component, round(r.explained, 12)) for r in line} == {(1, 1.0), (2, 0.0)} and line[0].identity_error < 1e-12


@pytest.mark.parametrize("gaps", [[0, 0, 0, 1, 1, 5], [0, 1e-7, 2e-7, 1e-3, 1e-3 + 1e-9, 1], [3] * 6, [1, 1 + 1e-12, 2, 2 + 1e-13, 3, 3]])
def test_clustered_eigenvalues(gaps):
    draw = np.random.default_rng(1)
    q = np.linalg.qr(draw.normal(size=(6, 6)))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal beyond double precision
        q = q @ (1.5 * np.eye(6, dtype=np.longdouble) - 0.5 * q.T @ q)
    a = q @ np.diag(np.array(gaps, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    values, x = whitening.refined_eigen(a)
    assert np.abs(values - np.sort(np.array(gaps))[::-1]).max() < 1e-14 * max(1, max(gaps))
    assert np.abs(x.T @ x - np.eye(6)).max() < 5e-16
    assert np.abs((a @ x - x * values).astype(float)).max() < 5e-15 * max(1, max(gaps))


def test_limbs_multiply_exactly():
    draw = np.random.default_rng(2)
    x = draw.integers(-(1 << 54), 1 << 54, size=(50, 4))
    assert (whitening.exact_products(x) == x.astype(object).T @ x.astype(object)).all()
