import numpy as np
import pytest

from paceforge.llm import whitening
from paceforge.llm.common import table
from paceforge.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, top=8):
    """{(vec_id, component): (deviation, whitened up to sign, share)} by a dense eigensolver on the exact covariance."""
    kept = [(k, np.floor(1024 * np.array(v, float)).astype(int) + 100000) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    n, s = len(x), x.sum(axis=0)
    c = (x * n - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = {}
    for (k, own), row in zip(kept, c):
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(own, s))
        for j in range(min(top, int((values > 1e-9 * values[0]).sum()))):
            found[k, j + 1] = (deviation, abs(row @ vectors[:, j]) / np.sqrt(values[j]), values[j] / values.sum())
    return n, found


@pytest.mark.parametrize("seed", range(4))
def test_solver_on_graded_matrices(seed):
    rng = np.random.default_rng(seed)
    r = np.triu(rng.normal(size=(24, 24))) * np.logspace(0, -seed * 2, 24)
    a, b, v = whitening.bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(24), atol=1e-13)
    upper = np.diag(a) + np.diag(b, 1)
    assert np.allclose(upper.T @ upper, v.T @ r.T @ r @ v, atol=1e-12)
    assert np.allclose(np.sqrt(whitening.dqds(a, b))[::-1], np.linalg.svd(upper, compute_uv=False), rtol=1e-10 if seed < 2 else 1e-6)
    values, vectors = whitening.directions(r, 8)
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-10)
    assert np.allclose(r.T @ (r @ vectors), vectors * values, atol=1e-12 * values[0])


def test_small_values_are_relatively_accurate():
    # the product of the diagonal is the product of the singular values, also the smallest
    a, b = np.array([1.0, 1e-5, 1e-10, 1e-15]), np.array([1.0, 1e-5, 1e-10])
    found = np.sqrt(whitening.dqds(a, b))
    assert np.isclose(np.prod(found), np.prod(a), rtol=1e-13, atol=0)


def test_equal_and_close_values():
    rng = np.random.default_rng(7)
    turn, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    for values in ([5.0] * 4 + [1.0] * 16, [3, 3 - 1e-9, 3 - 2e-9, 3 - 1e-6] + [0.5] * 16, [2.0] + [0.0] * 19, [1.0] * 20):
        r = np.linalg.qr(np.diag(np.sqrt(values)) @ turn.T, mode="r")
        found, vectors = whitening.directions(r, 8)
        assert np.allclose(found, sorted(values, reverse=True)[: len(found)], rtol=1e-12)
        assert len(found) == min(8, np.count_nonzero(values))
        assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-9)
        assert np.allclose(r.T @ (r @ vectors), vectors * found, atol=1e-9)
    assert whitening.directions(np.zeros((3, 3)), 8)[0].size == 0
    assert whitening.directions(np.array([[2.0]]), 8)[0].tolist() == [4.0]


def check(got, rows):
    n, want = plain(rows)
    assert len(got) == len(want)
    for row in got:
        deviation, whitened, share = want[row.vec_id, row.component]
        assert (row.n, row.deviation) == (n, deviation)
        assert abs(row.whitened) == pytest.approx(whitened, rel=1e-7, abs=1e-7)
        assert row.explained == pytest.approx(share, rel=1e-9)
        assert 0 <= row.identity_error < 1e-9
    return got


def test_query_against_a_dense_solver(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in table(spark, path, "embeddings").collect()]
    got = check(QUERIES["op11_whitening"](spark, path).collect(), rows)
    w = np.zeros((len(rows), 8))
    place = {k: i for i, (k, _) in enumerate(rows)}
    for r in got:
        w[place[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(np.cov(w.T, bias=True) - np.eye(8)).max() < 1e-9


def test_rows_that_cannot_be_used_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=5).round(3).tolist()) for k in range(40)] + [(50, None), (51, [None] * 5), (52, [1.0, float("nan"), 0.0, 0.0, 0.0]), (53, [float("inf")] * 5)]
    again = rows + [(40, rows[0][1]), (41, rows[0][1])]
    extra = [(60, [1.0, 2.0]), (61, []), (62, [1e30] * 5)]
    df = spark.createDataFrame(again + extra, SCHEMA).selectExpr("*", "'x' as n", "1 as d", "2 as component", "3 as deviation").repartition(7)
    got = check(whitening.whiten(df, whitening.fit(df)).collect(), [(k, None if v is None else np.float32([np.nan if c is None else c for c in v]).tolist()) for k, v in again])
    assert {r.vec_id for r in got} == set(range(42))


def test_many_partitions_meet(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MEETING_BYTES", 1)
    rng = np.random.default_rng(5)
    rows = [(k, np.float32(rng.normal(size=4) * [9, 3, 1, 0.1]).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(11)
    check(whitening.whiten(df, whitening.fit(df)).collect(), rows)


def test_tables_without_a_spread(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA), None).count() == 0
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert whitening.whiten(df, whitening.fit(df)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 0.0, 2.0 * k]) for k in range(9)] + [(None, [1.0, 0.0, 2.0])], SCHEMA)
    got = whitening.whiten(line, whitening.fit(line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and [r.vec_id for r in got].count(None) == 1


def test_deviations_beyond_a_long():
    model = whitening.Whitening(3_000_000_000, [3_000_000_000 * 5 + 7], np.eye(1), np.ones(1), np.ones(1), 1024, 0)
    assert model.deviations(np.array([[5], [6], [900]])) == [49, (3_000_000_000 - 7) ** 2, None]
