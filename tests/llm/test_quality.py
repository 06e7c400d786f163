import numpy as np

from paceforge.llm import quality as q
from paceforge.llm.queries import op6_quality

SF = "/root/testdata/sf0.01"


def plain_isotonic(marks):
    """Least squares under a rising order, by the min-max formula."""
    n = len(marks)
    mean = lambda a, b: sum(marks[a:b]) / (b - a)
    return [max(min(mean(a, b) for b in range(k + 1, n + 1)) for a in range(k + 1)) for k in range(n)]


def test_isotonic_by_min_max():
    rng = np.random.default_rng(2)
    for _ in range(30):
        values, marks = rng.normal(size=25), rng.integers(0, 2, 25).astype(float)
        knots, levels = q.isotonic(values, marks)
        assert (np.diff(levels) > 0).all() and (np.diff(knots) >= 0).all()
        want = plain_isotonic(marks[np.argsort(values)].tolist())
        assert np.allclose(sorted(set(np.round(want, 9))), np.round(levels, 9))


def test_statistics():
    found = dict(zip(q.STATISTICS, q.statistics("The THE cat!! a|b\nÜber 12\nÜber 12")))
    assert found["upper_words"] == 1 / 8 and abs(found["repeated_lines"] - 1 / 3) < 1e-12 and found["exclamations"] == 2 / 8
    assert found["top_word"] == 2 / 8 and found["marked_ends"] == 1 / 8 and found["bars"] == 1 / 8
    assert q.statistics("") == [0.0] * len(q.STATISTICS)
    assert len(q.statistics(" \n")) == len(q.STATISTICS) == len(q.statistics("w " * 200_000))


def test_equations_add_up_as_one_matrix(spark):
    rng = np.random.default_rng(1)
    stats, marks = rng.normal(size=(300, len(q.STATISTICS))), rng.integers(0, 2, 300).astype(float)
    model = q.Model(0.5, np.zeros(len(q.STATISTICS)), np.ones(len(q.STATISTICS)))
    rows = spark.createDataFrame([(s.tolist(), float(m)) for s, m in zip(stats, marks)], "stats array<double>, mark double")
    x = model.features(stats)
    assert np.allclose(q._equations(model, rows), x.T @ np.hstack([x, marks[:, None]]))
    close = x[:, :-1] @ x[:, :-1].T
    exact = np.exp(-((stats[:, None] - stats[None]) ** 2).sum(2) / (2 * q.WIDTH**2))
    assert np.abs(close - exact).mean() < 0.1


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op6_quality(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in held) >= 0.95 * len(held) > 50


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "some text"), (3, "x" * 300_000), (4, "a b"), (5, "c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as stats")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1) for k in range(1, 6)] + [(4, 1), (9, 0), (5, None)], "doc_id long, quality int")
    got = q.classify(docs, one).collect()
    assert len(got) == len(rows) and {r.score for r in got} <= {1.0, 0.5}
    assert q.classify(docs.limit(0), one).collect() == []
