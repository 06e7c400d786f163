import re
import zlib
from collections import Counter
from math import log10

import numpy as np
from pyspark.sql import functions as F

from paceforge.llm import language_model as m
from paceforge.llm.queries import op10_language_model

SF = "/root/testdata/sf0.001"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [" "]


def plain(docs, learned):
    """Token counts and base scores, word by word."""
    counts = Counter(w for d, t in docs if learned(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {d: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for d, t in docs}


def test_query_by_brute_force(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(docs, lambda d: zlib.crc32(str(d).encode()) % 10 != 0)
    for hot in (60_000, 50):  # all words broadcast, and most of them joined
        monkeypatch.setattr(m, "HOT_WORDS", hot)
        got = op10_language_model(spark, SF).collect()
        assert len(got) == len(docs)
        for r in got:
            size, known, n, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
            assert abs(r.base_score - score) < 1e-6 * abs(score)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
            assert r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.99 * sum(r.base_score for r in held) > 1.02 * sum(r.base_score for r in held)


def test_probabilities_are_normalised():
    share = np.log10(np.random.default_rng(1).dirichlet(np.ones(12)))
    model = m.LogBilinear(share)
    model.outcome[:] = np.random.default_rng(2).normal(size=model.outcome.shape)
    contexts = np.random.default_rng(3).integers(0, 13, (50, m.CONTEXT))
    total = sum(10 ** model.log10(contexts, np.full(50, u)) for u in range(12))
    assert np.allclose(total, 1, atol=1e-5)
    h = sum(model.context[contexts[:, k]] @ model.matrix[k] for k in range(m.CONTEXT))
    s = h @ model.outcome.T + model.bias
    want = s[:, 3] - np.log(np.exp(s).sum(axis=1))
    assert np.allclose(model.log10(contexts, np.full(50, 3)) * np.log(10), want, atol=1e-4)


def test_training_learns_what_follows():
    """Units that alternate: after training, the right one is nearly sure."""
    model = m.LogBilinear(np.log10(np.array([0.02, 0.49, 0.49])))
    row = np.array([1, 2] * 2_000 + [0], np.int32)
    contexts, outcomes = model.before([row, row])
    assert contexts[0].tolist() == [3, 3, 3] and contexts[2].tolist() == [2, 1, 3] and len(outcomes) == 2 * len(row)
    sums = m._sums(model, 0.0)
    for _ in range(30):
        model.train(contexts, outcomes, 0.25, np.random.default_rng(1), sums)
    found = 10 ** model.log10(np.array([[1, 2, 1], [2, 1, 2]]), np.array([2, 1]))
    assert (found > 0.85).all()


def test_units_share_the_base(spark):
    """The units' shares add up to one, what no text has included."""
    texts = spark.createDataFrame([("a b a",), ("C bé x!",), (None,)], "text string")
    known = m.base(texts)
    assert known.tokens == 9 and known.distinct == 6
    slots = m.OWN_UNITS + m.SHARED_UNITS
    assert abs((10**known.share).sum() * known.total - (known.tokens + 0.1 * known.distinct + 0.1 * slots)) < 1e-6
    assert m.shared_unit(m.END) == 0 and m.Units(known.own)[b"a"] < m.OWN_UNITS <= m.Units(known.own)[b"nowhere"]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "A a Ä\t b"), (3, "A a Ä\t b"), (None, "a"), (4, "z " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as row", "'x' as word")
    for flag in (F.lit(True), F.col("doc_id") == 3, F.lit(False)):
        got = m.score(docs, flag).collect()
        assert len(got) == len(rows)
        keep = {r[0] for r in docs.where(flag).select("doc_id").collect()}
        want = plain(rows, lambda d: d in keep)
        for r in got:
            size, known, n, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n)
            assert abs(r.base_score - score) < 1e-6 * max(1, abs(score))
    assert m.score(docs.limit(0), F.lit(True)).collect() == []


def test_members_grow_and_probabilities_add_up(spark):
    """Words after the units of their own are members; their number grows with the counts, and all is normalised."""
    top = " ".join(f"w{k}" for k in range(m.OWN_UNITS) for _ in range(30))
    less = m.base(spark.createDataFrame([(f"{top} {'anna ' * 9}",)], "text string"))
    rare = " ".join(f"qa{k:03d}xx qb{k:03d}yy" for k in range(300))
    more = m.base(spark.createDataFrame([(f"{top} {'anna ' * 9} {' '.join([rare] * 6)}",)], "text string"))
    assert len(more.own) > len(less.own) + 500 and less.own[b"anna"] >= m.OWN_UNITS + m.SHARED_UNITS
    n = {bytes(r.word): r.n for r in more.counts.collect()}
    for w in (b"anna", b"qa007xx"):
        k = more.own[w]
        found = more.share[more.inner.unit_of[k]] + more.inner.share[more.inner.item_of[k]]
        assert abs(found - log10((n[w] + m.ADDED) / more.total)) < 1e-9
    model, rng = m.LogBilinear(more.share, more.inner), np.random.default_rng(6)
    model.outcome[:], model.item[:] = rng.normal(size=model.outcome.shape), rng.normal(size=model.item.shape)
    contexts = rng.integers(0, model.numbers, (7, m.CONTEXT))
    assert np.allclose(sum(10 ** model.log10(contexts, np.full(7, u)) for u in range(model.numbers)), 1, atol=1e-4)


def test_words_of_one_unit_get_different_gains(spark):
    """Two words of a shared unit, each after one word only: the model learns which."""
    assert m.shared_unit(b"anna") == m.shared_unit(b"abcdna")
    rng = np.random.default_rng(5)
    common = " ".join(f"w{j}" for j in range(m.OWN_UNITS) for _ in range(12))
    rows = [(k, " ".join("w1 anna w5" if x else "w2 abcdna w6" for x in rng.integers(0, 2, 20)) + " " + common) for k in range(200)]
    rows += [(1_000, "w1 anna " * 50), (1_001, "w1 abcdna " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score - r.base_score for r in m.score(docs, F.col("doc_id") < 1_000).collect() if r.doc_id >= 1_000}
    assert got[1_000] > got[1_001] + 5


def test_start_is_bounded_in_tokens():
    """A long text gives a part of its spans to the start, not all of itself; a text drawn whole gives every word."""
    text = "".join(f"w{k} " for k in range(400_000))
    some = [w for span in m.drawn_spans(text, 0.1) for w in span]
    assert 0.05 * 400_000 < len(some) < 0.15 * 400_000 and set(some) <= {*m.words(text), m.END}
    assert [w for span in m.drawn_spans("A b", 1.0) for w in span] == [b"a", b"b", m.END]
    assert list(m.drawn_spans("", 1.0)) == [[m.END]] and list(m.drawn_spans(text, 0.0)) == []


def test_a_token_meets_few_scores():
    """A unit of 2,000 members: no step down to a member is over more than some times the root of these; all adds up to one."""
    rng = np.random.default_rng(8)
    mass = rng.pareto(1.0, 5 + 2_003) + 0.1
    inner = m.Inner(5, 2, np.concatenate([np.full(2_000, 3), np.full(3, 4)]), mass)
    model = m.LogBilinear(np.log10(np.bincount(inner.unit_of, mass) / mass.sum()), inner)
    steps = np.diff(model.nodes.starts)
    assert steps.max() < 4 * 2_000**0.5 and sum(steps) == len(inner.group_share) + len(inner.share)
    items = inner.item_of[3:]
    assert sorted(items) == list(range(len(inner.share))) and (inner.item_of[:3] == -1).all()
    assert np.allclose(10 ** inner.share[items], mass[3:] / np.bincount(inner.unit_of, mass)[inner.unit_of[3:]])
    assert np.allclose(inner.share, inner.group_share[inner.group_of_item] + inner.item_share)
    # untrained, and then with any vectors; also with scores too large for a plain exponential
    contexts = rng.integers(0, model.numbers, (3, m.CONTEXT))
    every = np.arange(model.numbers)
    assert np.allclose(10 ** model.log10(np.tile(contexts[0], (len(every), 1)), every), mass / mass.sum(), rtol=1e-3)
    for scale in (1, 100):
        model.outcome[:], model.node[:] = rng.normal(size=model.outcome.shape) * scale, rng.normal(size=model.node.shape) * scale
        total = sum(10 ** model.log10(contexts, np.full(3, k)) for k in every)
        assert np.allclose(total, 1, atol=1e-4)
    # noise is drawn from the run of the token, each of its nodes at times
    drawn = model.nodes.draw(np.zeros(30_000, np.int64), rng)
    assert set(drawn.ravel()) == set(range(model.nodes.starts[1]))
    often = np.bincount(drawn.ravel()) / 30_000
    assert np.allclose(often, np.exp(model.nodes.odds[: len(often)]), atol=0.05)


def test_columns_of_words_are_numbered_as_words():
    texts = [None, "", " A  b\tÄ\n", "\x0b", "a b.", "x\x1cy\x85 \xa0z ... é .é! ?!x 日本語 the,"]
    found, codes, size = m.word_codes(m.pa.array(texts))
    got = [w for w in (found.to_pylist()[k] for k in codes)]
    want = [w for t in texts for w in [*m.words(t or ""), m.END]]
    assert got == want and size.tolist() == [len(m.words(t or "")) + 1 for t in texts]
    own = {m.END: 0, b"a": 1, "é".encode(): 300}
    unit = m.Units(own)
    assert m.Numbers(own, m.SHARED_UNITS).of(m.pa.array(want, m.pa.binary())).tolist() == [unit[w] for w in want]
