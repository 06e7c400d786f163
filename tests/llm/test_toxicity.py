import tracemalloc
from itertools import combinations

import numpy as np
import pytest

from paceforge.llm import toxicity as t
from paceforge.llm.queries import op9_toxicity

SF = "/root/testdata/sf0.01"


def plain_kernel(a, b):
    """Sum over all pairs of equal subsequences, by listing them."""

    def weights(w):
        found = {}
        for at in combinations(range(len(w)), t.ORDER):
            key = "".join(w[i] for i in at)
            found[key] = found.get(key, 0) + t.DECAY ** (at[-1] - at[0] + 1)
        return found

    x, y = weights(a), weights(b)
    return sum(v * y.get(k, 0) for k, v in x.items())


WORDS = ["abc", "banana", "ananas", "xyz", "idiot", "i.d.i.o.t", "idxiot", "aaaaaaa", "ñandú", "toidi"]


def test_kernel_by_listing_subsequences():
    pairs = [(i, j) for i in range(len(WORDS)) for j in range(len(WORDS))]
    i, j = (np.array(x) for x in zip(*pairs))
    got = t.pairs_kernel(WORDS, WORDS, i, j)
    assert np.allclose(got, [plain_kernel(WORDS[a], WORDS[b]) for a, b in pairs], rtol=1e-4)
    assert np.allclose(t.own_kernel(WORDS), [plain_kernel(w, w) for w in WORDS], rtol=1e-4)


def test_pruning_loses_nothing():
    marks = t.Landmarks(["idiot", "banana", "worthless"])
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("idotbanwrhlesx"), int(rng.integers(3, 12)))) for _ in range(500)] + WORDS
    got = marks.features(words)
    for k, w in enumerate(words):
        own = plain_kernel(w, w)
        for j, s in enumerate(marks.strings):
            value = plain_kernel(w, s) / (own * plain_kernel(s, s)) ** 0.5 if own else 0
            assert abs(got[k, j] - max(0, (value - t.FLOOR) / (1 - t.FLOOR))) < 1e-4


def test_units_and_windows():
    assert t.units("You, A b") == {"you,", "a", "b"}
    assert "idiot" in t.units("an i d i o t")
    assert t.windows("(sc.um)!") == ["sc.um", "scum"]
    assert t.windows("ab") == t.windows("...") == []
    long = "".join(chr(97 + k % 26) for k in range(1_000))
    assert set("".join(t.windows(long))) == set(long) and max(map(len, t.windows(long))) <= t.WINDOW
    assert long[900:911] in "|".join(t.windows(long))


def test_learns_gapped_insults():
    rng = np.random.default_rng(1)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    word = lambda: "".join(rng.choice(syllables, int(rng.integers(1, 4))))
    text = lambda *more: {*(word() for _ in range(60)), *more}
    toxic = [text(str(rng.choice(["blockhead", "numpty", "wazzock"]))) for _ in range(150)]
    model = t.fit(toxic, [text() for _ in range(300)])
    score = lambda w: float(model.score(model.values([w]))[0])
    for w in ("numpty", "n.u.m.p.t.y", "blockhxead", "wazzocks", "(wazzock)"):
        assert score(w) >= 0.5, w
    for w in ("thereon", "hand", "", "number"):
        assert score(w) < 0.5, w
    scorer = t.Scorer(model)
    found = scorer(["", "there on " * 50_000 + "n u m p t y", "there"])
    assert found[1] >= 0.5 > max(found[0], found[2])


def test_learns_every_insult_of_a_wide_lexicon():
    rng = np.random.default_rng(2)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), n))
    plain, insults = [word(rng.integers(3, 9)) for _ in range(2_000)], [word(8) for _ in range(200)]
    text = lambda *more: {*rng.choice(plain, 40), *more}
    model = t.fit([text(insults[k % 200]) for k in range(1_200)], [text() for _ in range(2_400)])
    assert len(model.landmarks.strings) >= 200
    assert (model.score(model.values(insults)) >= 0.5).sum() >= 198
    assert (model.score(model.values(plain)) >= 0.5).sum() <= 2


def test_runs_by_brute_force():
    toxic = [["numpty", "there"], ["numpties"], ["there", "wazzock"], ["wazzock"]]
    clean = [["there"], ["thereon"], ["other"]]
    shared, least = t.toxic_runs(toxic, clean)
    of = [{r for w in x for r in t.runs(w)} for x in toxic]
    away = {r for x in clean for w in x for r in t.runs(w)}
    want = {r: [k for k, x in enumerate(of) if r in x] for r in set().union(*of)}
    assert shared == {r: k for r, k in want.items() if len(k) >= 2 and r not in away} and least == 2
    assert t.pick_landmarks(shared, 4, least) == ["wazzock", "numpt"]
    assert t.toxic_runs([], []) == ({}, 2) and t.pick_landmarks({}, 0, 2) == []


def test_runs_of_many_texts_take_the_memory_of_their_words():
    """Ten times the texts over the same words: what is held follows the words, not the texts."""
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), 8)) for _ in range(600)]
    peaks = []
    for n in (40, 400):
        texts = [sorted({plain[k] for k in rng.choice(600, 400, replace=False)}) for _ in range(3 * n)]
        tracemalloc.start()
        t.toxic_runs(texts[:n], texts[n:])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 2 * peaks[0]


def test_long_words_are_not_remembered():
    model = t.fit([{"numpty", f"a{k}bc"} for k in range(9)], [{"nice", f"b{k}cd"} for k in range(9)])
    scorer = t.Scorer(model)
    assert scorer(["x" * 10_000 + "numpty", "numpty"]).tolist() == scorer(["x" * 10_000 + "numpty", "numpty"]).tolist()
    assert max(map(len, scorer.now)) <= t.REMEMBERED_LENGTH


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op9_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in held if y == 0) <= 0.05 * sum(y == 0 for y, _ in held)
    assert sum(p for y, p in held if y == 1) >= 0.6 * sum(y == 1 for y, _ in held) > 0


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "you numpty"), (1, "you numpty"), (2, None), (3, ""), (None, "nice"), (4, "x" * 100_000)], "doc_id long, text string").selectExpr("*", "1 as score")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 1)], "doc_id long, toxic int")
    for model in (t.learn(docs, labels), t.learn(docs.limit(0), labels), t.learn(docs, labels.limit(0)), t.fit([{"numpty"}] * 9, [{"nice"}] * 9)):
        got = t.score(docs, model).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    kept = t.without_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "None"]
