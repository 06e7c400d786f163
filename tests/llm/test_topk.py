import random
from collections import Counter
from math import log

import numpy as np
import pytest

from paceforge.llm import topk
from paceforge.llm.queries import op4_topk

SCHEMA = "doc_id long, text string"


def brute(docs, queries, top=10):
    """Scores of every query with every text, by the formula."""
    own = [(d, Counter(topk.words(t or ""))) for d, t in docs]
    n = len(own)
    mean = sum(sum(c.values()) for _, c in own) / n
    df = Counter(w for _, c in own for w in c)
    found = []
    for q, t in queries:
        scored = []
        for d, c in own:
            size = sum(c.values())
            s = sum(
                log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (topk.K1 + 1) / (c[w] + topk.K1 * (1 - topk.B + topk.B * size / mean))
                for w in set(topk.words(t or "")) if c[w]
            )
            if s > 0:
                scored.append((-round(s, 7), d is None, d))
        found += [(q, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return found


def shown(result):
    return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 7)) for r in result.collect())


@pytest.mark.parametrize("small", [False, True])
def test_search_by_brute_force(spark, monkeypatch, small):
    if small:  # many shards, blocks and blocks of queries
        for name, value in {"SHARD_TEXTS": 40, "NEIGHBOURS": 2, "QUERY_WORDS": 300}.items():
            monkeypatch.setattr(topk, name, value)
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    docs = [(k, " ".join(r.choices(vocabulary, weights, k=r.randint(1, 60)))) for k in range(1, 400)]
    docs += [(500 + k, docs[7][1]) for k in range(15)] + [(700, "w1 " * 20_000)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    queries = [d for d in docs if d[0] % 20 == 0]
    want = brute(docs, queries)
    got = shown(topk.search(frame, frame.where("doc_id % 20 = 0")))
    # copies tie: their order is by id in both
    assert got == sorted(want)


def test_pruning_leaves_texts_out():
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(3_000)]
    weights = [1 / (k + 1) for k in range(3_000)]
    texts = [" ".join(r.choices(vocabulary, weights, k=30)) for _ in range(2_000)]
    numbers = {w: k for k, w in enumerate(vocabulary)}
    df = Counter(w for t in texts for w in set(t.split()))
    idf = np.array([log(1 + (2_000 - df[w] + 0.5) / (df[w] + 0.5)) for w in vocabulary])
    shard = topk.Shard(list(range(2_000)), texts, numbers, idf, 30.0)
    scored = []
    plain = shard.exact
    shard.exact = lambda t: (scored.append(len(t)), plain(t))[1]
    for k in range(0, 2_000, 50):
        shard.search(np.array(sorted({numbers[w] for w in texts[k].split()})), 10)
    assert sum(scored) < 0.2 * 2_000 * 40


def test_answers_do_not_grow_with_shards_or_ties(spark, monkeypatch):
    """What all passes give for a query is about the same for 16 and 80 shards, and for texts that tie."""
    monkeypatch.setattr(topk, "SHARD_TEXTS", 40)
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    passes = []
    plain = topk._answers
    monkeypatch.setattr(topk, "_answers", lambda *args: (passes.append(plain(*args)), passes[-1])[1])
    for texts in ([" ".join(r.choices(vocabulary, k=12)) for _ in range(3_200)], ["a b"] * 3_200):
        found = []
        for n in (640, 3_200):
            passes.clear()
            frame = spark.createDataFrame(list(enumerate(texts[:n])), SCHEMA).repartition(4)
            result = shown(topk.search(frame, frame.where("doc_id < 5")))
            assert len(result) == 50
            if texts[0] == "a b":
                assert {d for _, _, d, _ in result} == set(range(10))
            found.append(sum(p.count() for p in passes) / 5)
        assert found[1] < 2.5 * found[0] and found[1] < 500


def test_query_of_the_driver(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(op4_topk(spark, sf)) == sorted(brute(docs, [d for d in docs if d[0] % 100 == 0]))


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (100, "a b c"), (100, "a b c"), (None, "a b c"), (3, "B! c"), (4, "z"), (200, "!!"), (300, None)]
    frame = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as score", "'x' as word", "2 as query")
    got = shown(topk.search(frame, frame.where("doc_id % 100 = 0")))
    assert [(q, d) for q, _, d, _ in got] == [(100, 100), (100, 100), (100, None), (100, 3)]
    assert topk.search(frame.limit(0), frame).collect() == topk.search(frame, frame.limit(0)).collect() == []


def test_texts_are_split_once(spark, tmp_path, monkeypatch):
    """The passes read the stored numbers of words; the texts themselves are read before, once."""
    monkeypatch.setattr(topk, "SHARD_TEXTS", 40)
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(200)]
    path = f"{tmp_path}/docs.parquet"
    spark.createDataFrame([(k, " ".join(r.choices(vocabulary, k=20))) for k in range(500)], SCHEMA).write.parquet(path)
    docs = spark.read.parquet(path)
    result = topk.search(docs, docs.where("doc_id < 5"))
    assert result.count() == 50
    assert result.inputFiles() and not [f for f in result.inputFiles() if "docs.parquet" in f]


def test_ties_do_not_grow_with_parts(spark, monkeypatch):
    """Texts that tie with the bar are left out by their ids, so more parts give no more of them."""
    passes = []
    plain = topk._answers
    monkeypatch.setattr(topk, "_answers", lambda *args: (passes.append(plain(*args)), passes[-1])[1])
    monkeypatch.setattr(topk, "SHARD_TEXTS", 40)
    frame = spark.createDataFrame([(k, "a b") for k in range(3_200)], SCHEMA).repartition(80)
    result = shown(topk.search(frame, frame.where("doc_id < 2")))
    assert {d for _, _, d, _ in result} == set(range(10))
    assert sum(p.count() for p in passes) / 2 < 500


@pytest.mark.parametrize("sizes", [(5, 60), (1, 4), (100, 400)])
def test_shard_with_a_floor(monkeypatch, sizes):
    """A floor leaves out what is below it, and of what ties with it the ids above the last, and nothing else."""
    r = random.Random(9)
    vocabulary = [f"w{k}" for k in range(500)]
    weights = [1 / (k + 1) for k in range(500)]
    texts = [" ".join(r.choices(vocabulary, weights, k=r.randint(*sizes))) for _ in range(600)]
    texts += texts[:60] + ["", "other words"]
    ids = [None if k % 97 == 5 else (k * 389) % 1_009 for k in range(len(texts))]
    numbers = {w: k for k, w in enumerate(vocabulary)}
    df = Counter(w for t in texts for w in set(t.split()))
    idf = np.array([log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) for w in vocabulary])
    for common in (topk.COMMON_WORDS, 3):
        monkeypatch.setattr(topk, "COMMON_WORDS", common)
        shard = topk.Shard(ids, texts, numbers, idf, 30.0)
        for k in range(0, 600, 29):
            query = np.array(sorted({numbers[w] for w in texts[k].split()}))
            every = list(zip(*shard.search(query, len(texts))))
            assert every == sorted(every, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
            for at in (0, 3, 9, 40):
                if at < len(every):
                    last, floor = every[at]
                    last = topk.LAST if last is None else last
                    want = [x for x in every if x[1] > floor or x[1] == floor and (topk.LAST if x[0] is None else x[0]) <= last]
                    assert list(zip(*shard.search(query, 10, floor, last))) == want[:10]


def test_blocks_without_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_WORDS", 1)
    docs = [(1, "a b c"), (1, "b d"), (2, "a b"), (2, ""), (None, "c d")]
    frame = spark.createDataFrame(docs, SCHEMA)
    want = brute(docs, [(1, "a b c d"), (2, "a b")])
    assert shown(topk.search(frame, frame)) == sorted(want, key=lambda x: x[:2])
