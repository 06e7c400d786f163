import random

import numpy as np

from paceforge.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_tiles(item, text, least):
    """Longest common run of what isn't marked, marked and looked for again."""
    item, text, found = list(item), list(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] and item[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return found
        found.append(best)
        item[i : i + n] = text[j : j + n] = [0] * n


def test_tiles_by_brute_force():
    r = random.Random(3)
    for _ in range(300):
        item = [r.randint(1, 4) for _ in range(r.randint(0, 30))]
        text = [r.randint(0, 4) for _ in range(r.randint(0, 50))]
        if r.random() < 0.5:
            cut = r.randint(0, len(item))
            text = text[:10] + item[cut:] + [0] + item[:cut] + text[10:]
        assert d.tiles(np.array(item, np.int64), np.array(text, np.int64), 3) == plain_tiles(item, text, 3)


def test_rolling_hashes():
    ids = np.random.default_rng(1).integers(0, 50, 200)
    long = d.window_hashes(ids, 40)
    for k in (0, 1, 77, len(long) - 1):
        assert long[k] == d.window_hashes(ids[k : k + 40], 40)[0]


def brute(docs, items):
    found = []
    for doc_id, text in docs:
        for item_id, item in items:
            words = d.WORDS.findall((item or "").lower())
            numbers = {w: k + 1 for k, w in enumerate(dict.fromkeys(words))}
            body = [numbers.get(w, 0) for w in d.WORDS.findall((text or "").lower())]
            least = min(d.LEAST, len(words))
            if words:
                tiled = plain_tiles([numbers[w] for w in words], body, least)
                part = sum(t[0] for t in tiled) / len(words)
                if part >= d.COVERAGE:
                    found.append((str(doc_id), str(item_id), round(part, 9), len(tiled)))
    return sorted(found)


def test_rows_by_brute_force(spark):
    r = random.Random(7)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop")
    items = [(k, " ".join(word() for _ in range(r.randint(8, 40)))) for k in range(12)] + [(20, "only three words"), (21, None), (22, ""), (None, "a nameless item of seven words"), (23, "Twice the same item of words here"), (23, "Twice the same item of words here")]
    docs = [(1, None), (2, ""), (3, "x " * 30_000)]
    for k in range(60):
        text = [word() for _ in range(r.randint(0, 80))]
        _, item = r.choice(items[:14])
        words = (item or "").split()
        kind = k % 5
        if kind == 1:
            text += words
        elif kind == 2:
            half = len(words) // 2
            text = words[half:] + text + words[:half]
        elif kind == 3:
            text += words[: len(words) // 3]
        elif kind == 4:
            text = [w.upper() + "," for w in words[2:]] + text
        docs.append((10 + k, " ".join(text)))
    docs += [(200, "so, ONLY three words!"), (201, "only two three words"), (202, "twice the same item of words here"), (202, "twice the same item of words here"), (None, "it is a nameless item of seven words")]
    frame = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as item_id", "'x' as coverage")
    marks = spark.createDataFrame(items, ITEMS).selectExpr("*", "2 as doc_id")
    got = sorted((str(x.doc_id), str(x.item_id), round(x.coverage, 9), x.n_tiles) for x in d.contaminated(frame, marks).collect())
    assert got == brute(docs, items) and len(got) > 30
    kept = d.clean(frame, marks)
    assert kept.schema == frame.schema
    hit = {x[0] for x in got}
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(str(x[0]) for x in docs if str(x[0]) not in hit)


def test_blocks_change_nothing(spark, monkeypatch):
    items = [(k, f"this is item number {k} with its own words w{k} v{k} u{k}") for k in range(30)]
    docs = [(k, f"before this is item number {k} with its own words w{k} v{k} u{k} after") for k in range(30)]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, d.contaminated(*frames).collect()))
    monkeypatch.setattr(d, "BLOCK_WORDS", 100)
    assert len(list(d.blocks(frames[1]))) > 2
    assert sorted(map(tuple, d.contaminated(*frames).collect())) == whole and len(whole) >= 30
    assert d.clean(*frames).count() == 0


def test_steps_with_and_without_matches(spark, monkeypatch):
    monkeypatch.setattr("paceforge.llm.common.CHUNK_ROWS", 2)
    docs = [(k, "this is the item with seven words" if k % 10 == 3 else f"text {k}") for k in range(40)]
    items = spark.createDataFrame([(1, "this is the item with seven words")], ITEMS)
    got = d.contaminated(spark.createDataFrame(docs, DOCS).coalesce(1), items).collect()
    assert sorted(r.doc_id for r in got) == [3, 13, 23, 33]


def test_empty(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], DOCS), spark.createDataFrame([(1, "a b c d e f")], ITEMS)
    assert d.contaminated(docs.limit(0), items).collect() == []
    assert d.contaminated(docs, items.limit(0)).collect() == []
    assert d.clean(docs, items.limit(0)).count() == 1
    assert d.contaminated(docs, items).count() == 1
