import random
import re
from collections import Counter
from zlib import crc32

from paceforge.llm import spelling
from paceforge.llm.common import table
from paceforge.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def plain_near(words):
    """{word: near words} by the words' deletions: a replaced letter leaves a gap at the same place."""
    near = {w: set() for w in words}
    gaps = {}
    for w in words:
        for d in deletions(w) & near.keys():
            near[w].add(d)
            near[d].add(w)
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for same in gaps.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    return near


def plain(counts):
    near = plain_near(counts)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def shown(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, path, "documents").collect()]
    got = shown(QUERIES["op12_spelling"](spark, path))
    assert got == plain(plain_counts(rows))
    assert any(r[1] for r in got)


def test_one_edit_of_any_kind_is_found(spark):
    rng = random.Random(4)
    letters = "abcdeéñ"
    counts = {}
    for _ in range(60):
        w = "".join(rng.choices(letters, k=rng.randint(6, 12)))
        counts[w] = rng.randint(5, 4000)
        for _ in range(6):
            i, c = rng.randrange(len(w) + 1), rng.choice(letters)
            kind = rng.randrange(3)
            v = w[:i] + c + w[i:] if kind == 0 else w[:i] + w[i + 1 :] if kind == 1 else w[:i] + c + w[i + 1 :]
            if len(v) >= 6:
                counts[v] = rng.randint(5, 60)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert shown(spelling.variants(df)) == plain(counts)
    pairs = {(r.word, r.other) for r in spelling.near_pairs(df).collect()}
    near = plain_near(counts)
    assert {frozenset(p) for p in pairs} == {frozenset((w, x)) for w in near for x in near[w]} and len(pairs) == sum(map(len, near.values())) // 2


def test_long_chain_of_forms_and_ties(spark):
    # every word is five times as frequent as the one before it
    chain = [("a" * k + "b" * (30 - k), 5**k) for k in range(1, 13)]
    ties = [("kitten", 5), ("kittes", 50), ("kittem", 50), ("kitted", 24)]
    got = {r[0]: r for r in shown(spelling.variants(spark.createDataFrame(chain + ties, "word string, n long")))}
    assert {got[w][2] for w, _ in chain} == {chain[-1][0]}
    assert got["kitten"] == ("kitten", "kittem", "kittem", 5, 3, 50) and got["kitted"][1] is None


def test_rows_of_all_kinds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    long = "x" * 50_000
    text = "Spelling spelling spelling spelling spelling spellimg SPELLING ÉCOLES école× ÷÷÷÷÷÷ short 123456 under_score"
    rows = [(k, text) for k in range(300)] + [(7, text)] * 20 + [(None, text)] * 6 + [(1, None), (2, ""), (3, "!"), (4, f"{long} {long}y")] + [(k, f"{long}-{long}y") for k in range(10, 16)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'w' as word", "1 as n", "2 as other", "3 as root").repartition(5)
    got = shown(spelling.variants(spelling.word_counts(docs)))
    counts = plain_counts(rows)
    assert [(r[0], r[3]) for r in got] == sorted(counts.items())
    by_word = {r[0]: r for r in got}
    assert by_word.keys() >= {"spelling", "spellimg", "Écoles", "école×", "÷÷÷÷÷÷", long, long + "y"}
    assert by_word[long][4] == 1 and by_word["spellimg"][1] == "spelling"
    assert shown(spelling.variants(spelling.word_counts(docs.limit(0)))) == []
