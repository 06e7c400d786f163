import random

import pytest

from paceforge.llm import language
from paceforge.llm.common import fold
from paceforge.llm.queries import op7_language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return language.learn(language.learned_part(docs))


def test_reduced():
    assert language.reduced(None) == language.reduced("") == language.reduced("12 ! _ ²") == b""
    assert language.reduced("The the CAT's 12 Ünder_score!!") == "the cat s ünder score".encode()


def test_sizes_by_brute_force(learned):
    """The pieces of a long text, each compressed alone, add up to its size."""
    first, others = language.Compressors(learned, language.LEVEL), [language.Compressors(learned, 6)]
    content = " ".join(f"wort{k} the" for k in range(900)).encode()
    pieces = [content[i : i + 2_000] for i in range(0, len(content), 2_000)]
    assert first.sizes(content) == {k: sum(len(c.compress(p)) for p in pieces) for k, c in first.by.items()}
    best = min(first.sizes(content).items(), key=lambda x: (x[1], x[0]))[0]
    assert language.judge(content, first, others)[0] == best


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = op7_language(spark, SF).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held) > 100
    assert sum(r.rejected for r in got) <= 0.01 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark, learned):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "ein und der die das nicht " * 40_000), (4, None), (None, "the and of that with")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'zz' as lang", "0 as score", "1 as rejected")
    got = sorted((str(r.doc_id), r.lang_pred, r.rejected) for r in language.identify(docs, learned).collect())
    assert got == [("1", "und", True), ("2", "und", True), ("3", "und", True), ("4", "de", False), ("4", "und", True), ("None", "en", False)]
    kept = language.of_known_language(docs, learned)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "None"]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text here", None)], "doc_id long, text string, lang string")
    assert language.learn(docs) == language.learn(docs.limit(0)) == {}
    assert [tuple(r) for r in language.identify(docs, {}).collect()] == [(1, "und", 0.0, True)]
    one = language.learn(docs.selectExpr("doc_id", "text", "'en' as lang"))
    assert language.identify(docs, one).first().lang_pred == "en"


def test_dictionary_takes_from_whole_texts_once(spark):
    """A common opening and a text with many copies fill no dictionary; a span runs over the end of a text."""
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    rows = [(k, "notice of the licence " * 20 + " ".join(words[k : k + 60])) for k in range(300)] + [(1_000 + k, "copied text here") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'xx' as lang")
    content = language.learn(docs)["xx"].decode()
    assert content.count("copied") <= 1 and content.count("licence") < 100 and len(content) <= language.DICTIONARY
    assert len(set(content.split()) & set(words)) > 200
    assert language.span(b"a b c", 10) == b"a b c" and language.span(b"", 5) == b""
    whole = " ".join(words).encode()
    assert set(language.span(whole, 200).split()) <= set(whole.split()) and 180 <= len(language.span(whole, 200)) <= 200


def test_unlearned_languages_and_junk_are_rejected(spark):
    rng = random.Random(4)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(rng.randint(20, 150))) for _ in range(200)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string")

    def rejected(frame, dictionaries, margins):
        got = language.identify(frame, dictionaries, margins=margins).collect()
        return sum(r.rejected for r in got) / len(got)

    part = language.learned_part(docs)
    learned = language.learn(part)
    margins = language.fit_margins(part, learned)
    assert rejected(strange, learned, margins) >= 0.9
    assert rejected(docs.where(fold("doc_id", 5) == 0), learned, margins) <= 0.02
    for lang in ("de", "en", "es", "fr"):
        part = language.learned_part(docs.where(f"lang != '{lang}'"))
        learned = language.learn(part)
        assert rejected(docs.where(f"lang = '{lang}'"), learned, language.fit_margins(part, learned)) >= 0.9, lang


def test_margins_of_nothing(spark):
    docs = spark.createDataFrame([(1, "text here", "en"), (2, None, "en"), (3, "", "fr")], "doc_id long, text string, lang string")
    assert language.fit_margins(docs, {}) == language.fit_margins(docs, language.learn(docs)) == {}
