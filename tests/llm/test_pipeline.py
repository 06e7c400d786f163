"""The pipeline against a version in plain Python, and its stages on awkward rows."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from paceforge.llm import language, toxicity
from paceforge.llm.common import fold
from tests.llm.test_decontaminate import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def models(spark, docs):
    """What the stages learn; the plain version judges each text with it."""
    learned = language.learn(language.learned_part(docs))
    first, more = language.Compressors(learned, language.LEVEL), [language.Compressors(learned, x) for x in language.TIE_LEVELS]
    return lambda t: language.judge(language.reduced(t), first, more)[2]


def test_run_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    rejected = models(spark, docs)
    rows = {d: t for d, t in rows.items() if not rejected(t)}
    left = docs.where(docs.doc_id.isin(list(rows)))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(fold("doc_id", 5) != 0)
    model = toxicity.learn(left, labels)
    scorer = toxicity.Scorer(model)
    rows = {d: t for d, t in rows.items() if scorer([t])[0] < 0.5}
    group = plain_components([(d, plain_fingerprint(t)) for d, t in rows.items()])
    rows = {d: t for d, t in rows.items() if group[d] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    shared = {w for _, t in items for w in t.lower().split()}
    maybe = [(d, t) for d, t in rows.items() if len(t) < 6_000 and shared & set(t.lower().split())]
    hit = {int(x[0]) for x in brute(maybe[:40], items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(got) <= set(rows) and not hit & set(got)
    assert {d for d, _ in maybe[:40]} - hit <= set(got)
    for d, r in got.items():
        assert r.token_ids == library.encode(rows[d]) and r.n_tokens == len(r.token_ids)


def test_stages_keep_columns_and_bear_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the cat and the dog sat there with them", "en", "s", 3), (3, "the cat and the dog sat there with them", "en", "s", 3), (None, "the cat and the dog", "en", None, 1), (4, "x" * 50_000, "de", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as score", "'x' as node", "2 as item_id")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, frame, SF)
            assert kept.columns == frame.columns, name
            assert {str(r.doc_id) for r in kept.collect()} <= {"1", "2", "3", "4", "None"}
        assert corpus_pipeline.tokens(spark, frame, SF).count() == frame.count()


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near duplicates", "decontamination", "sentence pieces"]
