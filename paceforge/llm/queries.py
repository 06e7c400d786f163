"""The operators over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paceforge.llm import decontaminate, html_text, language, language_model, quality, sentencepieces, simhash, spelling, token_counts, topk, toxicity, url_filters, whitening
from paceforge.llm.common import fold, table

#: Vocabulary files, as the installed collection of public tokenizers names them.
COUNT_VOCABULARY, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"

#: What is known about the hosts of the pages.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return topk.search(docs, docs.where("doc_id % 100 = 0"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_VOCABULARY))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    found = quality.classify(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (found.score >= 0.7).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = language.learned_part(docs)
    learned = language.learn(part)
    found = language.identify(docs, learned, margins=language.fit_margins(part, learned))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op8_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.learn(docs, labels.where(fold("doc_id", 5) != 0)))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (found.score >= 0.5).cast("int").alias("predicted"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_model.score(docs, fold("doc_id", 10) != 0)
    return found.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), *found.columns[1:])


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_html_text": op3_html_text,
    "op4_topk": op4_topk,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_sentencepieces": op8_sentencepieces,
    "op9_toxicity": op9_toxicity,
    "op10_language_model": op10_language_model,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_url_filters": op13_url_filters,
}

#: SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {}
