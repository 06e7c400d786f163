"""Documents to training tokens, in five stages.

Each stage takes the whole table that the one before it kept. ``run`` writes every stage's rows as Parquet in the folder that
all machines share and reads them again, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paceforge.llm import decontaminate, language, sentencepieces, simhash, toxicity
from paceforge.llm.common import fold, stored, table
from paceforge.llm.queries import PIECE_MODEL


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't rejected, by dictionaries and margins learned from the documents' own marks."""
    part = language.learned_part(docs)
    learned = language.learn(part)
    return language.of_known_language(docs, learned, margins=language.fit_margins(part, learned))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a machine learned from the labelled ones."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document that is left."""
    return sentencepieces.encode(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("sentence pieces", tokens),
]

#: SQL has no compression, no kernel machine and no vocabulary; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
