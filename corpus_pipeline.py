"""A pipeline over ``documents``: five stages, each over all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, decontaminate, jaccard_join, language, quality
from weftline.llm.registry import table
from weftline.session import cut_lineage

#: Near copies share this percentage of the shingles of so many words. The parameters of op7 are its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the quality classifier accepts; it learns from ``labels`` and the rows that aren't held out."""
    model = quality.fit_labels(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("predicted = 1").select(docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a recognised language: not ``und``, and of a score from ``LEAST_SCORE`` on."""
    network = language.fit_labels(docs)
    found = language.identify(docs, network)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.LEAST_SCORE)).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return jaccard_join.keep_first(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that no benchmark item contaminates."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", keep_quality), ("language", keep_languages), ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_clean), ("bpe", encode)]

#: Trained classifiers and tokenizers can't be stated in SQL; tests hold the rows against a run by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
