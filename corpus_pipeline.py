"""Corpus pipeline: language, quality, near duplicates, mixture, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the
last return the columns they were given. ``run`` applies the stages to ``documents``, each result
written as Parquet and read again. The classifiers and the near-duplicate join are not SQL, so
there is no oracle; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import fold, quoted, ready, table, unused, written
from aeris.llm.language import UNDETERMINED, learn_profiles, predict_languages
from aeris.llm.line_crf import score_documents, train
from aeris.llm.mixing import mixed_rows
from aeris.llm.packing import pack
from aeris.llm.parity_join import one_of_each

#: A text goes when its language score is under this share of what all but a thousandth of the held-out documents of learned languages reach.
LANGUAGE_MARGIN = 0.75
LEAST_HELD_OUT = 100  # held-out documents that a threshold is taken from; with fewer it is the next line's
LEAST_LANGUAGE_SCORE = 0.25
LEAST_QUALITY = 0.3


def least_language_score(held_out: DataFrame, profiles: dict) -> float:
    """The threshold of the language stage, from the scores of documents (``text``) that the profiles weren't learned from."""
    scored = predict_languages(held_out.select("text"), profiles, names=("lang_pred", "score")).where("score > 0")
    found = scored.agg(F.count("*").alias("n"), F.percentile_approx("score", 0.001, 100_000).alias("low")).first()
    return LANGUAGE_MARGIN * found["low"] if found["n"] >= LEAST_HELD_OUT else LEAST_LANGUAGE_SCORE


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose n-grams rank too differently from every learned language: prose of other
    languages and code."""
    ready(spark)
    learned = docs.where(F.col("lang").isNotNull())
    profiles = learn_profiles(learned.where(fold(F.col("doc_id")) != 0))
    least = least_language_score(learned.where(fold(F.col("doc_id")) == 0), profiles)
    language, score = unused(docs.columns, "language", "score")
    judged = predict_languages(docs, profiles, names=(language, score))
    return judged.where((F.col(language) != UNDETERMINED) & (F.col(score) >= least)).select(quoted(docs.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose lines the field holds mostly for bad ones."""
    ready(spark)
    model = train(docs, table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0))
    score, good = unused(docs.columns, "score", "good")
    judged = score_documents(docs, model, LEAST_QUALITY, names=(score, good))
    return judged.where(F.col(good) == 1).select(quoted(docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at 80 % of the 5-word shingles."""
    ready(spark)
    return one_of_each(docs, k=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some up to three times, in proportion to the target weights."""
    return mixed_rows(docs, weights=(5.0, 2.0, 1.0), max_repeats=3)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of the permitted lengths."""
    ready(spark)
    return pack(docs, capacities=(512, 1024, 2048, 4096))


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = written(docs, f"pipeline-{name.split()[0].lower()}")
    return docs
