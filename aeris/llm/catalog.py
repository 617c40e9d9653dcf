"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import fold, ready, table
from aeris.llm.cover_tree import top_k
from aeris.llm.divergence import quality_rules
from aeris.llm.hard_negatives import hard_negatives, labelled_vectors
from aeris.llm.hmm import language_model_scores
from aeris.llm.language import learn_profiles, predict_languages
from aeris.llm.line_crf import score_documents, train
from aeris.llm.mixing import mix
from aeris.llm.packing import pack
from aeris.llm.parity_join import near_duplicates
from aeris.llm.ring import shard_rows
from aeris.llm.spelling import noisy_words, spelling_groups
from aeris.llm.token_counts import count_tokens
from aeris.llm.url_filter import Rule, judge_urls

#: The host and path rules of the URL query.
URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; an outcome is the label of the document of the same id: good if of
    quality 1 and not toxic."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.expr("cast(quality = 1 and coalesce(toxic, 0) = 0 as int)").alias("good"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op2_parity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at 85 % of their 4-word shingles, as components."""
    found = near_duplicates(table(spark, sf_dir, "documents"), k=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op5_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), max_repeats=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 under the law ``bytes``: shard sizes stay near equal."""
    return shard_rows(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored by a model learned outside fold 1."""
    fold_ = fold(F.col("doc_id"))
    return language_model_scores(table(spark, sf_dir, "documents"), trains=fold_ != 1, held_out=fold_ == 1)


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a field learned from labelled documents outside the held-out fold."""
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.select("doc_id", "text"), marks.where(fold(F.col("doc_id")) != 0))
    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return score_documents(rows, model, threshold=0.3).drop("text")


def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by profiles learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull()))
    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return predict_languages(rows, profiles).drop("text")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacities=(512, 1024, 2048, 4096))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' words, typing errors planted in one of 31, grouped with their more frequent forms."""
    return spelling_groups(noisy_words(table(spark, sf_dir, "documents")), ratio=10)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the byte-level vocabulary of 50,257 tokens."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives that score 80 % to 100 % of each of the five positives of every hundredth vector; every seventh label is moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(table(spark, sf_dir, "embeddings"), label, scale=256)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, share=(80, 100))


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ready(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _registered(f) for f in (
        op1_url_reputation, op2_parity_jaccard, op3_cover_tree_topk, op4_divergence_rules, op5_weighted_fair_mix,
        op6_hidden_markov, op7_line_crf, op8_bounded_ring, op9_rank_order_language, op10_best_fit_packing,
        op11_spelling_variants, op12_token_counts, op13_segment_negatives)}
