"""The named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import (
    exact_topk,
    fill_in_middle,
    hard_negatives,
    html_text,
    language_id,
    lm_scoring,
    near_dedup,
    oracles,
    packing,
    personal_data,
    quality_rules,
    sentence_pieces,
    toxicity,
    url_filters,
)
from tillwise.llm.common import ship, table

PIECE_MODEL = "piece_bpe_32k.model"
PACKING_TOKENIZER, PACKING_END = "word_bpe_49k.json", 2
LM_RANKS, LM_END, LM_VOCABULARY = "byte_bpe_50k.tiktoken", 50256, 50257


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.verify(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER), PACKING_END
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find_personal_data(table(spark, sf_dir, "documents")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("failed_rules")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(LM_RANKS), public_tokenizers.PATTERN, LM_END, LM_VOCABULARY
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.exact_topk(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.noisy_labels(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(vectors, vectors.where("vec_id % 50 = 0"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipped(query)
    for query in (
        op1_sentencepiece,
        op2_packing,
        op3_personal_data,
        op4_quality_rules,
        op5_minhash_near_dedup,
        op6_lm_scoring,
        op7_html_extraction,
        op8_exact_topk,
        op9_url_filters,
        op10_toxicity,
        op11_fill_in_middle,
        op12_language_id,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op5_minhash_near_dedup": oracles.NEAR_DEDUP,
    "op8_exact_topk": oracles.EXACT_TOPK,
    "op9_url_filters": oracles.URL_FILTERS,
    "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
