"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from courierlake.llm import oracles
from courierlake.llm.common import table
from courierlake.llm.exact_dedup import exact_dedup
from courierlake.llm.filter_audit import filter_audit
from courierlake.llm.merkle import manifest_digests
from courierlake.llm.mixing import mix
from courierlake.llm.multi_index import nearest
from courierlake.llm.ngram_join import ngram_components
from courierlake.llm.packing import pack
from courierlake.llm.quality import quality_scores
from courierlake.llm.secret_scan import secret_digests
from courierlake.llm.seed_chains import passages
from courierlake.llm.sentencepiece_codec import codec_digests
from courierlake.llm.suffix_dedup import suffix_dedup
from courierlake.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digests(table(spark, sf_dir, "documents"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_substring_chains": op1_substring_chains,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_counts": op4_token_counts,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_inverted_multi_index": op6_inverted_multi_index,
    "op7_secret_scan": op7_secret_scan,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_mixing": op12_source_mixing,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op12_source_mixing": oracles.SOURCE_MIXING,
    "op13_filter_audit": oracles.FILTER_AUDIT,
}
