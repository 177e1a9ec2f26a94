"""The registered queries of this subpackage: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import decontaminate, langid, linededup, mixing, nearest, overlap, packing, pages, quality, ranked
from meterloom.llm import spelling, suffix, tokens
from meterloom.llm.common import table
from meterloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    named = langid.identified(docs)
    return named.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op2_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents"), length=400)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_counts(table(spark, sf_dir, "documents"), path, limit=1024)


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op7_shingle_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.near_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op8_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op9_packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), path, size=2048, end=1)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op11_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hit_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hyperdimensional_language": op1_hyperdimensional_language,
    "op2_quality_votes": op2_quality_votes,
    "op3_repeated_bytes": op3_repeated_bytes,
    "op4_main_text": op4_main_text,
    "op5_token_counts": op5_token_counts,
    "op6_top_products": op6_top_products,
    "op7_shingle_components": op7_shingle_components,
    "op8_repeated_lines": op8_repeated_lines,
    "op9_packed_windows": op9_packed_windows,
    "op10_source_mix": op10_source_mix,
    "op11_ranked_documents": op11_ranked_documents,
    "op12_benchmark_hits": op12_benchmark_hits,
    "op13_spelling_variants": op13_spelling_variants,
}
