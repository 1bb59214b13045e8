"""Registered queries of the training-data operators: each applies its operator with
production parameters to whole tables and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rootsweep.llm import (
    decontaminate,
    katz,
    language,
    line_dedup,
    ngram_join,
    packing,
    personal_data,
    token_count,
    toxicity,
    vector_codes,
    vector_join,
    warc,
    whitening,
)
from rootsweep.llm.common import ship
from rootsweep.llm.oracle import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(_table(spark, sf_dir, "pages")).drop("read_back")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(_table(spark, sf_dir, "documents"))


def op7_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and the text that stays."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.personal_data(_table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts,
        op2_decontaminate,
        op3_packing,
        op4_warc,
        op5_toxicity,
        op6_language,
        op7_vector_join,
        op8_ngram_join,
        op9_katz,
        op10_line_dedup,
        op11_personal_data,
        op12_vector_codes,
        op13_whitening,
        pipeline,
    )
}
