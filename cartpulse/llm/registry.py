"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cartpulse.llm import (
    adaptjoin,
    bestfit,
    completion,
    langid,
    lines,
    merkle,
    mixing,
    packing,
    periodic,
    quality,
    simhash,
    tools,
    warc,
    whitening,
)
from cartpulse.llm.tables import read

WORD_BPE = "word_bpe_49k.json"
RunQuery = Callable[[SparkSession, str], DataFrame]


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op2_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path(WORD_BPE)
    return bestfit.packed_matrices(read(spark, sf_dir, "documents"), tokenizer)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path(WORD_BPE)
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer, completion.bin_completion)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_order(read(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints_with_edits(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.linked_calls(read(spark, sf_dir, "conversations"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.planted_runs(read(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptjoin.jaccard_components(read(spark, sf_dir, "documents"))


FOUND = [
    op1_warc_salvage,
    op2_packed_matrices,
    op3_best_fit_packing,
    op4_source_mixing,
    op5_simhash_near_dedup,
    op6_line_dedup,
    op7_document_fingerprints,
    op8_quality_rules,
    op9_tool_call_linking,
    op10_language_id,
    op11_periodic_runs,
    op12_embedding_whitening,
    op13_jaccard_join,
]


def queries() -> dict[str, RunQuery]:
    return {query.__name__: query for query in FOUND} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_salvage": warc.WARC_SQL,
        "op6_line_dedup": lines.LINE_SQL,
        "op9_tool_call_linking": tools.TOOLS_SQL,
        "op13_jaccard_join": adaptjoin.JACCARD_SQL,
    }
