"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format
from .best_fit_packing import best_fit_packing
from .common import table
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_join
from .lm_scoring import lm_scoring
from .oracles import ORACLES
from .piece_viterbi import piece_viterbi
from .quality_rules import quality_rules
from .token_counts import count_tokens
from .toxicity import toxicity
from .url_filters import url_filters


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_viterbi(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations become transcripts, the model learns from two thirds of them, and the turns of all are recovered."""
    lines = chat_format.number_lines(chat_format.transcripts(table(spark, sf_dir, "conversations")))
    model = chat_format.fit(lines.where(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 3 != 1))
    return chat_format.turns(lines, model)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_quality_rules, op3_sentencepiece, op4_lm_scoring, op5_best_fit_packing, op6_ngram_jaccard, op7_toxicity, op8_exact_dedup, op9_chat_format, op10_url_filters)}


def oracle_sql() -> dict[str, str]:
    return ORACLES
