"""Registered queries of this subpackage, with their SQL where SQL can say the same over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    bpe, decontaminate, filteraudit, fillmiddle, licenses, linededup, merkle, mtree, neardup, quality, substringdedup, tokenfiles, toxicity,
)
from ledgerlark.llm.tables import table
from ledgerlark.session import run_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY, END_ID = "word_bpe_49k.json", 2
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_merkle_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All pages against a replica with faults by rule."""
    pages = table(spark, folder, "pages")
    return merkle.audit(pages, merkle.damaged(pages))


ORACLE["op1_merkle_fixity_audit"] = merkle.ORACLE_SQL


@query
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("row")


ORACLE["op3_winnowing_decontamination"] = decontaminate.ORACLE_SQL


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.line_dedup(table(spark, folder, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), kept.alias("kept_sha256"))


ORACLE["op5_line_dedup"] = linededup.ORACLE_SQL


@query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substringdedup.substring_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings"))


ORACLE["op7_mtree_top_k"] = mtree.ORACLE_SQL


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query
def op11_packed_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as files of packed ids, and what is read back from them."""
    files = run_dir(spark, "tokens")
    tokenfiles.write_tokens(table(spark, folder, "documents"), files, public_tokenizers.path(WORD_VOCABULARY), END_ID)
    return tokenfiles.token_checks(spark, files)


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op12_filter_audit"] = filteraudit.ORACLE_SQL


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Texts stored in frames, their outputs made from these, and digests of the outputs and of what they restore."""
    frames = run_dir(spark, "frames")
    fillmiddle.store(table(spark, folder, "documents")).write.parquet(frames)
    return fillmiddle.digests(fillmiddle.transform(spark.read.parquet(frames)))


ORACLE["op13_fill_in_middle"] = fillmiddle.ORACLE_SQL
