"""From raw documents to tokens: five stages of the operators for text data.

Each stage takes all that its predecessor kept and, but for the last, returns the columns of `documents`. `run` writes
every stage as Parquet into the session's shared folder and reads it again for the next, so a lost executor costs one
stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, decontaminate, linededup, neardup, quality
from ledgerlark.llm.tables import table
from ledgerlark.session import run_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHINGLE, PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled part, accepts. Null and empty texts are judged as well."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model, COLUMNS).where("predicted = 1").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; a document that loses all its lines goes. Null texts stay."""
    left = linededup.line_dedup(docs.select(*COLUMNS)).where("__n_lines = 0 OR __n_removed < __n_lines")
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, by runs of five words and a similarity of 0.8.
    Rows without an id stay, and rows that share
    one stay or go together."""
    kept = neardup.near_duplicates(docs, PERCENT, SHINGLE).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi")
    return named.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the rule allows."""
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = judged.where("contaminated").select(F.col("doc_id").alias("id"), "row").distinct()
    rows = docs.select(*COLUMNS).withColumn("__row", F.xxhash64("doc_id", "text"))
    return rows.join(dirty, (F.col("__row") == F.col("row")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of every document, with digests of the ids and of the bytes they decode to."""
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_duplicates", one_of_each_group),
    ("benchmark_decontamination", not_contaminated),
    ("byte_bpe", tokens),
]

# The trained first stage has no SQL form; tests/llm hold each stage and the whole against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    folder = run_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
