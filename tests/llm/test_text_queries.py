"""Registered queries against their SQL, and the pipeline stage by stage, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest
from plain import contamination, line_dedup, near_duplicates, sha, substring_dedup

import corpus_pipeline
from ledgerlark.llm import bpe
from ledgerlark.llm.queries import ORACLE, QUERIES

CODEC = bpe.Codec(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY), corpus_pipeline.public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, database, name):
    found = QUERIES[name](spark, folder)
    columns = ", ".join(f'"{c}"' for c in found.columns)
    expected = database.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, expected))


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_queries_without_sql_equal_plain_versions(spark, folder):
    docs = texts(spark.read.parquet(f"{folder}/documents.parquet"))
    found = QUERIES["op6_substring_dedup"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted((d, n, r, sha(kept)) for d, n, r, kept in substring_dedup(docs))
    found = QUERIES["op10_minhash_near_duplicates"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(near_duplicates(docs))
    found = QUERIES["op8_byte_bpe"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(tokens(docs))


def tokens(docs):
    return [(d, len(ids := CODEC.encode(t or "")) // 4, sha(ids), sha((t or "").encode())) for d, t in docs]


@pytest.mark.parametrize("name,label,share", [("op2_quality_classifier", "quality", 0.97), ("op9_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, share):
    """At this scale a third of the texts labelled toxic hold no word that any other toxic text has."""
    folder = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r[label] for r in found) >= share * len(found)
    assert name != "op9_toxicity" or not any(r.predicted and not r.toxic for r in found)


def test_license_query_finds_the_notices(spark, folder):
    found = {r.doc_id: r.families for r in QUERIES["op4_license_scan"](spark, folder).collect()}
    marks = {"Apache-2.0": "Apache License", "MIT": "MIT License", "CC-BY-NC": "CC BY-NC", "GPL": "General Public License"}
    for doc, text in texts(spark.read.parquet(f"{folder}/documents.parquet")):
        assert found[doc] == ",".join(sorted(f for f, mark in marks.items() if mark in (text or ""))), doc


def test_pipeline_stages(spark, folder):
    """Each stage keeps what the plain version keeps of its own input, and `run` is the stages in turn."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 AS row", "2 AS kept").cache()
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_duplicates", "benchmark_decontamination", "byte_bpe"]
    scores = {r.doc_id: r.predicted for r in QUERIES["op2_quality_classifier"](spark, folder).collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found, given = stage(spark, docs, folder).cache(), texts(docs)
        if number == 4:
            assert sorted(map(tuple, found.collect())) == sorted(tokens(given))
            break
        assert found.columns == corpus_pipeline.COLUMNS
        assert all(r.n_chars == len(r.text) for r in found.collect())
        expected = [
            lambda: [(d, t) for d, t in given if scores[d]],
            lambda: [(d, t) for d, t, n, gone in line_dedup(given) if not n or gone < n],
            lambda: [(d, t) for (d, t), r in zip(given, near_duplicates(given, 80, 5), strict=True) if r[3]],
            lambda: [(d, t) for (d, t), r in zip(given, contamination(given, benchmark), strict=True) if not r[5]],
        ][number]()
        assert sorted(texts(found)) == sorted(expected) and 0 < len(expected) <= len(given)
        docs = found
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, found.collect()))


def test_stages_on_awkward_rows(spark, folder):
    rows = [(1, None, "en", "s", None), (2, "", "en", "s", 0), (None, "some words here", None, None, 3), (3, "same text\nof two lines", "en", "s", 9), (3, "same text\nof two lines", "en", "s", 9), (4, "x" * 100_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, folder)
            assert found.count() <= table.count(), name
            if name in ("minhash_near_duplicates", "benchmark_decontamination", "byte_bpe"):
                assert found.count() == table.count(), name
