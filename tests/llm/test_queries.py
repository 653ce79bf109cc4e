"""The queries of the subpackage against their SQL in DuckDB, and their contracts."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from shelfcast.llm import queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()

COLUMNS = {
    "op1": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op2": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6": ["doc_id", "size", "source_size", "target", "taken"],
    "op7": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op11": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op13": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}
# Queries with other rows than one for each document.
OTHER_ROWS = ("op3", "op12", "op13")



@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    relation = duck.sql(SQL[name])
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(frame.columns) == sorted(relation.columns)
    order = [relation.columns.index(column) for column in frame.columns]
    key = lambda row: tuple((value is not None, value) for value in row)
    expected = sorted((tuple(row[at] for at in order) for row in relation.fetchall()), key=key)
    assert sorted(map(tuple, frame.collect()), key=key) == expected and expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    wanted = COLUMNS.get(name.split("_")[0], [])
    assert [column for column in frame.columns if column in wanted] == wanted
    if name.split("_")[0] not in OTHER_ROWS:
        assert frame.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    if name.startswith("op3"):
        assert frame.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()


def test_pipeline(spark, sf_dir, documents):
    """Every stage against the stage's own rule, row by row."""
    from shelfcast.llm import mixing, pii, quality
    from shelfcast.llm.text import DOCUMENTS
    from tests.llm.test_neardup import brute
    from tests.llm.test_pii import brute as base_spans

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "near duplicates",
        "personal data",
        "mixing",
        "subword encoding",
    ]
    rows = {row["doc_id"]: row for row in documents.collect()}
    out, docs = [], documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out.append(docs.collect())
        if len(out) < 5:
            assert docs.columns == documents.columns
            docs = spark.createDataFrame(out[-1], DOCUMENTS)
    good, unique, clean, mixed, tokens = out
    kept = {r["doc_id"] for r in quality.judge(documents).collect() if r["kept"]}
    assert {r["doc_id"] for r in good} == kept and 0 < len(kept) < len(rows)
    groups = brute([(r["doc_id"], r["text"]) for r in good], 5, 80)
    assert sorted(r["doc_id"] for r in unique) == sorted(r[0] for r in groups if r[3])
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unique}
    for row in clean:
        spans = base_spans(rows[row["doc_id"]]["text"])
        assert not base_spans(row["text"]) and row["n_chars"] == len(row["text"])
        if not spans:
            assert row["text"] == rows[row["doc_id"]]["text"]
        assert sum(row["text"].count(f"[{kind.upper()}]") for kind in pii.KINDS) == len(spans)
    taken = {
        r["doc_id"]: (r["taken"], r["size"])
        for r in mixing.plan(spark.createDataFrame(clean, DOCUMENTS)).collect()
    }
    copies = {doc_id: int(words / size + 0.5) for doc_id, (words, size) in taken.items()}
    assert sorted(r["doc_id"] for r in mixed) == sorted(d for d, n in copies.items() for _ in range(n))
    assert sorted(r["doc_id"] for r in tokens) == sorted(r["doc_id"] for r in mixed)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in tokens)


def test_pipeline_runs_as_one(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_no_documents(spark, tmp_path):
    from shelfcast.llm.text import DOCUMENTS

    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
