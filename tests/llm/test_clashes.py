"""Columns of any name pass every function that returns the columns of documents."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import mixing, neardup, pii, sharding
from shelfcast.llm.text import DOCUMENTS

# Every name of a helper column in the code of the subpackage, and some results of operators.
CODE = "".join(path.read_text() for path in Path(mixing.__file__).parent.glob("*.py"))
GIVEN = [column.split()[0] for column in DOCUMENTS.split(", ")]
NAMES = sorted(set(re.findall(r'"(_[a-z][a-z_0-9]*)"', CODE)))
NAMES += ["spans", "kept", "taken", "finish", "target", "node", "words", "n_words"]

FUNCTIONS = {
    "near duplicates": neardup.deduplicated,
    "personal data": pii.redact,
    "mixing": mixing.mixed,
    "shards": sharding.shard,
    **{
        f"stage {name}": lambda docs, stage=stage: stage(docs.sparkSession, docs, None)
        for name, stage in corpus_pipeline.STAGES[:1]
    },
}


def test_helper_names_are_found():
    assert {"_text_hash", "_slice", "_copies", "_part", "_own"} <= set(NAMES)


@pytest.mark.parametrize("name", FUNCTIONS)
def test_columns_come_back(documents, name):
    docs = documents.limit(20).withColumn("lang", F.lit(None).cast("string"))
    mine = {column: F.concat(F.lit(f"mine {column} "), F.col("doc_id").cast("string")) for column in NAMES}
    out = FUNCTIONS[name](docs.withColumns(mine))
    plain = sorted(row["doc_id"] for row in FUNCTIONS[name](docs).collect())
    rows = out.select("doc_id", *NAMES).collect()
    assert sorted(row["doc_id"] for row in rows) == plain and rows
    for row in rows:
        assert all(row[column] == f"mine {column} {row['doc_id']}" for column in NAMES)


@pytest.mark.parametrize("name", FUNCTIONS)
def test_columns_of_an_empty_table(no_docs, name):
    out = FUNCTIONS[name](no_docs)
    assert out.columns[: len(GIVEN)] == GIVEN and out.count() == 0
