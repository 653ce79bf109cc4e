"""The corpus pipeline: documents in, token ids of the cleaned and mixed corpus out.

Each stage reads what the stage before it stored, works on all of it, and returns the columns
of documents. The last one returns token ids. A NULL text counts as an empty one, NULL in any
other column is a value like others, long texts are taken as a whole, ties and repeated rows are
settled as the operators say, and no documents give no rows. Further columns, whatever their
names, pass all stages but the last.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import mixing, neardup, pii, quality, subword
from shelfcast.llm.queries import model_path
from shelfcast.llm.text import put_back, read_documents, set_aside
from shelfcast.sources.settled import settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass every quality rule; one without words does not."""
    judged = quality.judge(set_aside(docs, "doc_id", "text"))
    return put_back(judged.where("kept"), docs, "doc_id", "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 80% in common).

    Documents without words are in no group and stay.
    """
    return neardup.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target proportions; a document may be there twice."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, checked by decoding them again."""
    encoded = subword.encode(docs, model_path()).withColumn("n_tokens", F.size("ids").cast("long"))
    back = F.col("decoded") == F.coalesce("text", F.lit(""))
    return encoded.withColumn("round_trip", back).select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip"
    )


STAGES = [
    ("quality rules", keep_good),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact),
    ("mixing", mix_sources),
    ("subword encoding", tokenize),
]

# Subword encoding has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
