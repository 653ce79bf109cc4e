"""Text helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words as BIGINT, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole(text: Column) -> Column:
    """The text, or an empty one for NULL."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def sha256(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


OWN = "_own"


def set_aside(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns, and all others in one struct, so that no helper name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    own = F.struct(*others or [F.lit(0)]).alias(OWN)
    return docs.select(*[c for c in needed if c in docs.columns], own)


def put_back(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs`` again, in their order, of rows that were ``set_aside``."""
    back = [F.col(c) if c in needed else F.col(OWN)[c].alias(c) for c in docs.columns]
    return rows.select(*back)
