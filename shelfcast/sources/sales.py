"""Daily sales rows: ``date, store, item, sales``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.schemas import SALES

LINEITEM = "l_partkey bigint, l_suppkey bigint, l_quantity double, l_shipdate timestamp_ntz"


def read_sales_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sales from CSV files with a header line.

    The schema is given, so no inference pass reads the files. A field that cannot
    be parsed becomes NULL and its row stays.
    """
    return spark.read.csv(path, header=True, schema=SALES)


def read_lineitem(spark: SparkSession, path: str) -> DataFrame:
    """The columns of order lines that sales are made of; no footer is read to find them."""
    return spark.read.schema(LINEITEM).parquet(path)


def sales_from_lineitem(
    lineitem: DataFrame, stores: int | None = 5, items: int | None = 4
) -> DataFrame:
    """Order lines as sales rows: suppliers stand for stores, parts for items.

    Keys are folded onto ``stores`` and ``items`` values so that each series has
    enough days to fit. ``None`` keeps one store per supplier or item per part.
    Every line is used either way.
    """
    return lineitem.select(
        F.col("l_shipdate").cast("date").alias("date"),
        _folded("l_suppkey", stores).alias("store"),
        _folded("l_partkey", items).alias("item"),
        F.col("l_quantity").cast("int").alias("sales"),
    )


def _folded(key: str, size: int | None):
    number = F.col(key) if size is None else F.col(key) % size
    return (number + 1).cast("int")
