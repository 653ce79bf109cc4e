"""Daily history kept by series: a catalog table whose files lie as the models read them.

A bucket holds whole series, sorted by day. Spark knows that from the catalog, so that fits,
predictions and scores that group or join by series read the table without moving it, however
often a model is trained on it. Only what is joined to it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.history import colocate
from shelfcast.schemas import HISTORY, SERIES


def keep_history(history: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Store daily history under the catalog name ``table`` and return it as kept.

    The history moves once, into ``buckets`` files, by default as many as the session has
    shuffle partitions: that is the number of tasks which later fit it. A history that was kept
    under the name before is replaced when all tasks are done.
    """
    spark = history.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = colocate(history.select(*HISTORY.names), buckets)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *SERIES).sortBy(*SERIES, "ds").saveAsTable(table)
    return kept_history(spark, table)


def kept_history(spark: SparkSession, table: str) -> DataFrame:
    """The kept history; grouping and joining by series do not shuffle it."""
    return spark.table(table).select(*HISTORY.names)


def forget_history(spark: SparkSession, table: str) -> None:
    """Take the name out of the catalog; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
