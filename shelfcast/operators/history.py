"""Daily history of each series."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import SERIES


def of_series(rows: DataFrame, store: int, item: int) -> DataFrame:
    """Rows of one store and item. The filter reaches the scan of a stored table."""
    return rows.where((F.col("store") == F.lit(store)) & (F.col("item") == F.lit(item)))


def single_series(sales: DataFrame, store: int, item: int) -> DataFrame:
    """One series row by row, not summed: ``ds, y``."""
    return of_series(sales, store, item).select(
        F.col("date").cast("date").alias("ds"), F.col("sales").alias("y")
    )


def daily_history(sales: DataFrame) -> DataFrame:
    """``store, item, ds, y`` with one row per series and day; NULL groups are kept.

    Rows are summed on the map side before the shuffle on all three keys, so a series
    holding a large share of the sales still sends at most one row per day and task.
    """
    return sales.groupBy("store", "item", F.col("date").cast("date").alias("ds")).agg(
        F.sum("sales").alias("y")
    )


def drop_incomplete(history: DataFrame) -> DataFrame:
    """History without days that miss a key, a date or a total."""
    return history.dropna(subset=["store", "item", "ds", "y"])


def clean_history(sales: DataFrame) -> DataFrame:
    """Same rows as ``drop_incomplete(daily_history(sales))``.

    A total is NULL exactly when no sale of that day is known, so incomplete sales can
    go before the sum. That lets the scan skip them, which it cannot do with a
    condition on the total. Plain IS NOT NULL conditions are used, as ``dropna`` counts
    the missing fields of a row in one expression that is not pushed down.
    """
    known = [F.col(name).isNotNull() for name in ("date", "store", "item", "sales")]
    return daily_history(sales.where(reduce(and_, known)))


def colocate(history: DataFrame, partitions: int | None = None) -> DataFrame:
    """History with each series inside one partition.

    The number of partitions is fixed, by default to the session's setting, because
    adaptive execution would merge them by size and a few megabytes of history are
    already many seconds of fitting. A series has one row per day at most, so no
    partition grows with the number of sales.
    """
    if partitions is None:
        partitions = int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return history.repartition(partitions, *SERIES)
