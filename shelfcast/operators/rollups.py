"""Sales totals over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total_by(sales: DataFrame, period: Column) -> DataFrame:
    # Map-side partial sums leave one row per period and task to shuffle, so neither
    # a busy year nor a busy month can overload a reducer.
    return sales.groupBy(period).agg(F.sum("sales").alias("sales"))


def sales_by_year(sales: DataFrame) -> DataFrame:
    """Total per calendar year; rows without a date form the NULL year."""
    return _total_by(sales, F.year("date").alias("year"))


def sales_by_month(sales: DataFrame) -> DataFrame:
    """Total per month, labelled by its first day; rows without a date form the NULL month."""
    return _total_by(sales, F.trunc("date", "MM").alias("month"))


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """Global sort for presenting a result. Keep it last: a later shuffle undoes it."""
    return rows.orderBy(*columns)
