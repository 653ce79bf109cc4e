"""Temporary views and SQL text over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

YEAR_SALES = """
SELECT year(date) AS year, sum(sales) AS sales
FROM IDENTIFIER(:sales)
GROUP BY ALL
ORDER BY ALL
"""

MONTH_SALES = """
SELECT trunc(date, 'MM') AS month, sum(sales) AS sales
FROM IDENTIFIER(:sales)
GROUP BY ALL
ORDER BY ALL
"""

DAILY_SALES = """
SELECT store, item, date AS ds, sum(sales) AS y
FROM IDENTIFIER(:sales)
GROUP BY ALL
"""

SERIES_SALES = """
SELECT date AS ds, sales AS y
FROM IDENTIFIER(:sales)
WHERE store = :store AND item = :item
"""


def register(rows: DataFrame, view: str) -> str:
    """Make the rows queryable as ``view``, replacing an earlier view of that name."""
    rows.createOrReplaceTempView(view)
    return view


def read_view(spark: SparkSession, view: str) -> DataFrame:
    return spark.table(view)


def run_sql(spark: SparkSession, text: str, **parameters) -> DataFrame:
    """SQL text to DataFrame. Values are bound as parameters, never pasted into the text."""
    return spark.sql(text, args=parameters)
