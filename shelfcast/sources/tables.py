"""Stored tables, as Parquet folders partitioned by training date.

A write replaces the partitions it has rows for and leaves the others alone, so a rerun
of one training date never duplicates or loses another.
"""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from shelfcast.operators.evaluation import stamp
from shelfcast.schemas import EVALUATION, FORECAST_TABLE, PARAMETERS, SHORT_SERIES
from shelfcast.sources.settled import scratch, settle

TRAINING_DATE = "training_date"

# Names of the forecast columns in the table.
TABLE_NAMES = {
    "ds": "date",
    "store": "store",
    "item": "item",
    "y": "sales",
    "yhat": "sales_predicted",
    "yhat_upper": "sales_predicted_upper",
    "yhat_lower": "sales_predicted_lower",
    "training_date": "training_date",
}


def as_table_rows(forecast: DataFrame) -> DataFrame:
    """Stamped forecast rows under the names of the forecasts table."""
    return forecast.select(
        *[F.col(name).alias(stored) for name, stored in TABLE_NAMES.items()]
    ).to(FORECAST_TABLE)


def from_table_rows(table: DataFrame) -> DataFrame:
    """Rows of the forecasts table under the names of forecast columns."""
    return table.select(*[F.col(stored).alias(name) for name, stored in TABLE_NAMES.items()])


def single_precision(rows: DataFrame) -> DataFrame:
    """DOUBLE columns as FLOAT, for tables that are declared that way."""
    doubles = [f.name for f in rows.schema if isinstance(f.dataType, DoubleType)]
    return rows.withColumns({name: F.col(name).cast("float") for name in doubles})


def replace_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace the folders that the rows fall into, by default those of training dates."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *(partitions or (TRAINING_DATE,))
    ).parquet(path)


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a table was stored under the path, in any file system that Spark reads."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def store(rows: DataFrame, path: str, series: tuple[int, int] | None = None) -> None:
    """Store the stamped rows of one training run.

    A run over all series replaces its training date. One over a single ``series`` replaces
    that series only: the other rows of the date are read, settled and written with it.
    """
    spark = rows.sparkSession
    if series is not None and is_stored(spark, path):
        dates = rows.select(TRAINING_DATE).distinct()
        here = (F.col("store") == series[0]) & (F.col("item") == series[1])
        others = spark.read.parquet(path).where(~here).join(dates, TRAINING_DATE, "left_semi")
        typed = [F.col(field.name).cast(field.dataType) for field in rows.schema]
        with scratch(spark) as work:
            replace_partitions(settle(rows.unionByName(others.select(typed)), work), path)
    else:
        replace_partitions(rows, path)


def store_short(
    short: DataFrame, path: str, training_date: datetime.date, series: tuple[int, int] | None = None
) -> None:
    """Store the report of short series, also when it is empty now and was not before."""
    folder = f"{path}/{TRAINING_DATE}={training_date}"
    rows = short.to(SHORT_SERIES)
    if series is not None and is_stored(rows.sparkSession, folder):
        here = (F.col("store") == series[0]) & (F.col("item") == series[1])
        stored = rows.sparkSession.read.schema(SHORT_SERIES).parquet(folder)
        with scratch(rows.sparkSession) as work:
            every = settle(rows.unionByName(stored.where(~here)), work)
            every.write.mode("overwrite").parquet(folder)
    else:
        rows.write.mode("overwrite").parquet(folder)


def write_forecasts(
    forecast: DataFrame, path: str, as_float: bool = False, series: tuple[int, int] | None = None
) -> None:
    """Store stamped forecast rows; they need no shuffle as one run has one partition."""
    rows = as_table_rows(forecast)
    store(single_precision(rows) if as_float else rows, path, series)


def write_evaluations(
    evaluations: DataFrame,
    path: str,
    as_float: bool = False,
    series: tuple[int, int] | None = None,
) -> None:
    rows = evaluations.to(EVALUATION)
    store(single_precision(rows) if as_float else rows, path, series)


def save_parameters(
    parameters: DataFrame,
    training_date: datetime.date,
    path: str,
    series: tuple[int, int] | None = None,
) -> None:
    """Store a trained model: one row per series."""
    store(stamp(parameters, training_date), path, series)


def load_parameters(spark: SparkSession, path: str, training_date: datetime.date) -> DataFrame:
    """The model of one training date; other dates are not read."""
    return read_partition(spark, path, PARAMETERS, training_date).drop(TRAINING_DATE)


def read_partition(
    spark: SparkSession, path: str, schema: StructType, training_date: datetime.date
) -> DataFrame:
    """Rows of one training date, which is found by folder name and not by reading."""
    fields = [field for field in schema if field.name != TRAINING_DATE]
    stamped = StructType(fields + [StructField(TRAINING_DATE, DateType())])
    stored = spark.read.schema(stamped).parquet(path)
    return stored.where(F.col(TRAINING_DATE) == F.lit(training_date))


def create_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Make a stored folder known to the catalog under ``name``, unless it already is."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({TRAINING_DATE}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)
