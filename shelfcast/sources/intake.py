"""Sales files taken in once: readable rows as a table, the others beside it with a reason.

A CSV scan turns a field that it cannot parse into NULL, and later steps leave out rows with
NULL. Here the scan keeps the line of such a row, and counts rows by reason while it writes
them, so that a wrong date format does not lose a file in silence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from shelfcast.schemas import INTAKE_COUNTS, REFUSED_LINES, SALES

SEPARATOR = ","
FIELDS = "wrong number of fields"
OTHER = "unreadable"
TAKEN = "taken"
LINE, REASON, REFUSED = "line", "reason", "refused"


def _reasons() -> list[str]:
    faults = [f"{name} is {fault}" for fault in ("unreadable", "missing") for name in SALES.names]
    return [FIELDS, *faults, OTHER]


def _reason() -> Column:
    """The first fault of a row, NULL without one. Only a row that is not read has a line."""
    parts = F.split(LINE, SEPARATOR, -1)
    empty = [F.col(name).isNull() for name in SALES.names]
    said = [F.coalesce(F.trim(F.get(parts, F.lit(at))), F.lit("")) for at in range(len(SALES))]
    unread = F.when(F.size(parts) != len(SALES), F.lit(FIELDS))
    missing = F.lit(None).cast("string")
    for name, null, text in reversed(list(zip(SALES.names, empty, said))):
        missing = F.when(null, F.lit(f"{name} is missing")).otherwise(missing)
    for name, null, text in zip(SALES.names, empty, said):
        unread = unread.when(null & (text != ""), F.lit(f"{name} is unreadable"))
    return F.when(F.col(LINE).isNull(), missing).otherwise(unread.otherwise(F.lit(OTHER)))


def judged_sales_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``date, store, item, sales, line, reason`` of every line of CSV files.

    ``reason`` names the first fault of a row: another number of fields, a field that cannot be
    read, or one that is missing; it is NULL for a row without fault. ``line`` is the text of a
    row with a fault. Empty lines are no rows.
    """
    schema = StructType([*SALES, StructField(LINE, StringType())])
    rows = spark.read.csv(
        path, schema=schema, header=header, sep=SEPARATOR, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE
    )
    shown = F.concat_ws(
        SEPARATOR, *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in SALES.names]
    )
    reasoned = rows.withColumn(REASON, _reason())
    return reasoned.withColumn(LINE, F.when(F.col(REASON).isNotNull(), F.coalesce(LINE, shown)))


@dataclass
class Intake:
    """Rows that were taken in, lines that were refused, and the number of each.

    ``lines`` has all of them, with NULL for what is missing or cannot be read.
    """

    lines: DataFrame
    sales: DataFrame
    refused: DataFrame
    counts: DataFrame


def take_in(spark: SparkSession, path: str, folder: str, header: bool = True) -> Intake:
    """Read CSV files once and store their rows under ``folder``, with a report.

    The scan writes readable rows and refused ones to folders of their own, and counts them by
    reason on its way. What an earlier intake stored there is replaced.
    """
    judged = judged_sales_csv(spark, path, header).withColumn(REFUSED, F.col(REASON).isNotNull())
    reasons = _reasons()
    seen = Observation()
    found = [F.count_if(F.col(REASON) == reason).alias(f"n{at}") for at, reason in enumerate(reasons)]
    taken = F.count_if(~F.col(REFUSED)).alias(TAKEN)
    judged.observe(seen, taken, *found).write.mode("overwrite").partitionBy(REFUSED).parquet(
        f"{folder}/lines"
    )
    totals = [(TAKEN, seen.get[TAKEN])]
    totals += [(reason, seen.get[f"n{at}"]) for at, reason in enumerate(reasons)]
    counts = spark.createDataFrame([row for row in totals if row[1]], INTAKE_COUNTS)
    counts.coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts")
    return read_intake(spark, folder)


def read_intake(spark: SparkSession, folder: str) -> Intake:
    """What was taken in under ``folder``; refused lines are not read for the sales."""
    schema = StructType([*REFUSED_LINES, StructField(REFUSED, BooleanType())])
    lines = spark.read.schema(schema).parquet(f"{folder}/lines")
    return Intake(
        lines.select(*SALES.names),
        lines.where(f"NOT {REFUSED}").select(*SALES.names),
        lines.where(REFUSED).drop(REFUSED),
        spark.read.schema(INTAKE_COUNTS).parquet(f"{folder}/counts"),
    )
