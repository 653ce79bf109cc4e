"""Daily history that grows by sales files: only months that gained sales are written again.

A ledger lists every file that the history holds, by path, length and time, with the months it
has sales of. An update reads new files alone, adds their daily sums to those of the stored
months they touch, and keeps all other months where they are. Sums cannot be taken back, so
that months of a file that was rewritten or has gone are summed again, from those files that
the ledger names for them.

Below the folder, ``runs/<run>`` has what one update wrote: ``days`` by month, the whole
``files`` ledger, and ``months`` with the run that holds each month. ``commits`` says which run
is read. An update that stops early changes nothing, and of two at once one fails.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.history import clean_history
from shelfcast.schemas import HISTORY, HISTORY_FILES, HISTORY_MONTHS, SERIES
from shelfcast.sources.commits import Commit, commit, last_commit, new_run
from shelfcast.sources.sales import read_sales_csv
from shelfcast.sources.settled import scratch, settle

FILE = ("file", "length", "modified")
Reader = Callable[[SparkSession, list[str]], DataFrame]


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, path, length, modified`` of the files that a path or pattern names now.

    ``file`` is the name that rows of a scan carry, ``path`` the one that a reader takes. The
    contents of the files are not read.
    """
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )


def grow_history(
    spark: SparkSession, path: str, folder: str, read: Reader = read_sales_csv
) -> DataFrame:
    """Bring the history under ``folder`` up to the sales files at ``path``, and return it.

    The result equals ``clean_history`` of all files that are there now, so rows that miss a
    field are left out. Files that the ledger knows with the same length and time are taken as
    unchanged. Without a new, rewritten or missing file nothing is written. ``read`` makes sales
    of a list of paths, by a scan whose rows have not been moved.

    The driver holds the names of the files that are read, as Spark's own listing does, and
    the names of months. A file without usable rows stands in the ledger without months.
    """
    before = last_commit(spark, f"{folder}/commits")
    with scratch(spark) as work:
        found = settle(listed_files(spark, path), work)
        known = _files_of(spark, folder, before)
        fresh = settle(found.join(known, list(FILE), "left_anti"), work)
        gone = known.join(found, list(FILE), "left_anti")
        stale = {row[0] for row in gone.select(F.explode("months")).distinct().collect()}
        if fresh.isEmpty() and gone.isEmpty():
            return grown_history(spark, folder)
        kept = known.join(found.select(*FILE, "path"), list(FILE))
        added = settle(_sums_by_file(spark, fresh, read), work)
        gained = {row[0] for row in added.select("month").distinct().collect()}
        parts = [added.drop("file")]
        if stale:
            holds = F.arrays_overlap("months", F.array(*map(F.lit, sorted(stale))))
            again = _sums_by_file(spark, kept.where(holds), read)
            parts.append(again.where(F.col("month").isin(sorted(stale))).drop("file"))
        places = _places(spark, folder, before)
        whole = {month: run for month, run in places.items() if month in gained - stale}
        if whole:
            parts.append(_days(spark, folder, whole).withColumn("month", month_of("ds")))
        run = new_run()
        _write_days(parts, f"{folder}/runs/{run}/days")
        months = added.groupBy("file").agg(F.array_sort(F.collect_set("month")).alias("months"))
        ledger = _with_months(fresh, months).unionByName(kept.select(HISTORY_FILES.names))
        ledger.write.parquet(f"{folder}/runs/{run}/files")
        written = _months_under(spark, f"{folder}/runs/{run}/days")
        untouched = [(month, at) for month, at in places.items() if month not in gained | stale]
        rows = untouched + [(month, run) for month in written]
        placed = spark.createDataFrame(rows, HISTORY_MONTHS)
        placed.coalesce(1).write.parquet(f"{folder}/runs/{run}/months")
        commit(spark, f"{folder}/commits", before, run)
    return grown_history(spark, folder)


def grown_history(spark: SparkSession, folder: str) -> DataFrame:
    """``store, item, ds, y`` as the last finished update left it; empty before the first."""
    holding = last_commit(spark, f"{folder}/commits")
    return _days(spark, folder, _places(spark, folder, holding))


def as_sales(history: DataFrame) -> DataFrame:
    """Daily sums as sales rows, for jobs that start from sales."""
    return history.select(F.col("ds").alias("date"), *SERIES, F.col("y").alias("sales"))


def history_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger: ``file, length, modified, months``."""
    return _files_of(spark, folder, last_commit(spark, f"{folder}/commits"))


def _files_of(spark: SparkSession, folder: str, at: Commit) -> DataFrame:
    if at.run is None:
        return spark.createDataFrame([], HISTORY_FILES)
    return spark.read.schema(HISTORY_FILES).parquet(f"{folder}/runs/{at.run}/files")


def _places(spark: SparkSession, folder: str, at: Commit) -> dict[str, str]:
    """The run that holds each month; there are as many as the calendar has."""
    if at.run is None:
        return {}
    rows = spark.read.schema(HISTORY_MONTHS).parquet(f"{folder}/runs/{at.run}/months")
    return {row["month"]: row["run"] for row in rows.collect()}


def _days(spark: SparkSession, folder: str, places: dict[str, str]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], HISTORY)
    paths = [f"{folder}/runs/{run}/days/month={month}" for month, run in sorted(places.items())]
    return spark.read.schema(HISTORY).parquet(*paths)


def _plain(path: str) -> str:
    """A path that is read as it is spelled, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _sums_by_file(spark: SparkSession, files: DataFrame, read: Reader) -> DataFrame:
    """``file, store, item, ds, y, month``: daily sums of each file, summed where it is read."""
    paths = [_plain(row["path"]) for row in files.select("path").collect()]
    if not paths:
        none = spark.createDataFrame([], HISTORY)
        return none.withColumn("file", F.lit("")).withColumn("month", month_of("ds"))
    sales = read(spark, paths)
    # The name of its file stands beside a store for the sum, so that a day is summed by file.
    place = F.struct("_metadata.file_path", "store")
    days = clean_history(sales.withColumn("store", F.when(F.col("store").isNotNull(), place)))
    return days.select(
        F.col("store.file_path").alias("file"),
        F.col("store.store").alias("store"),
        "item",
        "ds",
        "y",
        month_of("ds").alias("month"),
    )


def _write_days(parts: Iterable[DataFrame], path: str) -> None:
    """Sums of the parts by month; large months are split at run time, small ones are one file."""
    rows = None
    for part in parts:
        rows = part if rows is None else rows.unionByName(part)
    days = rows.groupBy(*SERIES, "ds", "month").agg(F.sum("y").alias("y"))
    laid = days.hint("rebalance", "month").sortWithinPartitions("month", *SERIES, "ds")
    laid.select(*HISTORY.names, "month").write.partitionBy("month").parquet(path)


def _with_months(files: DataFrame, months: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    joined = files.join(months, "file", "left")
    return joined.withColumn("months", F.coalesce("months", empty)).select(HISTORY_FILES.names)


def _months_under(spark: SparkSession, path: str) -> list[str]:
    """The months that a run wrote, by the names of their folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = [status.getPath().getName() for status in found]
    return sorted(name.removeprefix("month=") for name in names if name.startswith("month="))
