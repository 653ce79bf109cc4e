"""Loads of the star schema that can be repeated without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from shelfcast.operators.star import (
    MODES,
    distinct_facts,
    fact_orphans,
    identified,
    merged_facts,
    new_dates,
    new_facts,
    new_items,
    new_stores,
    refused,
    repeated_keys,
    repeats,
)
from shelfcast.schemas import (
    DIM_DATE,
    DIM_ITEM,
    DIM_STORE,
    FACT_KEY,
    FACT_SALES,
    FORECAST,
    REJECTED_FACTS,
    REPEATED_FACTS,
)
from shelfcast.sources.claims import claimed
from shelfcast.sources.settled import scratch, settle
from shelfcast.sources.tables import replace_partitions

TABLES = {
    "dim_store": DIM_STORE,
    "dim_item": DIM_ITEM,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
}
# What loads left out, in a folder for each load.
REPORTS = {"rejected_facts": REJECTED_FACTS, "repeated_facts": REPEATED_FACTS}
LOAD = "load"
# Facts are stored by calendar year and a bucket of stores: a load covers years of history,
# and one of few stores rewrites few buckets.
FACT_PARTITIONS = ("year", "store_bucket")
STORE_BUCKETS = 8


def reset_star(spark: SparkSession, folder: str) -> None:
    """Store the four tables empty, dropping what they held."""
    with claimed(spark, folder, "reset"):
        for name, schema in TABLES.items():
            empty = spark.createDataFrame([], schema)
            if name == "fact_sales":
                writer = _placed(empty).write.partitionBy(*FACT_PARTITIONS)
            else:
                writer = empty.write
            writer.mode("overwrite").parquet(f"{folder}/{name}")
        for name, schema in REPORTS.items():
            named = StructType([*schema, StructField(LOAD, StringType())])
            empty = spark.createDataFrame([], named)
            empty.write.mode("overwrite").partitionBy(LOAD).parquet(f"{folder}/{name}")


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored tables as of now."""
    star = {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}")
        for name, schema in TABLES.items()
    }
    return {**star, "fact_sales": _stored_facts(spark, folder).drop(*FACT_PARTITIONS)}


def read_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What the loads left out, with the name of the ``load``."""
    named = {
        name: StructType([*schema, StructField(LOAD, StringType())])
        for name, schema in REPORTS.items()
    }
    return {name: spark.read.schema(s).parquet(f"{folder}/{name}") for name, s in named.items()}


def load_star(
    rows: DataFrame,
    folder: str,
    mode: str = "append",
    load: str = "batch",
    order: tuple[str, ...] = (),
    add_members: bool = True,
) -> None:
    """Load forecast rows into the stored star schema.

    Dimensions gain the members they miss and never change an id; without ``add_members``
    they stay as they are. Facts follow ``mode``, see ``merged_facts``. Of the rows of one key,
    ``append`` takes the first and ``replace`` the last by the columns ``order``, as if the rows
    came one after the other; rows that tie there go by their measures. Rows with a missing or
    unknown key go to ``rejected_facts`` with the reason, keys that came again to
    ``repeated_facts``; both keep the report of the ``load`` of that name until it is repeated.
    ``rows`` should be a stored forecast: it is read once for the members, which only takes its
    three key columns, and once for the facts.

    One load at a time writes a star, as ids follow from the members that are stored: a second
    one fails with ``Claimed`` before it writes anything.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = rows.sparkSession
    path = f"{folder}/fact_sales"
    wanted = list(dict.fromkeys([*FORECAST.names, *order]))
    with claimed(spark, folder, f"load {load}"), scratch(spark) as work:
        if add_members:
            star, members = read_star(spark, folder), settle(_members(rows), work)
            _append(new_stores(star["dim_store"], members), f"{folder}/dim_store")
            _append(new_items(star["dim_item"], members), f"{folder}/dim_item")
            _append(new_dates(star["dim_date"], members), f"{folder}/dim_date")
        star = read_star(spark, folder)
        known = [star[name] for name in ("dim_store", "dim_item", "dim_date")]
        found = settle(identified(rows.select(*wanted), *known), work)
        kept = settle(distinct_facts(found, order, last=mode == "replace"), work)
        batch = kept.drop("rows").to(FACT_SALES)
        stored = _facts_beside(batch, folder)
        if mode == "append":
            added = _laid_out(new_facts(stored, batch))
            added.write.mode("append").partitionBy(*FACT_PARTITIONS).parquet(path)
        else:
            # Written beside the old files and swapped in when all tasks are done.
            merged = _laid_out(merged_facts(stored, batch, mode))
            replace_partitions(merged, path, *FACT_PARTITIONS)
        for name, report in (("rejected_facts", refused(found)), ("repeated_facts", repeats(kept))):
            report.write.mode("overwrite").parquet(f"{folder}/{name}/{LOAD}={load}")


def check_star(spark: SparkSession, folder: str) -> dict[str, int]:
    """Faults of the stored tables by name; all are 0 in a sound star schema."""
    star = read_star(spark, folder)
    keys = {
        "dim_store": ("id",),
        "dim_item": ("id",),
        "dim_date": ("date",),
        "fact_sales": FACT_KEY,
    }
    faults = {
        f"repeated keys of {name}": repeated_keys(star[name], *key).count()
        for name, key in keys.items()
    }
    members = {"store": star["dim_store"], "item": star["dim_item"]}
    for key, dimension in members.items():
        faults[f"repeated members of dim_{key}"] = repeated_keys(dimension, key).count()
    orphans = fact_orphans(
        star["fact_sales"], star["dim_store"], star["dim_item"], star["dim_date"]
    )
    return {**faults, "orphans of fact_sales": orphans.count()}


def _members(rows: DataFrame) -> DataFrame:
    """The different stores, items and days of the rows, each in a row of its own."""
    keys = {"store": F.col("store"), "item": F.col("item"), "ds": F.unix_date("ds")}
    each = [
        F.struct(F.lit(kind).alias("kind"), key.cast("int").alias("key"))
        for kind, key in keys.items()
    ]
    distinct = rows.select(F.explode(F.array(*each)).alias("member")).distinct()
    of_kind = {kind: F.when(F.col("member.kind") == kind, F.col("member.key")) for kind in keys}
    days = F.date_from_unix_date(of_kind["ds"])
    return distinct.select(
        of_kind["store"].alias("store"), of_kind["item"].alias("item"), days.alias("ds")
    )


def _append(members: DataFrame, path: str) -> None:
    members.write.mode("append").parquet(path)


def _stored_facts(spark: SparkSession, folder: str) -> DataFrame:
    folders = [StructField(name, IntegerType()) for name in FACT_PARTITIONS]
    return spark.read.schema(StructType([*FACT_SALES, *folders])).parquet(f"{folder}/fact_sales")


def _facts_beside(batch: DataFrame, folder: str) -> DataFrame:
    """Stored facts in the folders that the batch falls into; others are not listed or read.

    The driver gets one row for each year of the batch.
    """
    touched = (
        _placed(batch).groupBy("year").agg(F.collect_set("store_bucket").alias("buckets")).collect()
    )
    inside = F.lit(False)
    for row in touched:
        inside |= (F.col("year") == row["year"]) & F.col("store_bucket").isin(row["buckets"])
    return _stored_facts(batch.sparkSession, folder).where(inside).drop(*FACT_PARTITIONS)


def _placed(facts: DataFrame) -> DataFrame:
    bucket = F.pmod("store_id", F.lit(STORE_BUCKETS)).cast("int")
    return facts.withColumn("year", F.year("date_id")).withColumn("store_bucket", bucket)


def _laid_out(facts: DataFrame) -> DataFrame:
    """Facts with their folder, in date order within each file.

    Large folders are split and small ones merged at run time, and the date order lets a
    reader skip the parts of a file outside its dates.
    """
    placed = _placed(facts).hint("rebalance", *FACT_PARTITIONS)
    return placed.sortWithinPartitions(*FACT_PARTITIONS, "date_id")
