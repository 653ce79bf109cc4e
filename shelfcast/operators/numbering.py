"""Surrogate ids for integer keys without sorting all keys in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A bucket is a run of 2^16 consecutive key values, so it holds at most 65,536 distinct
# keys, and the 2^32 values of an INT make at most 65,536 buckets.
BUCKET_BITS = 16


def with_ids(keys: DataFrame, key: str, stored: DataFrame | None = None) -> DataFrame:
    """``id, key`` for distinct INT keys, numbered in key order.

    Numbering goes on after the largest id of ``stored``, or starts at 1. A global
    ``row_number`` would order every key in a single task. Here keys are ordered within
    buckets of the key range, and only the bucket sizes are added up in one place. Both
    parts have the fixed bounds above, so the bucket table is safe to broadcast.
    """
    placed = keys.select(
        F.col(key).cast("int").alias(key),
        # Not nullable, so that both uses below share one scan and shuffle of the keys.
        F.coalesce(F.shiftright(F.col(key).cast("int"), BUCKET_BITS), F.lit(0)).alias("bucket"),
    )
    below = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("size"))
    starts = sizes.select(
        "bucket", F.coalesce(F.sum("size").over(below), F.lit(0)).alias("start")
    )
    taken = F.lit(0) if stored is None else F.coalesce(_largest_id(stored), F.lit(0))
    within = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return (
        placed.withColumn("within", within)
        .join(F.broadcast(starts), "bucket")
        .select((taken + F.col("start") + F.col("within")).cast("int").alias("id"), key)
    )


def _largest_id(stored: DataFrame):
    return stored.agg(F.max("id")).scalar()
