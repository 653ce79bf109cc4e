"""One writer at a time for a folder whose tables depend on each other.

A claim is a file that can be made only once. It says who holds it and since when, and goes
when the work ends, also by a fault. One that a lost driver left behind is reported to the next
writer and taken away by hand, as nothing here can tell a lost driver from a slow one.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from shelfcast.sources.commits import put_new, read_text, remove

NAME = "_claim"


class Claimed(RuntimeError):
    """Another writer holds the folder."""


@contextmanager
def claimed(spark: SparkSession, folder: str, owner: str) -> Iterator[None]:
    """Hold the folder while the block runs; raises ``Claimed`` at once if it is held."""
    since = datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")
    mine = f"{owner}, {spark.sparkContext.applicationId}, since {since}, {uuid.uuid4().hex}"
    if not put_new(spark, folder, NAME, mine):
        raise Claimed(f"{folder} is held by {holder(spark, folder)}")
    try:
        yield
    finally:
        # Someone may have taken the claim away and another writer may hold the folder now.
        if holder(spark, folder) == mine:
            release(spark, folder)


def holder(spark: SparkSession, folder: str) -> str | None:
    """Who holds the folder, or None."""
    return read_text(spark, f"{folder}/{NAME}")


def release(spark: SparkSession, folder: str) -> None:
    """Take the claim away; only right if its holder does not write any more."""
    remove(spark, f"{folder}/{NAME}")
