"""Intermediate results kept as tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by the session, else one below its warehouse, which executors share."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_settled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the settled tables of one job, deleted when the job ends."""
    folder = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """The same rows, computed once and read back from a stored table.

    For results with several readers. Lineage ends here, so losing an executor costs a
    read and no recomputation, and Spark knows the stored size when it plans a join.
    Without a ``scratch`` folder the table stays until the checkpoint folder is cleared, as
    results that are still to be read may need it.
    """
    spark = rows.sparkSession
    path = f"{folder or checkpoint_folder(spark)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
