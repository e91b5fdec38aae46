"""Written intermediates in the folder all executors share.

A staged table is a Parquet table: it cuts the lineage, so a lost executor costs
at most a re-read, it keeps column pruning, and its rows can no longer change.
"""

import atexit
from contextlib import suppress
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillwise.sources.shared import SharedFolder

_to_remove: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; local sessions may do without one and use a
    folder of their warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse')}/_staged"


def _remove(spark: SparkSession, folder: str) -> None:
    with suppress(Exception):  # the session may have ended before
        SharedFolder(spark, folder).delete("")


def new_path(spark: SparkSession, label: str) -> str:
    """An unused place in the shared folder. What an application puts there is removed when its
    driver ends; a driver that is killed leaves a folder named after the application."""
    folder = f"{shared_folder(spark)}/tillwise/{spark.sparkContext.applicationId}"
    if folder not in _to_remove:
        _to_remove.add(folder)
        atexit.register(_remove, spark, folder)
    return f"{folder}/{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
