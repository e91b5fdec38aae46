"""Append-only tables with running numbers, safe for several writers and for repeated batches.

A batch reserves the numbers of its rows by creating a file that is named after the first of
them; of two writers that want the same numbers one gets them and the other takes the next.
The rows are then written where nobody reads, and appear under the name of their batch in
one rename. A batch whose name is already there is not added again, so a writer that does
not know whether its last attempt went through simply repeats it.

A writer that dies in between leaves a gap in the numbers and files that nobody reads.
"""

import hashlib
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.operators.ranking import with_position
from tillwise.sources.shared import SharedFolder
from tillwise.sources.staging import stage

_RANGES = "_ranges"


def create_log(empty: DataFrame, path: str) -> None:
    """An empty table in place of whatever is at the path, numbered from 1."""
    SharedFolder(empty.sparkSession, path).delete("")
    empty.write.parquet(f"{path}/batch=none")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(path).drop("batch")


def _first_number(name: str) -> int:
    return int(name.removesuffix(".txt"))


def reserve(spark: SparkSession, path: str, rows: int) -> int:
    """The first of so many numbers in a row that no other writer gets."""
    files = SharedFolder(spark, path)
    while True:
        claimed = [name for name in files.names(_RANGES) if name.endswith(".txt")]
        first = 1
        if claimed:
            first = _first_number(claimed[-1]) + int(files.read(f"{_RANGES}/{claimed[-1]}"))
        if files.claim(f"{_RANGES}/{first:020d}.txt", str(rows)):
            return first


def append_numbered(
    rows: DataFrame, path: str, order: Sequence[str], number: str = "id", batch: str | None = None
) -> bool:
    """Append rows to the table, numbered in ``order`` from the first free number on.

    ``batch`` names what is appended; without a name it is taken for new. Returns False, and
    appends nothing, if the batch is already there. No rows reserve no numbers.
    """
    spark = rows.sparkSession
    files = SharedFolder(spark, path)
    name = f"batch={hashlib.sha256((batch or uuid4().hex).encode()).hexdigest()[:32]}"
    if files.exists(name):
        return False
    placed = stage(with_position(rows, list(order), "_position"), "numbered")
    first = reserve(spark, path, n) if (n := placed.count()) else 1
    written = f"_writing/{uuid4().hex}"
    numbered = placed.select((F.col("_position") + F.lit(first)).cast("bigint").alias(number), *rows.columns)
    numbered.write.parquet(f"{path}/{written}")
    if files.move(written, name):
        return True
    files.delete(written)
    return False
