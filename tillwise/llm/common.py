"""What the operators of this package share."""

import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwise.sources.staging import new_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# ASCII white space: what separates words everywhere in this package.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

# Bytes of text a Python worker handles at once, beyond one long text.
SLICE_BYTES = 4 << 20


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster it is installed on the executors, or handed out by ``addPyFile``; then this
    place need not exist there.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, *paths]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, empty instead of null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def count_words(column: str | Column) -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("bigint")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


class Scratch:
    """Intermediate tables of one run, in the folder all executors share.

    A saved table cuts the lineage: a lost executor costs a re-read. ``drop`` removes
    tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        reach_package(spark)
        self.spark = spark
        self.folder = new_path(spark, label)

    def save(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of frames nothing refers to.

        It acts when the driver collects garbage, which small drivers seldom need to;
        until then the files of every finished step would stay on the executors' disks.
        """
        gc.collect()
        try:
            self.spark.sparkContext._jvm.System.gc()
        except Py4JError:  # not allowed here: the files go at the next collection
            return


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of text, or one row."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the texts, the code of every word in order, words per text."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not real.all():
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(owner[real], minlength=len(sizes))
        words = words.filter(pa.array(real))
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), sizes.astype(np.int64)


def group_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the given sizes; empty groups give 0."""
    ends = np.cumsum(sizes)
    running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return running[ends] - running[ends - sizes]


def row_key(docs: DataFrame, id_column: str) -> Column:
    """What tells rows apart: the id, rows without one last, and a hash of all columns."""
    return F.struct(F.col(id_column).isNull(), F.col(id_column), F.xxhash64(*docs.columns))


def rows_of(keyed: DataFrame, key: str, decided: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``keyed`` as often as ``decided`` says, without the key.

    ``decided`` has the key and ``copies``, perhaps several times for rows that are equal
    in every column; their copies are added up and one of the rows is repeated.
    """
    given, n, copies = f"{key}_given", f"{key}_n", f"{key}_copies"
    totals = decided.groupBy(F.col(key).alias(given)).agg(
        F.count(F.lit(1)).alias(n), F.sum("copies").cast("int").alias(copies)
    )
    totals = scratch.save(totals.where(F.col(copies) > 0), "decided")
    columns = [c for c in keyed.columns if c != key]
    joined = keyed.join(totals, F.col(key).eqNullSafe(F.col(given)))
    one = joined.where(F.col(n) == 1).select(*columns, copies)
    if not totals.where(F.col(n) > 1).isEmpty():
        row = F.any_value(F.struct(*columns, copies)).alias("row")
        one = one.unionByName(joined.where(F.col(n) > 1).groupBy(key).agg(row).select("row.*"))
    repeated = F.explode(F.sequence(F.lit(1), F.col(copies))).alias(f"{copies}_")
    return one.select(*columns, repeated).select(*columns)
