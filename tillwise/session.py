"""Session settings: a local session for tests and the benchmark, sizes for a cluster."""

from pyspark.sql import SparkSession

MIB = 1 << 20


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillwise")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """SQL settings for a feed of the given size.

    Shuffles start with one partition per 256 MiB of input, and adaptive execution merges small ones up to 256 MiB; scans and written files follow the same
    size. ``spark.checkpoint.dir`` has to name a folder all executors share.
    """
    partitions = max(input_bytes // (256 * MIB), 200)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(partitions),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for name, value in settings.items():
        spark.conf.set(name, value)
