"""Reading the raw feed and result files, writing tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.sources.records import records

ENCODING = "ISO-8859-1"

# Columns of the feed.
RAW_TYPES = {
    "InvoiceNo": "STRING",
    "StockCode": "STRING",
    "Description": "STRING",
    "Quantity": "INT",
    "InvoiceDate": "STRING",
    "UnitPrice": "DOUBLE",
    "CustomerID": "DOUBLE",
    "Country": "STRING",
}

# Columns of the result files.
SEGMENT_SCHEMA = (
    "customer_id BIGINT, recency_days INT, frequency BIGINT, monetary DOUBLE, "
    "cluster INT, segment STRING"
)

FORECAST_SCHEMA = "ds DATE, forecast DOUBLE, lower DOUBLE, upper DOUBLE, actual DOUBLE"

# Spellings of three headers in another release of the same feed.
HEADER_ALIASES = {"Invoice": "InvoiceNo", "Customer ID": "CustomerID", "Price": "UnitPrice"}


# Cell texts that pandas reads as missing by default.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input with fewer pieces than the session has cores, such as a single
    file that cannot be split, dealt out in pieces of a sensible size. Larger inputs are
    left as they are."""
    if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.hint("rebalance")


def normalise_headers(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(HEADER_ALIASES)


# Holds the text of a record with a cell that does not parse, or with too many or few cells.
CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The raw feed, latin-1 with a header in either spelling and any column order.

    Only the header line is read ahead; types are declared, never inferred. A cell
    that does not parse becomes NULL and is dealt with by the cleaning rules; its record
    is kept in ``_corrupt_record``, which the cleaning report counts. Files of a folder
    must agree in their header; one that differs is an error. ``multi_line`` allows line
    breaks inside quotes; it reads the text twice, see ``sources.records``.
    """
    reader = spark.read.option("header", True).option("encoding", ENCODING).option("escape", '"')
    names = reader.csv(path).columns
    fields = [f"`{name}` {RAW_TYPES.get(HEADER_ALIASES.get(name, name), 'STRING')}" for name in names]
    schema = ", ".join([*fields, f"{CORRUPT} STRING"])
    if multi_line:
        feed = _parsed_records(records(spark, path, ENCODING), names, schema)
    else:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
        feed = reader.schema(schema).option("mode", "PERMISSIVE").csv(path)
    texts = {
        name: F.when(~F.col(name).isin(*MISSING), F.col(name)) for name, kind in RAW_TYPES.items() if kind == "STRING"
    }
    return normalise_headers(feed).select(*RAW_TYPES, CORRUPT).withColumns(texts)


def _parsed_records(found: DataFrame, names: list[str], schema: str) -> DataFrame:
    """The cells of CSV records; the first record of each file has to be the header."""
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    header = F.from_csv("record", ", ".join(f"`{i}` STRING" for i in range(len(names))), {"escape": '"'})
    same = F.array(*(header[str(i)] for i in range(len(names)))) == F.array(*map(F.lit, names))
    other = F.raise_error(F.concat(F.lit("the header of "), F.col("file"), F.lit(" differs"))).cast("boolean")
    rows = found.where(F.when(~F.col("first"), True).otherwise(F.when(same, False).otherwise(other)))
    return rows.select(F.from_csv("record", schema, options).alias("cells")).select("cells.*")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).option("header", True).csv(path)


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FORECAST_SCHEMA).option("header", True).csv(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table was written at the path."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
