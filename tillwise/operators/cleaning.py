"""Cleaning rules for the raw feed, and a count of what each rule drops."""

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.calendar import parse_wall_time
from tillwise.functions.dates import Order, read_date
from tillwise.functions.numeric import ratio
from tillwise.sources.files import CORRUPT, RAW_TYPES, normalise_headers

# Reads '12/1/2010 8:26' as well as '12/01/2010 08:26', and nothing else.
DEFAULT_PATTERN = "M/d/yyyy H:m"

MONTH_FIRST, DAY_FIRST = Order.MONTH_FIRST, Order.DAY_FIRST

# How dates are written: any form, with an order of day and month, or patterns tried in turn.
Patterns = Order | str | tuple[str, ...]


def parse_date(text: Column, patterns: Patterns = MONTH_FIRST) -> Column:
    """The wall time of a date text; NULL if it cannot be read."""
    if isinstance(patterns, Order):
        return read_date(text, patterns)
    patterns = (patterns,) if isinstance(patterns, str) else patterns
    return F.coalesce(*[parse_wall_time(text, pattern) for pattern in patterns])


def _typed(raw: DataFrame, *more: Column) -> DataFrame:
    """Raw columns in their final types. A missing invoice number is the text 'nan'
    and therefore not a cancellation; a customer number loses its fraction."""
    return normalise_headers(raw).select(
        F.coalesce(F.col("InvoiceNo").cast("string"), F.lit("nan")).alias("InvoiceNo"),
        F.col("StockCode").cast("string").alias("StockCode"),
        "Description",
        F.col("Quantity").cast("int").alias("Quantity"),
        F.col("InvoiceDate").cast("string").alias("InvoiceDate"),
        F.col("UnitPrice").cast("double").alias("UnitPrice"),
        F.when(~F.isnan("CustomerID"), F.col("CustomerID").try_cast("bigint")).alias("CustomerID"),
        "Country",
        *more,
    )


def _cancelled() -> Column:
    return F.col("InvoiceNo").startswith("C")


def _has_customer() -> Column:
    return F.col("CustomerID").isNotNull()


def _positive() -> Column:
    # NaN sorts above every number in Spark, infinity included; neither is a price.
    price = F.col("UnitPrice")
    return F.coalesce((F.col("Quantity") > 0) & (price > 0) & (price < float("inf")), F.lit(False))


def typed_survivors(raw: DataFrame) -> DataFrame:
    """Lines that no rule but the one for dates drops, each once, with the date as text.

    The filters stand below the only shuffle, the one for the duplicates, whose map side
    already folds copies together.
    """
    return _typed(raw).where(~_cancelled() & _has_customer() & _positive()).dropDuplicates()


def with_dates(survivors: DataFrame, patterns: Patterns = MONTH_FIRST) -> DataFrame:
    """The lines whose date can be read, with the date and the revenue.

    A filter on the date would be pushed below the projection, and every date read twice; what
    comes out of a list of one date is read once.
    """
    read = F.explode(F.array(parse_date(F.col("InvoiceDate"), patterns))).alias("InvoiceDate")
    dated = survivors.select(*(read if name == "InvoiceDate" else name for name in survivors.columns))
    dated = dated.where(F.col("InvoiceDate").isNotNull())
    return dated.withColumn("Revenue", F.col("Quantity") * F.col("UnitPrice"))


def clean(raw: DataFrame, patterns: Patterns = MONTH_FIRST) -> DataFrame:
    """Order lines fit for reporting. Duplicates are dropped on the raw date text, before it is
    parsed."""
    return with_dates(typed_survivors(raw), patterns)


def clean_report(raw: DataFrame, patterns: Patterns = MONTH_FIRST) -> DataFrame:
    """One row: rows before and after cleaning and the rows each rule drops; for a feed
    read from files also ``corrupt``, the records with an unreadable cell, of any rule.

    Rows dropped by the first three rules are blanked, so each of those groups folds
    into one row per task before the shuffle.
    """
    failed = (
        F.when(_cancelled(), "cancelled").when(~_has_customer(), "no_customer").when(~_positive(), "not_positive")
    )
    unread = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    tagged = _typed(raw, unread.cast("bigint").alias("unread")).withColumn("failed", failed)
    blanked = [F.when(F.col("failed").isNull(), F.col(name)).alias(name) for name in RAW_TYPES]
    copies = tagged.select("failed", "unread", *blanked).groupBy("failed", *RAW_TYPES)
    copies = copies.agg(F.count(F.lit(1)).alias("n"), F.sum("unread").alias("unread"))

    survived = F.col("failed").isNull()
    readable = parse_date(F.col("InvoiceDate"), patterns).isNotNull()

    def rows(condition: Column, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, count)), F.lit(0)).cast("bigint")

    counts = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        rows(F.col("failed") == "cancelled", F.col("n")).alias("cancelled"),
        rows(F.col("failed") == "no_customer", F.col("n")).alias("no_customer"),
        rows(F.col("failed") == "not_positive", F.col("n")).alias("not_positive"),
        rows(survived, F.col("n") - 1).alias("duplicates"),
        rows(survived & ~readable, F.lit(1)).alias("bad_date"),
        rows(survived & readable, F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum("unread"), F.lit(0)).cast("bigint").alias("corrupt"),
    )
    dropped = F.col("rows_before") - F.col("rows_after")
    counts = counts.withColumn("dropped", dropped).withColumn(
        "dropped_rate", ratio(dropped, F.col("rows_before"))
    )
    return counts if CORRUPT in raw.columns else counts.drop("corrupt")
