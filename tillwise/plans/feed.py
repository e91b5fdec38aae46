"""A cleaned feed that grows by deliveries: what is stored is never cleaned or shuffled again.

A delivery is cleaned by itself. Its lines that may be stored already are found by the filters
of their months; those, usually few, are compared with the stored lines of their months, and
the rest is appended. The result is the same as cleaning all deliveries together.

The store is a folder of versions (``sources.snapshots``): lines by month and their filters
are committed together. A delivery that comes again, whole or in part, adds nothing twice, so a
writer that does not know whether its last attempt went through simply repeats it.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.operators.cleaning import MONTH_FIRST, Patterns, typed_survivors, with_dates
from tillwise.operators.membership import build_filter, maybe_known
from tillwise.sources.files import RAW_TYPES
from tillwise.sources.snapshots import Conflict, Snapshot, commit, current, write_part
from tillwise.sources.staging import stage

LINES, FILTERS = "lines", "filters"
MONTH = "year_month"
# As many lines in question are sent to the stored lines; beyond it both sides are shuffled.
BROADCAST_LINES = 200_000

# The columns two lines have to share to be the same: those of the feed, with the date as text.
_KEY = tuple("date_text" if name == "InvoiceDate" else name for name in RAW_TYPES)


def _fresh(raw: DataFrame, patterns: Patterns) -> DataFrame:
    """The delivery cleaned by itself, with what the store keeps besides: the text of the date,
    the month and a hash of the line."""
    kept = typed_survivors(raw).withColumn("date_text", F.col("InvoiceDate"))
    lines = with_dates(kept, patterns)
    return lines.withColumn(MONTH, F.date_format("InvoiceDate", "yyyy-MM")).withColumn("row_hash", F.xxhash64(*_KEY))


def _known(spark: SparkSession, fresh: DataFrame, base: Snapshot, broadcast_lines: int) -> DataFrame:
    """The ``row`` numbers of lines that are stored, exactly."""
    months = [r[0] for r in fresh.select(MONTH).distinct().collect()]  # bounded by the calendar
    filters = base.read(spark, FILTERS).where(F.col(MONTH).isin(months))
    asked = stage(fresh.join(maybe_known(fresh, filters, MONTH, "row_hash", "row"), "row", "left_semi"), "asked")
    n = asked.count()
    months = [r[0] for r in asked.select(MONTH).distinct().collect()]
    stored = base.read(spark, LINES).where(F.col(MONTH).isin(months)).select(MONTH, "row_hash", *_KEY).alias("stored")
    asked = asked.select("row", MONTH, "row_hash", *_KEY).alias("asked")
    same = [F.col(f"stored.{c}").eqNullSafe(F.col(f"asked.{c}")) for c in (MONTH, "row_hash", *_KEY)]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    side = F.broadcast(asked) if n <= broadcast_lines else asked
    return stored.join(side, condition).select("row").distinct()


def append_feed(
    spark: SparkSession, raw: DataFrame, folder: str, patterns: Patterns = MONTH_FIRST, broadcast_lines: int = BROADCAST_LINES
) -> Snapshot:
    """Clean a delivery and append the lines that are not stored yet.

    All deliveries of a store must be read with the same date patterns. When another delivery is
    committed in between, the lines are compared again with what is stored then.
    """
    wanted = [str(p) for p in ((patterns,) if isinstance(patterns, str) else patterns)]
    fresh = stage(_fresh(raw, patterns).withColumn("row", F.monotonically_increasing_id()), "fresh")
    while True:
        base = current(spark, folder)
        before = base.notes.get(LINES, {}).get("patterns", wanted)
        if before != wanted:
            raise ValueError("the stored deliveries were read with other date patterns")
        new = fresh
        if LINES in base.tables:
            known = stage(_known(spark, fresh, base, broadcast_lines), "known")
            new = fresh.join(known, "row", "left_anti")
        lines = write_part(new.drop("row"), folder, LINES, (MONTH,))
        filters = write_part(build_filter(new, MONTH, "row_hash", uuid4().hex), folder, FILTERS, (MONTH,))
        try:
            return commit(spark, base, appended={LINES: lines, FILTERS: filters}, notes={LINES: {"patterns": wanted}})
        except Conflict:
            continue


def read_feed(spark: SparkSession, folder: str) -> DataFrame:
    """All cleaned lines, as ``clean`` would give them for all deliveries together."""
    return current(spark, folder).read(spark, LINES).select(*RAW_TYPES, "Revenue")


def merge_filters(spark: SparkSession, folder: str) -> Snapshot:
    """One filter per month in place of one per month and delivery, from the stored hashes.

    For stores with many deliveries a month, as lines are looked up in each of their filters.
    """
    while True:
        base = current(spark, folder)
        merged = build_filter(base.read(spark, LINES), MONTH, "row_hash", uuid4().hex)
        part = write_part(merged, folder, FILTERS, (MONTH,))
        try:
            return commit(spark, base, replaced={FILTERS: part})
        except Conflict:
            continue
