"""Joining many rows with a lookup table that has one row per key."""

from pyspark.sql import DataFrame, functions as F

# A lookup within both bounds is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_TEXT_BYTES = 32 << 20


def _text_bytes(lookup: DataFrame) -> int:
    """Bytes in the text columns, the only ones whose width is not fixed."""
    widths = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in lookup.dtypes if kind == "string"]
    if not widths:
        return 0
    return lookup.agg(F.coalesce(F.sum(sum(widths, F.lit(0)).cast("bigint")), F.lit(0))).first()[0]


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_rows: int | None = None,
    counted_on: DataFrame | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Inner join on ``key``, safe for a key that holds a large share of ``rows``.

    A lookup found small, first by its rows and then by its text, is broadcast and
    ``rows`` stay where they are. ``lookup_rows`` may name an upper bound of its rows where
    counting would cost a join.

    Beyond that both sides are shuffled. A key with more than an even share of the rows
    is cut into pieces of about that share, by a hash of the row, and its one lookup row is
    copied to each piece. With P shuffle partitions there are fewer than P such keys and
    fewer than 2 P copies, however large the tables are. Hashing keeps a retried task from
    dealing its rows out differently; equal rows stay together and are left to Spark's own
    skew handling.

    The keys are counted on ``counted_on``, a stored table with about the same
    frequencies, where ``rows`` are themselves the result of a join or aggregation. The
    counts only decide the layout; the result is the same whatever they are.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    within = (lookup.count() if lookup_rows is None else lookup_rows) <= limit
    if within and _text_bytes(lookup) <= BROADCAST_TEXT_BYTES:
        return rows.join(F.broadcast(lookup), key)

    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.where(F.col(key).isNotNull())
    counted = rows if counted_on is None else counted_on
    share = max(1, counted.count() // partitions)
    held = counted.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_pieces")
    hot = held.where(F.col("_n") > share).select(key, pieces).collect()
    if not hot:
        return keyed.join(lookup, key)

    hot = spark.createDataFrame(hot, f"`{key}` {dict(rows.dtypes)[key]}, _pieces INT")
    piece = F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")).cast("int"), F.lit(0))
    cut = keyed.join(F.broadcast(hot), key, "left").withColumn("_piece", piece).drop("_pieces")
    last = F.coalesce(F.col("_pieces"), F.lit(1)) - 1
    copied = (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
        .drop("_pieces")
    )
    return cut.join(copied, [key, "_piece"]).drop("_piece")
