"""Bloom filters as tables: which rows of a batch may already be stored, without reading the store.

A filter has 2^15 bits in each of its blocks. The hash of a row picks one block and a few bits
in it, so that a lookup touches one row of the filter. There is a filter for each month and
written part, with as many blocks as the rows call for.
"""

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BITS = 1 << 15
# Bits a row sets, and bits there are for each: about 1 of 500 unknown rows passes for a known one.
BITS_SET = 7
BITS_PER_ROW = 13


def _places(row_hash: Column) -> Column:
    return F.array(*(F.pmod(F.xxhash64(row_hash, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(BITS_SET)))


def _block(row_hash: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(row_hash, F.lit("block")), blocks).cast("int")


def build_filter(rows: DataFrame, month: str, row_hash: str, part_id: str) -> DataFrame:
    """The filter of the rows: month, ``part_id``, ``blocks``, ``block``, ``bits``.

    Bits are gathered in each task before they meet, so what is shuffled is at most one block
    per task, month and block number. The table of months that is broadcast is bounded by the
    calendar.
    """
    sizes = rows.groupBy(month).agg(
        F.ceil(F.count(F.lit(1)) * F.lit(BITS_PER_ROW / BLOCK_BITS)).cast("int").alias("blocks")
    )
    sized = rows.select(month, row_hash).join(F.broadcast(sizes), month)
    placed = sized.select(
        month, "blocks", _block(F.col(row_hash), F.col("blocks")).alias("block"),
        F.explode(_places(F.col(row_hash))).alias("place"),
    )
    bits = placed.groupBy(month, "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    return bits.select(month, F.lit(part_id).alias("part_id"), "blocks", "block", "bits")


def maybe_known(rows: DataFrame, filters: DataFrame, month: str, row_hash: str, row: str) -> DataFrame:
    """The ``row`` numbers whose hash is in some filter of their month, each once.

    A known row is always among them. ``rows`` are looked up once for each filter of their
    month; what is shuffled is their hashes and the filters.
    """
    sizes = filters.select(month, "part_id", "blocks").distinct()
    asked = rows.select(month, F.col(row_hash).alias("_hash"), row).join(F.broadcast(sizes), month)
    asked = asked.withColumn("block", _block(F.col("_hash"), F.col("blocks")))
    met = asked.join(filters.select(month, "part_id", "block", "bits"), [month, "part_id", "block"])

    powers = F.array(*(F.lit(1 << b) for b in range(8)))

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.get(powers, (place % 8).cast("int"))) != 0

    return met.where(F.forall(_places(F.col("_hash")), is_set)).select(row).distinct()
