"""Near duplicates by 64-bit SimHash fingerprints and multi-index hashing."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import Scratch, free_name, row_key, rows_of, slices, texts_of
from tillwise.llm.graph import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 2
SEED = 42
BITS = 64

# Shingles whose bits are spread out in memory at once.
_BLOCK = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a text; 0 if it has no word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle_words, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(first), _BLOCK):
        spans = zip(first[at : at + _BLOCK], last[at : at + _BLOCK], strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(first), bitorder="little").view("<u8")[0])


def _fingerprints(docs: DataFrame, text: str, name: str, shingle_words: int) -> DataFrame:
    """All columns but the text, and the fingerprint as a signed 64-bit number."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others, F.lit(0).cast("bigint").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values = [fingerprint(t, shingle_words) for t in texts_of(part, text).to_pylist()]
                signed = pa.array(np.array(values, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), signed], names=[*others, name]
                )

    return docs.select(*others, text).mapInArrow(run, schema)


def ball(radius: int, segments: int = SEGMENTS) -> list[int]:
    """Masks that flip at most ``radius`` bits, segment by segment, as signed numbers.

    With radius 1 these are the fingerprint itself and the flips inside each segment;
    larger radii combine the balls of the segments.
    """
    width = BITS // segments
    places = [segment * width + bit for segment in range(segments) for bit in range(width)]
    masks = [sum(1 << p for p in chosen) for n in range(radius + 1) for chosen in combinations(places, n)]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` at most ``max_bits`` apart.

    Two fingerprints are that close exactly if one is within half the distance, rounded
    up, of a value that the other has within half, rounded down. So each fingerprint is
    entered in the index under the values of the Hamming balls inside its segments, the
    other segments being part of the key, and looks up the values of its own balls. A key
    holds as many fingerprints as a ball has values (65 for two bits), however many near
    copies the corpus has, so no group of copies makes a large bucket or all its pairs.
    Matches are linked to the smallest entry of their key after comparing all 64 bits.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be from 0 to 4: the balls grow with its power")
    reach, entered = (max_bits + 1) // 2, max_bits // 2
    mask = F.explode(F.array(*[F.lit(m).cast("bigint") for m in ball(reach, segments)])).alias("mask")
    probes = prints.select("fp", mask).select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("mask")).alias("key"),
        (F.bit_count("mask") <= entered).alias("entry"),
    )
    least = F.expr("min(CASE WHEN entry THEN fp END) OVER (PARTITION BY key)")
    found = probes.select("fp", least.alias("match")).where("match IS NOT NULL AND fp <> match")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("match"))) <= max_bits
    return found.where(near).select(F.col("fp").alias("a"), F.col("match").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (hex) and ``component_id``.

    The fingerprint is the bitwise majority of the hashes of all word shingles, repeats
    included. Documents whose fingerprints differ in at most ``max_bits`` are linked, and
    the component id is the smallest id a document can reach, its own included.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked
    like any other. Fewer words than a shingle are one shingle. Repeated rows stay, with
    equal results. A row without id has a result too; the component id is null only if
    no row it reaches has an id. No rows give no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    prints = scratch.save(_fingerprints(own, "text", "fp", shingle_words), "prints")
    distinct = scratch.save(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits), scratch)
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = scratch.save(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = scratch.save(rooted.join(least, "root").select("fp", "component"), "classes")
    scratch.release()
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents with one of each group of near duplicates, the one with the smallest id.

    All columns stay as they are. Rows with equal ids, and rows without one, which come
    last, are told apart by a hash of all their columns. Of rows equal in every column one
    stays. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, row_key(docs, id_column))
    found = near_duplicates(keyed, key, text_column, **options)
    stay = found.where(F.col(key) == F.col("component_id")).groupBy(key).agg(F.lit(1).alias("copies"))
    equal = found.where(F.col(key) == F.col("component_id")).select(key, F.lit(0).alias("copies"))
    return rows_of(keyed, key, stay.unionByName(equal), scratch)
