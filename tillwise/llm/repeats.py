"""Removal of passages that occur earlier in the corpus, by distributed prefix doubling.

A position is a byte of a document; its rank of length L names the L bytes that start
there, so that equal ranks mean equal bytes. Inside one document ranks of 1, 2, 4, ... 64
bytes are doubled in one vectorised pass: up to eight bytes are their own name, from there on
the name of 2L bytes mixes the names of two halves into 64 bits.
Across documents Spark sorts pairs of ranks at growing offsets and drops positions whose
pair nobody else has:

1. (rank 16, rank 16 further on), 32 bytes, of sampled positions only. A position is
   sampled if its 32 bytes have the smallest name in some window of ``LENGTH`` bytes, so
   every string of ``LENGTH`` bytes has one sampled position, its anchor, at the same
   offset in all its occurrences. Most anchors are unique and end here.
2. The stretch of text that is covered by all strings with one anchor, named by ranks of 64
   bytes. Stretches that occur earlier in whole are repeats in whole.
3. For the first of each of several different stretches around equal anchors: blocks of
   eight neighbouring positions, by the ``LENGTH - 7`` bytes all eight have in common,
   (rank 64, rank 64 at the offset that ends there). Unique blocks end here.
4. (rank 64, rank 64 at the offset that ends ``LENGTH`` bytes) of the positions that are
   left, past the threshold: all but the first of an equal pair are repeats.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import Scratch, slices
from tillwise.operators.ranking import with_running_total

LENGTH = 100
ANCHOR = 32
BLOCK = 8
# All anchors, and all single positions, are shuffled in so many slices, one after the other, so that
# the disks hold one of them.
SLICES = 4
# Bytes of short documents whose anchors are found in one pass; their ranks stay in a core's cache.
TOGETHER = 1 << 15

# Fixed mixing constants (odd 64-bit numbers) for names.
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = right >> np.uint64(29)
    mixed ^= right
    mixed *= _B
    mixed += left * _A
    mixed += _C
    mixed ^= mixed >> np.uint64(32)
    mixed *= _C
    mixed ^= mixed >> np.uint64(29)
    return mixed


def names(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Names of all strings of 8, 16, ... up to ``length`` bytes, by prefix doubling."""
    last, size = data, 1
    for wide in (np.uint16, np.uint32, np.uint64):  # the bytes themselves
        left, right = last[: max(len(last) - size, 0)].astype(wide), last[size:].astype(wide)
        last = left | (right << wide(8 * size))
        size *= 2
    out = {size: last}
    while 2 * size <= length:
        last = _mix(last[:-size], last[size:]) if len(last) > size else last[:0]
        size *= 2
        out[size] = last
    return out


def _smallest_places(rank: np.ndarray, window: int) -> np.ndarray:
    """For each window of ranks the place of its smallest, the first of equal ones, by doubling
    the window."""
    least, place, size = rank, np.arange(len(rank), dtype=np.int32), 1

    def halves(gap: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = least[: len(least) - gap], least[gap:]
        later = right < left
        return np.where(later, right, left), np.where(later, place[gap:], place[: len(place) - gap])

    while 2 * size <= window:
        least, place = halves(size)
        size *= 2
    if size < window:
        least, place = halves(window - size)
    return place.astype(np.int64)


def _smallest_ranks(rank: np.ndarray, window: int) -> np.ndarray:
    """For each window of ranks its smallest."""
    least, size = rank, 1
    while 2 * size <= window:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    gap = window - size
    return np.minimum(least[: len(least) - gap], least[gap:]) if gap else least


def anchors(rank: np.ndarray, window: int, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same place of their smallest rank, the first of equal ones: the
    document, first and last window of each and that place.

    Documents lie end to end in ``rank``; the windows of each begin from its start to before its
    stop. What lies between is no window.
    """
    if len(rank) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    least = _smallest_ranks(rank, window)
    borders = np.concatenate([starts, stops])
    borders = borders[borders < len(least)]

    new = np.append(True, least[1:] != least[:-1])
    new[borders] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(least)) - 1
    doc = np.searchsorted(starts, first, side="right") - 1
    own = first < stops[doc]
    doc, first, last = doc[own], first[own], last[own]
    # A smaller rank than before is the one that has come into the window.
    place = first + window - 1
    larger = np.flatnonzero((first == 0) | (least[first] >= least[first - 1]))
    windows = np.lib.stride_tricks.sliding_window_view(rank, window)[first[larger]]
    place[larger] = first[larger] + np.argmax(windows == least[first[larger], None], axis=1)
    late = np.unique(doc[last > place])  # equal ranks in one window: the place moves on inside a run
    if len(late):
        rest = ~np.isin(doc, late)
        found = [(doc[rest], first[rest], last[rest], place[rest])]
        for d in late.tolist():
            places = _smallest_places(rank[starts[d] : stops[d] + window - 1], window)
            begin = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
            end = np.append(begin[1:], len(places)) - 1
            found.append((np.full(len(begin), d), *(starts[d] + x for x in (begin, end, places[begin]))))
        doc, first, last, place = (np.concatenate(column) for column in zip(*found, strict=True))
    return doc, first, last, place


def _stretch_name(rank64: np.ndarray, start: np.ndarray, end: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Name of the bytes [start, end), 100 to 192 of them, by three overlapping ranks."""
    middle = np.minimum(start + 64, end - 64)
    return _mix(_mix(rank64[start], rank64[middle]), _mix(rank64[end - 64], shape.astype(np.uint64)))


def document_anchors(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of each anchor: its document, name, place there, first and last position that it belongs to,
    and the name of the stretch around it. ``data`` holds documents of the given sizes end to end;
    those of fewer than ``length`` bytes have no anchors."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    starts = np.cumsum(sizes) - sizes
    ranks = names(data, 64)
    rank32, rank64 = ranks[ANCHOR], ranks[64]
    stops = starts + np.maximum(sizes - length + 1, 0)
    doc, first, last, at = anchors(rank32, length - ANCHOR + 1, starts, stops)
    shape = (at - first) * 256 + (at - last)
    stretch = _stretch_name(rank64, first, last + length, shape)
    start = starts[doc]
    return doc, rank32[at].view(np.int64), at - start, first - start, last - start, stretch.view(np.int64)


def _all_anchors(docs: DataFrame, length: int) -> DataFrame:
    kind = pa.schema(
        [("anchor", pa.int64()), ("stretch", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()),
         ("before", pa.int16()), ("span", pa.int16())]
    )

    def joined(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [np.concatenate(column) for column in zip(*held, strict=True)]
        arrays = [pa.array(column, f.type) for column, f in zip(columns, kind, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for piece in slices(batch, "data", TOGETHER):
                texts = piece.column("data")
                sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
                data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
                row, name, at, first, last, stretch = document_anchors(data, sizes, length)
                held.append((name, stretch, _column(piece, "doc")[row], at, at - first, last - first))
                size += len(row)
                if size > 200_000:
                    yield joined(held)
                    held, size = [], 0
            if size:
                yield joined(held)

    return docs.mapInArrow(run, "anchor bigint, stretch bigint, doc bigint, at int, before smallint, span smallint")


def _snippets(docs: DataFrame, length: int) -> DataFrame:
    """The text around chosen anchors, from which blocks and positions are named."""
    kind = pa.schema(
        [("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("low", pa.int32()),
         ("first", pa.int32()), ("last", pa.int32()), ("snippet", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "data"):
                rows = {name: [] for name in kind.names}
                for row in piece.to_pylist():
                    data = row["data"]
                    for x in row["chosen"]:
                        first = x["at"] - x["before"]
                        last = first + x["span"]
                        # Whole blocks reach beyond the anchor's own positions.
                        low, high = max(0, first - BLOCK), min(len(data), last + BLOCK + length)
                        for name, value in zip(
                            kind.names,
                            (x["anchor"], row["doc"], x["at"], low, first, last, data[low:high]),
                            strict=True,
                        ):
                            rows[name].append(value)
                if rows["doc"]:
                    yield pa.RecordBatch.from_pydict(rows, kind)

    schema = "anchor bigint, doc bigint, at int, low int, first int, last int, snippet binary"
    return docs.mapInArrow(run, schema)


class _Joined:
    """The snippets of a batch as one run of bytes, so that their names are made in one pass.

    A name that reaches into the next snippet is never asked for.
    """

    def __init__(self, batch: pa.RecordBatch):
        snippets = batch.column("data")
        self.sizes = pc.binary_length(snippets).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        data = np.frombuffer(b"".join(snippets.to_pylist()), np.uint8)
        self.rank64 = names(data, 64)[64]

    def pair(self, row: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The two ranks that name ``length`` bytes from each start inside its row's snippet."""
        at = self.starts[row] + start
        return self.rank64[at].view(np.int64), self.rank64[at + length - 64].view(np.int64)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(snippets: DataFrame, length: int) -> DataFrame:
    """Blocks of neighbouring positions, aligned to the anchor. ``key`` names what they share.

    A block that the document cuts off has no key and is looked at position by position.
    ``place`` names the anchor and the block's place by it. Equal names of different
    blocks only let more positions through to the last step.
    """
    schema = "place bigint, key bigint, doc bigint, at int, nth int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "data"):
                joined = _Joined(piece)
                at, low = _column(piece, "at"), _column(piece, "low")
                least = (at - _column(piece, "last")) // BLOCK
                n = (at - _column(piece, "first")) // BLOCK - least + 1
                row = np.repeat(np.arange(len(n)), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + least[row]
                # Positions at - 8 nth - 7 ... at - 8 nth, as places in the snippet.
                stop = (at - low)[row] - BLOCK * nth
                whole = (stop - BLOCK + 1 >= 0) & (stop + length <= joined.sizes[row])
                anchor = _column(piece, "anchor")[row].view(np.uint64)
                place = _mix(anchor, nth.astype(np.uint64))
                first, second = joined.pair(row[whole], stop[whole], length - BLOCK + 1)
                key = np.zeros(len(row), np.uint64)
                key[whole] = _mix(_mix(first.view(np.uint64), second.view(np.uint64)), place[whole])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place.view(np.int64)),
                        pa.array(key.view(np.int64), mask=~whole),
                        pa.array(_column(piece, "doc")[row]),
                        pa.array(at[row].astype(np.int32)),
                        pa.array(nth.astype(np.int32)),
                    ],
                    names=["place", "key", "doc", "at", "nth"],
                )

    return snippets.withColumnRenamed("snippet", "data").mapInArrow(run, schema)


def _positions(snippets: DataFrame, length: int) -> DataFrame:
    """Single positions of the blocks in ``nths``, named past the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "data"):
                joined = _Joined(piece)
                lists = piece.column("nths")
                n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                nth = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.repeat(np.arange(len(n)), n), BLOCK)
                at, low = _column(piece, "at"), _column(piece, "low")
                within = np.tile(np.arange(BLOCK), len(nth))
                start = (at - low)[row] - BLOCK * np.repeat(nth, BLOCK) - within
                fits = (start >= 0) & (start + length <= joined.sizes[row])
                row, start = row[fits], start[fits]
                first, second = joined.pair(row, start, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first),
                        pa.array(second),
                        pa.array(_column(piece, "doc")[row]),
                        pa.array((start + low[row]).astype(np.int32)),
                    ],
                    names=["a", "b", "doc", "pos"],
                )

    own = snippets.withColumnRenamed("snippet", "data")
    return own.mapInArrow(run, "a bigint, b bigint, doc bigint, pos int")


def _few(keys: DataFrame) -> DataFrame:
    """For joins with a table of distinct keys, of those few rows that have company: it is hashed
    partition by partition, and the many other rows are not sorted."""
    return keys.hint("shuffle_hash")


def _later(rows: DataFrame, keys: list[str], order: Column, scratch: Scratch, name: str) -> DataFrame:
    """The rows that are not the first of their keys; the first is found before the join."""
    first = rows.groupBy(*keys).agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n"))
    first = scratch.save(first.where("n > 1").drop("n"), f"{name}-first")
    scratch.release()
    return rows.join(_few(first), keys).where(order > F.col("least")).drop("least")


def repeated_runs(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """(doc, spans): the spans that the repeated strings cover, perhaps overlapping, each as
    start * 2^32 + end.

    ``docs`` has ``doc``, where the document starts if all are laid end to end in the order that
    decides what is earlier, and ``data``, distinct bytes. A place in the corpus is one number.
    """
    place = F.col("doc") + F.col("at")
    found = scratch.save(_all_anchors(docs.select("doc", "data"), length), "anchors")
    # 1. Anchors that nobody else has, slice by slice of their names.
    kept = None
    for i in range(SLICES):
        part = found.where(F.pmod("anchor", F.lit(SLICES)) == i)
        shared = part.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
        shared = scratch.save(shared, "shared")
        scratch.release()
        part = scratch.save(part.join(_few(shared), "anchor"), f"kept{i}")
        scratch.release()
        kept = part if kept is None else kept.unionByName(part)
    scratch.drop("anchors", "shared")
    # 2. Whole stretches.
    stretches = kept.groupBy("anchor", "stretch").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n"))
    stretches = scratch.save(stretches, "stretches")
    scratch.release()
    several = stretches.where("n > 1").select("anchor", "stretch", "least")
    whole = kept.join(several, ["anchor", "stretch"]).where(place > F.col("least"))
    first = F.col("at") - F.col("before")
    whole = scratch.save(whole.select("doc", _span(first, first + F.col("span") + length)), "whole")
    scratch.release()
    mixed = stretches.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    chosen = scratch.save(stretches.join(mixed, "anchor").select("least"), "mixed")
    scratch.release()
    chosen = kept.join(chosen, place == F.col("least"), "left_semi")
    chosen = chosen.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "before", "span")).alias("chosen"))
    chosen = scratch.save(chosen, "chosen")
    scratch.drop(*(f"kept{i}" for i in range(SLICES)), "stretches", "mixed")
    scratch.release()
    snippets = scratch.save(_snippets(docs.join(chosen, "doc"), length), "snippets")
    scratch.drop("chosen")
    scratch.release()
    # 3. Blocks.
    blocks = scratch.save(_blocks(snippets, length), "blocks")
    common = blocks.where("key IS NOT NULL").groupBy("place", "key").agg(F.count(F.lit(1)).alias("n"))
    edges = blocks.where("key IS NULL").select("place").distinct().withColumn("edge", F.lit(True))
    common = common.join(edges, "place", "left").where("n > 1 OR edge").select("place", "key")
    common = scratch.save(common, "common")
    scratch.release()
    left = blocks.where("key IS NOT NULL").join(_few(common), ["place", "key"], "left_semi").select("doc", "at", "nth")
    left = left.unionByName(blocks.where("key IS NULL").select("doc", "at", "nth"))
    nths = scratch.save(left.groupBy("doc", "at").agg(F.collect_list("nth").alias("nths")), "nths")
    scratch.drop("blocks", "common")
    scratch.release()
    # 4. Single positions.
    chosen_snippets = snippets.join(nths, ["doc", "at"])
    positions = scratch.save(_positions(chosen_snippets, length), "positions")
    scratch.drop("snippets", "nths")
    scratch.release()
    repeated = whole
    for i in range(SLICES):
        part = positions.where(F.pmod("a", F.lit(SLICES)) == i)
        single = _later(part, ["a", "b"], F.col("doc") + F.col("pos"), scratch, "positions")
        single = scratch.save(single.select("doc", _span(F.col("pos"), F.col("pos") + length)), f"single{i}")
        scratch.release()
        repeated = repeated.unionByName(single)
    scratch.drop("positions", "positions-first")
    spans = scratch.save(repeated.groupBy("doc").agg(F.collect_list("span").alias("spans")), "spans")
    scratch.drop("whole", *(f"single{i}" for i in range(SLICES)))
    scratch.release()
    return spans


def _span(start: Column, end: Column) -> Column:
    return (F.shiftleft(start.cast("bigint"), 32) + end).alias("span")


def _cut(data: bytes, spans: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside the spans, and how many maximal runs were removed."""
    spans = np.sort(spans)
    start, end = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    new = np.append(True, start[1:] > end[:-1])
    lows, highs = start[new], end[np.append(new[1:], True)]
    borders = zip(np.append(0, highs).tolist(), np.append(lows, len(data)).tolist(), strict=True)
    return b"".join(data[low:high] for low, high in borders), len(lows)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and,
    if asked for, ``kept``, the remaining bytes.

    Removed is every byte covered by a string of ``length`` bytes that also starts earlier: in a
    document with a smaller id, or further left in the same. Null texts are empty; texts
    of fewer than ``length`` bytes stay. Rows with equal ids are ordered by a hash of
    their bytes, rows without id come last; of equal rows the first counts as the earlier. No
    rows give no rows; other columns are ignored.

    Of equal texts only the first is looked at: what others hold occurs there.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary"))
    sized = docs.select(F.col(id_column).alias("id"), data.alias("data")).withColumn("hash", F.sha2("data", 256))
    rank = F.struct(F.col("id").isNull().alias("unknown"), F.col("id").alias("id"))
    n_bytes = F.octet_length("data")
    small = F.when(n_bytes < length, F.col("data"))
    rows = sized.groupBy(rank.alias("rank"), "hash").agg(
        F.count(F.lit(1)).alias("n"), F.max(n_bytes).cast("bigint").alias("n_bytes"), F.any_value(small).alias("small")
    )
    rows = scratch.save(rows, "rows")
    # One more than the bytes, so that empty texts have a place of their own.
    firsts = rows.groupBy("hash").agg(F.min("rank").alias("first"), (F.max("n_bytes") + 1).alias("room"))
    firsts = scratch.save(firsts, "firsts")
    numbered = with_running_total(firsts, ["first", "hash"], "room", "end", "all")
    numbered = scratch.save(numbered.select("hash", "first", (F.col("end") - F.col("room")).alias("doc")), "numbered")
    scratch.drop("firsts")
    owner = numbered.select(F.col("hash").alias("of"), F.col("first"), "doc")
    distinct = sized.where(n_bytes >= length).join(owner, (F.col("hash") == F.col("of")) & rank.eqNullSafe(F.col("first")))
    if not rows.where("n > 1").isEmpty():
        distinct = distinct.groupBy("doc").agg(F.any_value("data").alias("data"))
    distinct = scratch.save(distinct.select("doc", "data"), "distinct", "zstd")
    scratch.release()
    spans = repeated_runs(distinct, scratch, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "data"):
                lists = piece["spans"]
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                texts = piece["data"].to_pylist()
                held = [_cut(d, s) for d, s in zip(texts, np.split(flat, ends[:-1]), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc"],
                        pa.array([n for _, n in held], pa.int64()),
                        pa.array([len(d) - len(k) for d, (k, _) in zip(texts, held, strict=True)], pa.int64()),
                        pa.array([hashlib.sha256(kept).hexdigest() for kept, _ in held], pa.string()),
                        pa.array([kept for kept, _ in held], pa.binary()),
                    ],
                    names=["doc", "n_spans", "n_removed", "kept_sha256", "rest"],
                )

    cut = distinct.join(spans, "doc").select("doc", "data", "spans")
    schema = "doc bigint, n_spans bigint, n_removed bigint, kept_sha256 string, rest binary"
    cut = cut.mapInArrow(run, schema)
    cut = scratch.save(cut if with_text else cut.drop("rest"), "cut")
    scratch.release()
    none, empty = F.lit(0).cast("bigint"), F.lit("").cast("binary")
    known = rows.join(numbered, "hash").withColumn("lead", F.col("rank") == F.col("first"))
    leads = known.where("lead").join(cut, "doc", "left")
    if with_text:
        leads = leads.join(distinct, "doc", "left").withColumn("kept", F.coalesce("rest", "data", "small"))
    columns = [
        F.col("rank.id").alias(id_column),
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "hash").alias("kept_sha256"),
    ]
    leads = leads.select(*columns, *(["kept"] if with_text else []))
    copies = F.when(F.col("lead"), F.col("n") - 1).otherwise(F.col("n"))
    others = known.where(copies > 0).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    gone = F.col("n_bytes") >= length
    others = others.select(
        F.col("rank.id").alias(id_column),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(none).alias("n_removed"),
        gone.cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(empty, 256)).otherwise(F.col("hash")).alias("kept_sha256"),
        *([F.when(gone, empty).otherwise(F.col("small")).alias("kept")] if with_text else []),
    )
    return leads.unionByName(others)
