"""Token ids in binary shards: Simple-8b words with escapes and per-block offsets.

A shard is one file, all numbers little-endian::

    magic      8 bytes  b"TWS8B\\0\\0\\1"
    n_docs     u64
    n_blocks   u64
    n_words    u64
    doc_ids    n_docs x i64     in ascending order
    doc_known  n_docs x u8      0 where the document has no id
    doc_sizes  n_docs x u64     ids of each document, end id included
    offsets    n_blocks x u64   first word of each block
    words      n_words x u64

The ids of a shard's documents follow each other without gaps and are cut into blocks of
``BLOCK`` ids. In each word the top four bits select how many ids of how many bits fill the
other 60, first id in the lowest bits. Selector 15 is an escape: the next whole word is one
id of 64 bits. Block offsets allow all blocks to be decoded side by side.
"""

from collections.abc import Iterator
from functools import cache
from uuid import uuid4

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from tillwise.llm.common import Scratch, coded_words, group_sums, reach_package, slices, texts_of
from tillwise.sources.staging import new_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK = 512

# Bytes of text in a shard, beyond one long text; the writer holds them encoded only.
SHARD_BYTES = 64 << 20
# Words whose ids a Python worker remembers.
CACHED_WORDS = 1_500_000
# Words of up to so many times eight bytes.
LANES = 3
# Words handed to the tokenizer at once.
ENCODED_WORDS = 500
# Tasks that read shards, if there are that many.
READ_TASKS = 20_000
# Blocks a reader decodes at once.
READ_BLOCKS = 2048

MAGIC = b"TWS8B\0\0\1"

# Fixed values of Simple-8b: ids in a word and bits of each, by selector from 1 on.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of the ids, and the first word of each block.

    The longest run that fits is packed at each place. All blocks are packed side by side,
    one word of each at a time.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n_blocks = -(-len(ids) // block)
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    limits = np.minimum((np.arange(n_blocks) + 1) * block, len(ids))
    # How many ids from each place on fit into a given width.
    choice = np.full(len(ids), ESCAPE, np.uint8)
    left = np.repeat(limits, np.diff(np.append(0, limits))) - np.arange(len(ids))
    for selector in range(len(COUNTS), 0, -1):
        count, width = COUNTS[selector - 1], WIDTHS[selector - 1]
        if count > len(ids):
            continue
        wide = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(ids >> np.uint64(width) != 0, out=wide[1:])
        last = len(ids) - count + 1
        fits = (wide[count:] == wide[:last]) & (left[:last] >= count)
        choice[:last][fits] = selector
    steps = np.ones(ESCAPE + 1, np.int64)
    steps[1:ESCAPE] = COUNTS
    at = np.arange(n_blocks) * block
    live = np.arange(n_blocks)
    picked = []
    while len(live):
        here = at[live]
        picked.append(here)
        at[live] = here + steps[choice[here]]
        live = live[at[live] < limits[live]]
    starts = np.sort(np.concatenate(picked))
    chosen = choice[starts]
    sizes = np.where(chosen == ESCAPE, 2, 1)
    first = np.concatenate([[0], np.cumsum(sizes)])
    words = np.zeros(first[-1], np.uint64)
    first = first[:-1]
    for selector in np.unique(chosen):
        own, to = starts[chosen == selector], first[chosen == selector]
        words[to] = np.uint64(int(selector) << 60)
        if selector == ESCAPE:
            words[to + 1] = ids[own]
            continue
        for k in range(COUNTS[selector - 1]):
            words[to] |= ids[own + k] << np.uint64(k * WIDTHS[selector - 1])
    offsets = first[np.searchsorted(starts, np.arange(n_blocks) * block)]
    return words, offsets.astype(np.uint64)


def decode(words: np.ndarray, offsets: np.ndarray, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids again: the words of all blocks are read side by side, a selector at a time."""
    out = np.zeros(n_ids, np.uint64)
    if not len(offsets):
        return out
    limits = np.append(offsets[1:], len(words)).astype(np.int64)
    at, to = offsets.astype(np.int64), np.arange(len(offsets)) * block
    live = np.arange(len(offsets))
    while len(live):
        here, selector = at[live], (words[at[live]] >> np.uint64(60)).astype(np.int64)
        for s in np.unique(selector):
            own = live[selector == s]
            if s == ESCAPE:
                out[to[own]] = words[at[own] + 1]
                at[own] += 2
                to[own] += 1
                continue
            count, width = COUNTS[s - 1], WIDTHS[s - 1]
            mask = np.uint64((1 << width) - 1)
            spread = words[at[own]][:, None] >> (np.arange(count) * width).astype(np.uint64)
            out[to[own][:, None] + np.arange(count)] = spread & mask
            at[own] += 1
            to[own] += count
        live = live[at[live] < limits[live]]
    return out


class ShardWriter:
    """Takes the ids of one document after another and holds them encoded."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.sizes: list[np.ndarray] = []
        self.rest = np.zeros(0, np.uint32)
        self.words: list[np.ndarray] = []
        self.offsets: list[np.ndarray] = []
        self.n_words = self.n_ids = 0

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes.append(sizes)
        self.n_ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._encode(ids[:whole])
        self.rest = ids[whole:].copy()

    def _encode(self, ids: np.ndarray) -> None:
        words, offsets = encode(ids)
        self.words.append(words)
        self.offsets.append(offsets + np.uint64(self.n_words))
        self.n_words += len(words)

    def parts(self) -> Iterator[bytes]:
        """The bytes of the shard; ends it."""
        self._encode(self.rest)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        numbers = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        head = [len(self.doc_ids), sum(map(len, self.offsets)), self.n_words]
        yield MAGIC
        columns = (np.array(head, "<u8"), numbers, known, *(np.asarray(x, "<u8") for x in self.sizes))
        for column in (*columns, *self.offsets, *self.words):
            yield column.tobytes()


def read_shard(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Ids of documents, ids in each, and these ids, some blocks' worth at a time."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of token ids")
    n_docs, n_blocks, n_words = (int(n) for n in np.frombuffer(data, "<u8", 3, len(MAGIC)))
    at = len(MAGIC) + 24

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(data, kind, n, at)
        at += part.nbytes
        return part

    numbers, known, sizes = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs).astype(np.int64)
    offsets, words = take("<u8", n_blocks), take("<u8", n_words)
    ends = np.cumsum(sizes)
    total, done, rest = int(sizes.sum()), 0, np.zeros(0, np.uint32)
    for first in range(0, n_blocks, READ_BLOCKS):
        last = min(first + READ_BLOCKS, n_blocks)
        low, high = int(offsets[first]), int(offsets[last]) if last < n_blocks else n_words
        n_ids = min(last * BLOCK, total) - first * BLOCK
        found = decode(words[low:high], offsets[first:last] - np.uint64(low), n_ids)
        rest = np.concatenate([rest, found.astype(np.uint32)])
        until = int(np.searchsorted(ends, min(last * BLOCK, total), side="right"))
        if until > done:
            doc_ids = [int(d) if k else None for d, k in zip(numbers[done:until], known[done:until], strict=True)]
            n = int(sizes[done:until].sum())
            yield doc_ids, sizes[done:until], rest[:n]
            rest, done = rest[n:].copy(), until


def _lanes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first ``LANES`` times eight bytes of each word as numbers, and which words are no longer."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    sizes, width = np.diff(offsets), 8 * LANES
    lanes = np.zeros((len(words), width), np.uint8)
    for i in range(width):  # byte by byte, as most words are short
        longer = np.flatnonzero(sizes > i)
        if not len(longer):
            break
        lanes[longer, i] = data[offsets[longer] + i]
    # A zero byte inside a word must not look like its end.
    return lanes.view(np.uint64), (sizes <= width) & ((lanes != 0).sum(axis=1) == sizes)


def _mixed(lanes: np.ndarray) -> np.ndarray:
    mixed = np.zeros(len(lanes), np.uint64)
    for lane in lanes.T:
        mixed = (mixed ^ lane) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _separator(tokenizer: Tokenizer) -> tuple[str, int] | None:
    """A token of the vocabulary that parts a text before anything else is done to it, and its id."""
    for number, token in sorted(tokenizer.get_added_tokens_decoder().items(), reverse=True):
        if token.special and not (token.normalized or token.single_word or token.lstrip or token.rstrip):
            return token.content, number
    return None


class WordIds:
    """Ids of distinct words: the first ``CACHED_WORDS`` met are kept, unless they are very long.

    Kept words are found by halving in a sorted array of hashes and compared byte for byte; a
    word whose hash another word has is encoded each time.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.between = _separator(self.tokenizer)
        self.hashes = np.zeros(0, np.uint64)
        self.lanes = np.zeros((0, LANES), np.uint64)
        self.first = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), ENCODED_WORDS):  # the library's own results are bulky
            some = words.slice(at, ENCODED_WORDS).to_pylist()
            found = self._encode_joined(some) or self._encode_each(some)
            ids.append(found[0])
            sizes.append(found[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """All words in one text, a result for each would cost more than its ids. None if a word
        has the separator in it."""
        if self.between is None:
            return None
        text, number = self.between
        joined = text.join(words)
        if joined.count(text) != len(words) - 1:
            return None
        found = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(found == number)
        if len(at) != len(words) - 1:
            return None
        return np.delete(found, at), np.diff(at, prepend=-1, append=len(found)) - 1

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, n): the ids of word i are the n[i] from first[i] on."""
        lanes, short = _lanes(words)
        hashes = _mixed(lanes)
        first = np.zeros(len(words), np.int64)
        n = np.zeros(len(words), np.int64)
        known = np.zeros(len(words), bool)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = short & (self.hashes[at] == hashes) & (self.lanes[at] == lanes).all(axis=1)
            first[known], n[known] = self.first[at[known]], self.n[at[known]]
        new_ids, new_sizes = self._encode(words.filter(pa.array(~known)))
        first[~known] = len(self.ids) + np.cumsum(new_sizes) - new_sizes
        n[~known] = new_sizes
        ids = np.concatenate([self.ids, new_ids])
        self._keep(lanes[~known], hashes[~known], short[~known], new_ids, new_sizes)
        return ids, first, n

    def _keep(
        self, lanes: np.ndarray, hashes: np.ndarray, short: np.ndarray, ids: np.ndarray, sizes: np.ndarray
    ) -> None:
        room = CACHED_WORDS - len(self.hashes)
        _, once = np.unique(hashes, return_index=True)
        kept = np.zeros(len(hashes), bool)
        kept[once] = short[once]
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            kept &= self.hashes[at] != hashes
        kept &= np.cumsum(kept) <= room
        if not kept.any():
            return
        starts = len(self.ids) + np.cumsum(sizes[kept]) - sizes[kept]
        self.ids = np.concatenate([self.ids, ids[np.repeat(kept, sizes)]])
        order = np.argsort(hashes[kept])
        places = np.searchsorted(self.hashes, hashes[kept][order])
        self.hashes = np.insert(self.hashes, places, hashes[kept][order])
        self.lanes = np.insert(self.lanes, places, lanes[kept][order], axis=0)
        self.first = np.insert(self.first, places, starts[order])
        self.n = np.insert(self.n, places, sizes[kept][order])


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenize(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and the ids per text, without end ids.

    The vocabulary drops white space and merges nothing across it, so the ids of a text
    are those of its words, and each distinct word is encoded once.
    """
    words, codes, sizes = coded_words(texts)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(len(sizes), np.int64)
    flat, first, n = _word_ids(path).of(words)
    per_word, begin = n[codes], first[codes]
    before = np.cumsum(per_word) - per_word
    places = np.arange(int(per_word.sum())) + np.repeat(begin - before, per_word)
    return flat[places], group_sums(per_word, sizes)


def with_ends(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text."""
    out = np.full(len(ids) + len(sizes), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
    return out, sizes + 1


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_shards(
    docs: DataFrame,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Writes the ids of all documents in ascending id order and returns the manifest.

    Documents are sorted by id across all tasks, rows without id first, rows with equal ids
    by a hash of the text; a null text is empty and has only its end id. Each task cuts
    its range into shards of a bounded size. The manifest, a written table, has a row per
    shard: ``part``, ``shard``, ``file``, ``n_docs``, ``n_ids``; order by the first two.
    File names are unique, and only files in the manifest count, so a repeated task
    leaves nothing but files that nobody reads. No rows give an empty manifest.
    """
    spark = docs.sparkSession
    reach_package(spark)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    own = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    ordered = own.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, base = _opened(folder)
        files.create_dir(base, recursive=True)
        writer, held, shard = ShardWriter(), 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal writer, held, shard
            name = f"part-{part:06}-{shard:05}-{uuid4().hex}.s8b"
            with files.open_output_stream(f"{base}/{name}") as out:
                for piece in writer.parts():
                    out.write(piece)
            row = (part, shard, name, len(writer.doc_ids), writer.n_ids)
            writer, held, shard = ShardWriter(), 0, shard + 1
            return pa.RecordBatch.from_pydict({k: [v] for k, v in zip(schema.names, row, strict=True)}, schema)

        for batch in batches:
            for piece in slices(batch, "text"):
                ids, sizes = with_ends(*tokenize(texts_of(piece, "text"), path), end_id)
                writer.add(piece.column("id").to_pylist(), sizes, ids)
                held += int(pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0)
                if held >= SHARD_BYTES:
                    yield flush()
        if writer.doc_ids:
            yield flush()

    schema = pa.schema(
        [("part", pa.int32()), ("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
    )
    rows = ordered.mapInArrow(run, "part int, shard int, file string, n_docs bigint, n_ids bigint")
    rows.write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark, folder: str) -> DataFrame:
    """The manifest with ``start``, the ids before each shard, from sums per part first."""
    rows = spark.read.parquet(f"{folder}/manifest")
    parts = rows.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    # One row per task that wrote, never per document.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return own.join(parts, "part").select(*rows.columns, (F.col("before") + F.col("inside")).alias("start"))


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, read from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with files.open_input_file(f"{base}/{file}") as source:
                    data = source.read()
                for doc_ids, sizes, ids in read_shard(data):
                    ends = np.cumsum(sizes)
                    raw = ids.astype("<u4").tobytes()
                    cuts = (4 * np.concatenate([[0], ends])).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(start + ends - sizes, pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    start += int(sizes.sum())

    # A shard is the unit of reading. The number of tasks is given, or Spark would put the
    # few bytes of the manifest, and with them all shards, into one.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    spread = manifest.select("file", "start").repartition(tasks, "file")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_index(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the documents' ids and returns, from the files, ``doc_id``, ``start``,
    ``n_tokens`` and ``ids_crc32`` of each document; see ``write_shards``."""
    folder = folder or new_path(docs.sparkSession, "tokens")
    manifest = write_shards(docs, folder, **options)
    scratch = Scratch(docs.sparkSession, "tokens")
    manifest = scratch.save(manifest, "manifest")
    scratch.release()
    read = read_shards(manifest, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
