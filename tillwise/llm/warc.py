"""Web archives: WARC files of pages, a two-level index of their captures, and reading by ranges.

Every page becomes a record in a gzip member of its own, so a record can be read without the
rest of its file. Of pages with equal payloads one is kept as a response, the others are revisits
that refer to it.

The index sorts the captures by their URL with the host reversed. Each sorted slice becomes an
index file: compressed blocks of lines and behind them a directory with the first key of each
block. The list of index files with their first and last keys is all that tasks get to know
beforehand; it has a row per slice of the sort. A lookup searches that list, then the
directory of a file, then one block by halving, and reads the records' ranges.

Files are written by the tasks in a folder that all of them share. Their names are unique, and
what counts is written by Spark in rows, so a repeated task leaves only files that nobody reads.
"""

import base64
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import lru_cache
from hashlib import sha1
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import Scratch, whole_text

# A WARC file ends with the record that reaches this size.
ARCHIVE_BYTES = 512 << 20
# Captures in a block of the index.
BLOCK_LINES = 1000
# Records that follow each other are read together up to this size.
READ_BYTES = 8 << 20

_LEVEL = 1  # of compression
_TAIL = 8  # bytes at the end of an index file: the length of its directory
# Fixed value: profile of revisits in the WARC standard.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_URL = re.compile(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]+)?([^#]*)", re.IGNORECASE | re.DOTALL)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _safe(text: str) -> str:
    """White space and control characters as percent signs and digits."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", text)


def url_key(url: str | None) -> str:
    """The URL as the index sorts it: host in lower case and reversed, standard ports, user and
    fragment left out. Null is empty, a text that is no URL stays as it is."""
    if url is None:
        return ""
    parts = _URL.match(url.strip())
    if not parts:
        return _safe(url.strip())
    host = ",".join(reversed(parts[1].lower().split(".")))
    port = "" if parts[2] in (None, ":80", ":443") else parts[2]
    rest = parts[3] if parts[3].startswith("/") else f"/{parts[3]}"
    return _safe(f"{host}{port}){rest}")


def bare_digest(payload_sha1: bytes) -> str:
    return base64.b32encode(payload_sha1).decode()


# --- records ---------------------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def record(
    page_id: int | None, url: str | None, date: str, digest: str, size: int, payload: bytes | None, refers_to: int | None
) -> bytes:
    """A WARC record; without payload a revisit of the record of ``refers_to``."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}"]
    head.append(f"WARC-Record-ID: {_name(page_id)}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if payload is None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])


def parse_record(data: bytes) -> dict:
    """What a record says, with payload for a response; an error if its digest is another."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    found = {
        "page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": None, "payload": None,
    }
    if kind == "revisit":
        return found | {"refers_to": _page_of(fields["WARC-Refers-To"])}
    if len(payload) != size or bare_digest(sha1(payload).digest()) != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return found | {"payload": payload}


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if re.match(r"[a-z0-9]+:", folder) else f"file://{folder}")


# --- index files -----------------------------------------------------------------------


def pack_index(lines: list[tuple[str, str]], block_lines: int = BLOCK_LINES) -> bytes:
    """An index file of sorted (key, rest of the line) pairs."""
    out, directory = [], []
    at = 0
    for first in range(0, len(lines), block_lines):
        part = lines[first : first + block_lines]
        block = zlib.compress("\n".join(f"{key}\t{rest}" for key, rest in part).encode(), 6)
        directory.append(f"{part[0][0]}\t{at}\t{len(block)}")
        out.append(block)
        at += len(block)
    packed = zlib.compress("\n".join(directory).encode(), 6)
    return b"".join([*out, packed, len(packed).to_bytes(_TAIL, "little")])


class IndexFile:
    """An index file, read by ranges; holds its directory and the last block."""

    def __init__(self, files: pa.fs.FileSystem, path: str):
        self.source = files.open_input_file(path)
        size = self.source.size()
        length = int.from_bytes(self._range(size - _TAIL, _TAIL), "little")
        lines = zlib.decompress(self._range(size - _TAIL - length, length)).decode()
        entries = [line.split("\t") for line in lines.split("\n")] if lines else []
        self.keys = [key for key, _, _ in entries]
        self.ranges = [(int(at), int(n)) for _, at, n in entries]
        self._held: tuple[int, list[list[str]]] | None = None

    def _range(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def block(self, number: int) -> list[list[str]]:
        """The lines of a block: key, page, type, file, offset, length."""
        if self._held is None or self._held[0] != number:
            text = zlib.decompress(self._range(*self.ranges[number])).decode()
            self._held = number, [line.split("\t") for line in text.split("\n")]
        return self._held[1]

    def find(self, key: str) -> Iterator[list[str]]:
        """All lines of a key: from the last block that begins before it."""
        number = max(bisect_left(self.keys, key) - 1, 0)
        while number < len(self.keys) and self.keys[number] <= key:
            lines = self.block(number)
            at = bisect_left(lines, key, key=lambda line: line[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1
            number += 1


# --- writing -----------------------------------------------------------------------------

_CAPTURE = "key string, page_id bigint, record_type string, file string, offset bigint, length bigint"
_CAPTURE_ARROW = pa.schema(
    [
        ("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("file", pa.string()),
        ("offset", pa.int64()), ("length", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Archive:
    """A folder of WARC and index files. ``parts`` lists the index files in the order of their
    keys: (file, first key, last key, captures), a row per slice of the sort."""

    folder: str
    parts: list[tuple[str, str, str, int]]


def _with_verdicts(pages: DataFrame, revisit_from: int, scratch: Scratch) -> DataFrame:
    """Pages (id, url, payload) with ``size``, ``digest``, and ``refers_to`` for the revisits.

    Payloads are the same if their SHA-256 is. Payloads with more than an even share of the
    copies, fewer than there are shuffle partitions, are broadcast with their response; their
    rows stay where they are or, for revisits, travel without payload.
    """
    payload = whole_text("payload")
    keyed = pages.select(
        "id", "url", payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("size"),
        F.sha1(payload).alias("digest"), F.sha2(payload, 256).alias("same"),
    )
    copies = keyed.where(F.col("size") >= revisit_from).groupBy("same").agg(
        F.max("id").alias("response"), F.count(F.lit(1)).alias("n")
    )
    copies = scratch.save(copies.where("n > 1 AND response IS NOT NULL"), "copies")
    share = (copies.agg(F.sum("n")).first()[0] or 0) // int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = copies.where(F.col("n") > share).select("same", F.col("response").alias("hot_response"))
    cold = copies.where(F.col("n") <= share).select(F.col("same").alias("cold"), F.col("response").alias("cold_response"))

    def revisit(response: str):
        return F.when(F.col("id").isNull() | (F.col("id") < F.col(response)), F.col(response))

    rows = keyed.join(F.broadcast(hot), "same", "left").withColumn("hot_revisit", revisit("hot_response"))
    rows = rows.withColumn("payload", F.when(F.col("hot_revisit").isNull(), F.col("payload")))
    # Rows that are settled go anywhere in the next join, as keys that nothing equals.
    spread = F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string"))
    rows = rows.withColumn("cold", F.when(F.col("hot_response").isNull(), F.col("same")).otherwise(spread))
    rows = rows.join(cold.hint("shuffle_hash"), "cold", "left")
    refers_to = F.coalesce("hot_revisit", revisit("cold_response"))
    return rows.select("id", "url", "payload", "size", "digest", refers_to.alias("refers_to"))


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_from: int = 0,
    date: datetime | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
    block_lines: int = BLOCK_LINES,
) -> Archive:
    """Writes a record per row, then the index of all records.

    A null payload is an empty one. Of rows with equal payloads of at least ``revisit_from`` bytes
    those with the largest id are responses and the others revisits of it; rows without an id
    are revisits unless no row of the payload has one. Rows equal in id and payload are records of
    their own. A null URL leaves the field out and sorts first. Other columns have no part in it.
    No rows give an archive without files.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = folder or scratch.folder
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    own = pages.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(url_column).alias("url"),
        F.col(payload_column).alias("payload"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(f"{folder}/archive")
        files.create_dir(base, recursive=True)
        out = name = None
        try:
            for batch in batches:
                rows = []
                for at in range(batch.num_rows):
                    page, url, payload, size, digest, refers_to = (c[at].as_py() for c in batch.columns)
                    if out is None:
                        name = f"pages-{uuid4().hex}.warc.gz"
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    kept = None if refers_to is not None else payload.encode()
                    data = _member(record(page, url, stamp, bare_digest(bytes.fromhex(digest)), size, kept, refers_to))
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((url_key(url), page, kind, name, out.tell(), len(data)))
                    out.write(data)
                    if out.tell() >= archive_bytes:
                        out.close()
                        out = None
                yield _captures(rows)
        finally:
            if out is not None:
                out.close()

    verdicts = _with_verdicts(own, revisit_from, scratch)
    captures = scratch.save(verdicts.mapInArrow(write, _CAPTURE), "captures")
    archive = Archive(folder, index_captures(captures, folder, scratch, block_lines))
    scratch.drop("copies", "captures")
    scratch.release()
    return archive


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_CAPTURE_ARROW)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, _CAPTURE_ARROW.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_CAPTURE_ARROW)


def index_captures(captures: DataFrame, folder: str, scratch: Scratch, block_lines: int) -> list[tuple]:
    """Writes the index files and returns their list."""
    lines_in_file = 1000 * block_lines
    schema = pa.schema([("file", pa.string()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(f"{folder}/index")
        files.create_dir(base, recursive=True)
        held: list[tuple[str, str]] = []

        def flush() -> pa.RecordBatch:
            name = f"captures-{uuid4().hex}.idx"
            with files.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(pack_index(held, block_lines))
            row = {"file": [name], "first": [held[0][0]], "last": [held[-1][0]], "n": [len(held)]}
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            for key, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((key, "\t".join("" if v is None else str(v) for v in rest)))
                if len(held) >= lines_in_file:
                    yield flush()
        if held:
            yield flush()

    ordered = captures.orderBy("key", "page_id", "file", "offset")
    parts = scratch.save(ordered.mapInArrow(run, "file string, first string, last string, n bigint"), "parts")
    return [tuple(r) for r in parts.orderBy("first", "last").collect()]


# --- reading -----------------------------------------------------------------------------


def _entry(line: list[str]) -> tuple:
    key, page, kind, file, at, length = line
    return key, int(page) if page else None, kind, file, int(at), int(length)


def all_captures(spark, archive: Archive) -> DataFrame:
    """Every line of the index, a task for each of its files."""
    folder = archive.folder
    parts = spark.createDataFrame([(p[0],) for p in archive.parts], "file string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(f"{folder}/index")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                index = IndexFile(files, f"{base}/{name}")
                for number in range(len(index.keys)):
                    yield _captures([_entry(line) for line in index.block(number)])

    return parts.repartition(max(len(archive.parts), 1)).mapInArrow(run, _CAPTURE)


def lookup(archive: Archive, urls: DataFrame, url_column: str = "url") -> DataFrame:
    """The captures of URLs: a row per row of ``urls`` and capture with ``url`` and the columns of
    the index; URLs without captures have no row.

    The questions are sorted by key, so that a task reads neighbouring blocks, and equal ones
    are spread; nothing is joined.
    """
    folder, parts = archive.folder, archive.parts
    firsts, lasts = [p[1] for p in parts], [p[2] for p in parts]
    own = urls.select(F.col(url_column).alias("url"))
    host = F.lower(F.regexp_extract("url", r"://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    near = F.concat_ws(",", F.reverse(F.split(host, r"\.")))
    order = [near, F.col("url"), F.xxhash64(F.monotonically_increasing_id())]
    schema = pa.schema([("url", pa.string()), *_CAPTURE_ARROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(f"{folder}/index")
        opened = lru_cache(maxsize=4)(lambda name: IndexFile(files, f"{base}/{name}"))
        for batch in batches:
            for url in batch.column(0).to_pylist():
                key = url_key(url)
                # Parts are sorted by both their first and last keys.
                for part in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    rows = [(url, *_entry(line)) for line in opened(parts[part][0]).find(key)]
                    if rows:
                        columns = zip(zip(*rows, strict=True), schema.types, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], schema=schema)

    return own.repartitionByRange(*order).sortWithinPartitions(*order[:2]).mapInArrow(run, f"url string, {_CAPTURE}")


_RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(archive: Archive, captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records behind captures, read by ranges: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, and if asked for payload (null for revisits).

    Captures are sorted by file and offset over all tasks, and neighbours are read together.
    """
    folder = archive.folder
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema([*zip(names, kinds, strict=True), *([("payload", pa.binary())] if with_payload else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(f"{folder}/archive")
        opened = lru_cache(maxsize=4)(lambda name: files.open_input_file(f"{base}/{name}"))
        for batch in batches:
            for name, start, ranges in _runs(*(c.to_pylist() for c in batch.columns)):
                source = opened(name)
                source.seek(start)
                data = memoryview(source.read(ranges[-1][0] + ranges[-1][1] - start))
                found = [parse_record(zlib.decompress(data[a - start : a - start + n], 31)) for a, n in ranges]
                columns = [pa.array([r[f.name] for r in found], f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    own = captures.select("file", "offset", "length")
    ordered = own.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, f"{_RECORD}, payload binary" if with_payload else _RECORD)


def _runs(names: list, offsets: list, lengths: list) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """Ranges that follow each other in a file, up to ``READ_BYTES`` together."""
    ranges: list[tuple[int, int]] = []
    current = None
    for name, at, length in zip(names, offsets, lengths, strict=True):
        follows = ranges and name == current and at == sum(ranges[-1])
        if ranges and not (follows and at + length - ranges[0][0] <= READ_BYTES):
            yield current, ranges[0][0], ranges
            ranges = []
        current = name
        ranges.append((at, length))
    if ranges:
        yield current, ranges[0][0], ranges


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Writes the pages as archives, and reads every record back through the index."""
    archive = write_archive(pages, **options)
    return read_records(archive, all_captures(pages.sparkSession, archive))
