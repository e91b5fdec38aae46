"""Records of CSV files with line breaks inside quotes, read by many tasks.

Where a piece of a file begins nobody knows whether it begins inside quotes. Each line is
therefore a function of two states, outside and inside: what state follows it for each state
before it. A first pass composes the functions of every piece; going through the pieces in
order, one row each, the driver learns which of them begin inside. A second pass cuts the
text into records. Only records across the border of two pieces are shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A record may stretch over so many pieces; one that goes on has an unclosed quote.
MOST_PIECES = 8

# A closed field, not anchored; possessive, so that nothing is tried twice.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = rf'(?:{_QUOTED}|[^",][^,]*+|)'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'

_SPLIT = ("file", "start")


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Physical lines in the order of the file, with the piece of the file they come from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


def _open_after(line: Column) -> tuple[Column, Column]:
    """Whether a quote is open after the line: if none was open before it, and if one was."""
    outside = line.rlike(rf"\A(?:{_FIELD},)*+{_OPEN}\z")
    inside = line.rlike(rf'\A[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,(?:{_FIELD},)*+{_OPEN}\z)')
    return outside, inside


def running_states(outside: np.ndarray, inside: np.ndarray, first: int) -> np.ndarray:
    """The state before each line and after the last one, 1 for inside quotes.

    A line forgets the state before it, keeps it or turns it round: what counts is the last
    line that forgets and the number of turns since.
    """
    forgets, turns = outside == inside, (outside == 1) & (inside == 0)
    turned = np.cumsum(turns)
    last = np.maximum.accumulate(np.where(forgets, np.arange(len(outside)), -1))
    since = turned - np.where(last >= 0, turned[last], 0)
    after = np.where(last >= 0, outside[last], first) ^ (since & 1)
    return np.concatenate([[first], after]).astype(np.int64)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The rows of a batch by piece."""
    if not batch.num_rows:
        return
    starts = batch.column(1).to_numpy()
    files = batch.column(0).dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield (batch.column(0)[int(a)].as_py(), int(starts[a])), batch.slice(a, b - a)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece: for both states before it, the state after it and whether a record
    begins in it."""
    current, states, begins = None, [0, 1], [False, False]

    def row() -> pa.RecordBatch:
        names = ["file", "start", "after_outside", "after_inside", "begins_outside", "begins_inside"]
        values = [*current, *states, *map(bool, begins)]
        return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, values, strict=True)})

    for batch in batches:
        for piece, rows in _runs(batch):
            if piece != current:
                if current:
                    yield row()
                current, states, begins = piece, [0, 1], [False, False]
            outside, inside = (rows.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            for before in (0, 1):
                run = running_states(outside, inside, states[before])
                begins[before] |= bool((run[:-1] == 0).any())
                states[before] = int(run[-1])
    if current:
        yield row()


def _begun_inside(pieces: list) -> dict[tuple[str, int], int]:
    """The pieces that begin inside quotes, with the start of the piece where that record begins."""
    inside: dict[tuple[str, int], int] = {}
    file, state, owner, length = None, 0, 0, 0
    for p in [*sorted(pieces, key=lambda p: (p["file"], p["start"])), None]:
        if p is None or p["file"] != file:
            if state:
                raise ValueError(f"{file} ends inside quotes")
            if p is None:
                break
            file, state, length = p["file"], 0, 0
        if state:
            inside[file, p["start"]] = owner
            length += 1
            if length > MOST_PIECES:
                raise ValueError(f"a quote in {file}, after byte {owner}, is not closed")
        if p["begins_inside" if state else "begins_outside"]:
            owner, length = p["start"], 0
        state = p["after_inside" if state else "after_outside"]
    return inside


def records(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """The records of CSV files: ``file``, ``first`` (it is the first of its file), ``record``.

    A quote opens only at the beginning of a field and is doubled inside quotes; elsewhere it is
    a character like others. Records end with a line feed, or with carriage return and line feed.
    Blank ones are left out. A file that ends inside quotes is an error.
    """
    lines = _lines(spark, path, encoding)
    outside, inside = _open_after(F.col("line"))
    flags = lines.select(*_SPLIT, outside.cast("int").alias("outside"), inside.cast("int").alias("inside"))
    summary = "file string, start bigint, after_outside bigint, after_inside bigint, begins_outside boolean, begins_inside boolean"
    begun = _begun_inside(flags.mapInArrow(_summaries, summary).collect())  # one row per piece

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, held, first, owner = None, 0, [], True, None

        def rows(made: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*made, strict=True) if made else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "first", "owner", "start", "record"]
            )

        def ended() -> list[tuple]:
            """What is held at the end of a piece: the beginning of a record, a stretch of one, or
            a whole one."""
            if not held:
                return []
            own = owner if owner is not None else (current[1] if state else None)
            return [(current[0], first, own, current[1], "\n".join(held))]

        for batch in batches:
            for piece, part in _runs(batch):
                made = []
                if piece != current:
                    made += ended() if current else []
                    current, held, first = piece, [], piece[1] == 0
                    owner = begun.get(piece)
                    state = int(owner is not None)
                outside, inside = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
                run = running_states(outside, inside, state)
                state = int(run[-1])
                texts = part.column(4).to_pylist()
                for text, before in zip(texts, run[:-1].tolist(), strict=True):
                    if before == 0 and held:
                        made.append((piece[0], first, owner, piece[1], "\n".join(held)))
                        held, first, owner = [], False, None
                    held.append(text)
                yield rows(made)
        if current:
            yield rows(ended())

    marked = lines.select(*_SPLIT, outside.cast("int").alias("outside"), inside.cast("int").alias("inside"), "line")
    found = marked.mapInArrow(cut, "file string, first boolean, owner bigint, start bigint, record string")
    whole = found.where("owner IS NULL").select("file", "first", "record")
    if begun:
        parts = F.sort_array(F.collect_list(F.struct("start", "record", "first")))
        joined = found.where("owner IS NOT NULL").groupBy("file", "owner").agg(parts.alias("parts"))
        text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
        whole = whole.unionByName(joined.select("file", F.get("parts", F.lit(0))["first"].alias("first"), text.alias("record")))
    record = F.regexp_replace("record", r"\r\z", "")
    return whole.select("file", "first", record.alias("record")).where(r"NOT record RLIKE '\\A[ \\t]*\\z'")
