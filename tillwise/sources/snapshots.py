"""Versions of a set of tables that are switched all at once.

Tables are written into folders of their own that nobody reads yet. A commit then adds one
small numbered file, the manifest, that names the folders of every table; the largest number is
the current version. Readers take one manifest and so see tables that belong together, and a
writer that dies before its commit has changed nothing. Files are never changed, so a reader
goes on with its version while the next one is written.

A manifest is created exclusively: of two writers that start from the same version one commits
and the other has to start from the new one (``Conflict``).
"""

import json
import time
from collections.abc import Iterable
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwise.sources.shared import SharedFolder

_MANIFESTS = "_manifests"
_DATA = "data"


class Conflict(RuntimeError):
    """Another writer has committed a version since the one this commit started from."""


@dataclass(frozen=True)
class Part:
    """Written rows of a table that are not yet part of any version."""

    path: str
    schema: dict


@dataclass(frozen=True)
class Snapshot:
    """One version. ``tables`` holds the folders of each table, relative to ``folder``, ``schemas``
    their columns, ``notes`` what writers put down about a table."""

    folder: str
    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table as of this version, partition columns included. Nothing is inferred."""
        schema = StructType.fromJson(self.schemas[table])
        reader = spark.read.option("basePath", f"{self.folder}/{_DATA}/{table}").schema(schema)
        paths = [f"{self.folder}/{part}" for part in self.tables[table]]
        return reader.parquet(*paths).select(*schema.names)


def _name(number: int) -> str:
    return f"{_MANIFESTS}/{number:012d}.json"


def _numbers(files: SharedFolder) -> list[int]:
    names = (name.removesuffix(".json") for name in files.names(_MANIFESTS))
    return [int(name) for name in names if name.isdigit()]


def _load(files: SharedFolder, number: int) -> Snapshot:
    return Snapshot(files.path, number, **json.loads(files.read(_name(number))))


def current(spark: SparkSession, folder: str) -> Snapshot:
    """The latest version; number 0 without tables before the first commit."""
    files = SharedFolder(spark, folder)
    numbers = _numbers(files)
    return _load(files, numbers[-1]) if numbers else Snapshot(files.path)


def write_part(df: DataFrame, folder: str, table: str, partition_by: Iterable[str] = ()) -> Part:
    """Write rows into a new folder of a table."""
    path = f"{_DATA}/{table}/part={uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{folder.rstrip('/')}/{path}")
    return Part(path, df.schema.jsonValue())


def read_part(spark: SparkSession, folder: str, table: str, part: Part) -> DataFrame:
    """Rows that were written but not committed."""
    return Snapshot(folder.rstrip("/"), 0, {table: [part.path]}, {table: part.schema}).read(spark, table)


def commit(
    spark: SparkSession,
    base: Snapshot,
    replaced: dict[str, Part] | None = None,
    appended: dict[str, Part] | None = None,
    notes: dict[str, dict] | None = None,
) -> Snapshot:
    """The next version after ``base``: tables replaced by one written part each, and tables
    with a further part. Everything else stays as in ``base``."""
    replaced, appended = replaced or {}, appended or {}
    tables, schemas = dict(base.tables), dict(base.schemas)
    for name, part in [*replaced.items(), *appended.items()]:
        tables[name] = [part.path] if name in replaced else [*tables.get(name, []), part.path]
        if name in replaced or name not in schemas:
            schemas[name] = part.schema
    kept = {name: note for name, note in base.notes.items() if name not in replaced}
    made = Snapshot(base.folder, base.number + 1, tables, schemas, kept | (notes or {}))
    text = json.dumps({"tables": made.tables, "schemas": made.schemas, "notes": made.notes})
    files = SharedFolder(spark, base.folder)
    later = [n for n in _numbers(files) if n > base.number]
    if later or not files.claim(_name(made.number), text):
        raise Conflict(f"{base.folder}: version {base.number + 1} was committed by another writer")
    return made


def clean_up(spark: SparkSession, folder: str, keep: int = 2, idle_seconds: float = 7 * 86400) -> list[str]:
    """Delete all but the last ``keep`` versions, and parts of no version that were last changed
    more than ``idle_seconds`` ago, left behind by writers that died. Returns the deleted parts.

    Whoever still reads a deleted version fails; keep as many as readers may lag behind.
    """
    files = SharedFolder(spark, folder)
    numbers = _numbers(files)
    snapshots = {n: _load(files, n) for n in numbers}
    kept = {p for n in numbers[-keep:] for parts in snapshots[n].tables.values() for p in parts}
    old = {p for n in numbers[:-keep] for parts in snapshots[n].tables.values() for p in parts} - kept
    for number in numbers[:-keep]:
        files.delete(_name(number))
    found = [f"{_DATA}/{table}/{part}" for table in files.names(_DATA) for part in files.names(f"{_DATA}/{table}")]
    before = time.time() - idle_seconds
    gone = [p for p in found if p in old or (p not in kept and files.modified(p) < before)]
    for part in gone:
        files.delete(part)
    return gone
