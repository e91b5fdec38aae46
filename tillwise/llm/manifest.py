"""Merkle manifest of a dataset: a digest per row, a root per group, a root of all, and proofs.

Every group's rows form a tree of arity three over their digests, the group roots form another.
A tree is stored as aligned blocks of ``BLOCK_HEIGHT`` levels, one table row each. Inside a
block the nodes lie in van Emde Boas order: the tree is split at half its height, the upper
part comes first, then the lower parts one after the other, each laid out the same way. The
roots of the blocks of one storey are the leaves of the next, until a tree has one block.

Building goes up storey by storey and proofs come down again, so every step is a grouping or a
join on (tree, block) with rows of a bounded size, whatever share of the rows a group has.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillwise.llm.common import Scratch

ARITY = 3
# Levels of nodes above the leaves of a full block: 3^6 = 729 leaves.
BLOCK_HEIGHT = 6
# Fields in the order in which they enter a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_DIGEST = 32
_ROW_BITS = 33


# --- address arithmetic of one block ------------------------------------------


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while leaves > 1:
        leaves = -(-leaves // ARITY)
        height += 1
    return height


@lru_cache(maxsize=512)
def addresses(leaves: int, height: int) -> tuple[np.ndarray, ...]:
    """The places of all nodes of a block, an array for each level from the leaves up.

    ``leaves`` is at most 3^height; on the right the tree is as ragged as its leaves, so a
    block with few leaves takes little space.
    """
    if height == 0:
        return (np.zeros(1, np.int64),)
    storeys = (height + 1) // 2  # levels of the lower parts
    upper = addresses(-(-leaves // ARITY**storeys), height - storeys)
    start = sum(len(level) for level in upper)
    width = ARITY ** (storeys - 1)  # leaves of a full lower part
    size = (ARITY**storeys - 1) // (ARITY - 1)
    full, rest = divmod(leaves, width)
    whole = addresses(width, storeys - 1)
    part = addresses(rest, storeys - 1) if rest else None
    lower = []
    for level in range(storeys):
        places = (start + size * np.arange(full)[:, None] + whole[level]).ravel()
        if part:
            places = np.concatenate([places, start + size * full + part[level]])
        lower.append(places)
    return (*lower, *upper)


def build_block(leaves: Sequence[bytes], height: int) -> bytes:
    """All nodes of a block in van Emde Boas order; the root is the first."""
    places = addresses(len(leaves), height)
    nodes = bytearray(_DIGEST * sum(len(level) for level in places))

    def put(level: int, digests: Sequence[bytes]) -> None:
        for at, digest in zip((places[level] * _DIGEST).tolist(), digests, strict=True):
            nodes[at : at + _DIGEST] = digest

    put(0, leaves)
    for level in range(height):
        at = (places[level] * _DIGEST).tolist()
        below = [nodes[a : a + _DIGEST].hex() for a in at]
        put(
            level + 1,
            [sha256("".join(below[i : i + ARITY]).encode()).digest() for i in range(0, len(below), ARITY)],
        )
    return bytes(nodes)


def siblings_in_block(nodes: bytes, leaves: int, height: int) -> list[tuple[list[str], list[str]]]:
    """For each leaf, level by level, the hexadecimal digests of its run before and after it.

    The lists run from the leaf's level to the one below the block's root.
    """
    levels = []
    for at in addresses(leaves, height)[:height]:
        digests = [nodes[a : a + _DIGEST].hex() for a in (at * _DIGEST).tolist()]
        sides = []
        for i in range(len(digests)):
            first = i - i % ARITY
            sides.append(("".join(digests[first:i]), "".join(digests[i + 1 : first + ARITY])))
        levels.append(sides)
    found = []
    for leaf in range(leaves):
        before, after, at = [], [], leaf
        for sides in levels:
            before.append(sides[at][0])
            after.append(sides[at][1])
            at //= ARITY
        found.append((before, after))
    return found


def fold(leaf: str, before: Sequence[str], after: Sequence[str]) -> str:
    """The root that a leaf and the digests beside its path lead to."""
    for left, right in zip(before, after, strict=True):
        leaf = sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def proof_digest(before: Sequence[str], after: Sequence[str]) -> str:
    """SHA-256 of all digests beside a path, level by level, left to right."""
    digest = sha256()
    for left, right in zip(before, after, strict=True):
        digest.update(f"{left}{right}".encode())
    return digest.hexdigest()


# --- leaves ----------------------------------------------------------------------


def row_digest(*values: Column | str) -> Column:
    """SHA-256 of the values, each its UTF-8 length, a colon and itself, or ``-`` if null."""
    parts = []
    for value in values:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _group_key(group: str) -> Column:
    """A text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))


def _placed(rows: DataFrame, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """Adds ``index``, the row's place in its tree, and ``total``, the tree's rows.

    The rows are sorted over all tasks by tree and ``order`` and written with their slice of
    the sort; what is added up afterwards is one count per slice and tree, so a tree with a
    large share of the rows is spread over as many slices as the sort makes of it.
    """
    tagged = rows.orderBy("tree", *order).withColumn("tag", F.monotonically_increasing_id())
    tagged = scratch.save(tagged, name)
    tagged = tagged.withColumn("slice", F.shiftright("tag", _ROW_BITS))
    place = F.col("tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    pieces = tagged.groupBy("slice", "tree").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    earlier = Window.partitionBy("tree").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "slice",
        "tree",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    index = (place + F.col("shift")).alias("index")
    return tagged.join(pieces, ["slice", "tree"]).select(*rows.columns, index, "total")


# --- storeys ---------------------------------------------------------------------

_NODES = "n int, height int, root binary, nodes binary"


def _built(blocks: DataFrame, highest: int) -> DataFrame:
    """Adds the nodes of each block to rows with ``leaves`` and ``total``."""
    kept = [c for c in blocks.columns if c != "leaves"]
    schema = ", ".join([*(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in kept), _NODES])
    width = ARITY**highest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {"n": [], "height": [], "root": [], "nodes": []}
            totals = batch.column("total").to_pylist()
            for leaves, total in zip(batch.column("leaves").to_pylist(), totals, strict=True):
                height = highest if total > width else height_of(total)
                nodes = build_block(leaves, height)
                for name, value in zip(made, (len(leaves), height, nodes[:_DIGEST], nodes), strict=True):
                    made[name].append(value)
            added = [
                pa.array(made["n"], pa.int32()), pa.array(made["height"], pa.int32()),
                pa.array(made["root"], pa.binary()), pa.array(made["nodes"], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], [*kept, *made])

    return blocks.mapInArrow(run, schema)


def _blocks(leaves: DataFrame, highest: int, *carried: str) -> DataFrame:
    """Leaves (tree, index, digest, total) gathered into blocks, built."""
    width = ARITY**highest
    block = F.floor(F.col("index") / F.lit(width)).cast("bigint")
    rows = F.sort_array(F.collect_list(F.struct("index", "digest", *carried)))
    gathered = leaves.groupBy("tree", block.alias("block")).agg(F.any_value("total").alias("total"), rows.alias("rows"))
    gathered = gathered.withColumn("leaves", F.transform("rows", lambda r: r["digest"]))
    return _built(gathered if carried else gathered.drop("rows"), highest)


def _storeys(
    leaves: DataFrame, most: int, highest: int, scratch: Scratch, name: str, *carried: str
) -> list[DataFrame]:
    """The block tables of all trees from the leaves up; ``most``: leaves of the largest tree."""
    width, storeys = ARITY**highest, []
    while True:
        storeys.append(scratch.save(_blocks(leaves, highest, *carried), f"{name}{len(storeys)}"))
        if most <= width:
            return storeys
        carried = ()
        most = -(-most // width)
        total = F.ceil(F.col("total") / F.lit(width)).cast("bigint").alias("total")
        leaves = storeys[-1].where(F.col("total") > width).select(
            "tree", F.col("block").alias("index"), F.col("root").alias("digest"), total
        )


def _tops(storeys: list[DataFrame], width: int) -> DataFrame:
    """The root of every tree: its topmost block is alone in its storey."""
    tops = None
    for storey in storeys:
        top = storey.where(F.col("total") <= width).select("tree", "root")
        tops = top if tops is None else tops.unionByName(top)
    return tops


_PATH = "tree string, index bigint, subroot string, before array<string>, after array<string>"
_PATH_ARROW = pa.schema(
    [
        ("tree", pa.string()), ("index", pa.int64()), ("subroot", pa.string()),
        ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
    ]
)


def _leaf_paths(blocks: DataFrame, width: int) -> DataFrame:
    """From blocks with the path above them to the path above each of their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for i, (before, after) in enumerate(siblings_in_block(row["nodes"], row["n"], row["height"])):
                    above = (before + row["before"], after + row["after"])
                    rows.append((row["tree"], row["block"] * width + i, row["subroot"], *above))
                columns = zip(zip(*rows, strict=True), _PATH_ARROW.types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], schema=_PATH_ARROW)

    return blocks.mapInArrow(run, _PATH)


def _above(
    storeys: list[DataFrame], at: int, width: int, tops: DataFrame | None, lower: DataFrame | None
) -> DataFrame:
    """The blocks of a storey with the path above each: of the tree's root, or of the leaf of
    the next storey that the block's root is. Without ``tops`` nothing is above the roots."""
    topmost = storeys[at].where(F.col("total") <= width)
    if tops is None:
        nothing = F.array().cast("array<string>")
        topmost = topmost.select("*", F.lit("").alias("subroot"), nothing.alias("before"), nothing.alias("after"))
    else:
        topmost = topmost.join(tops, "tree")
    if lower is None:
        return topmost
    inner = storeys[at].where(F.col("total") > width).join(
        lower.withColumnRenamed("index", "block"), ["tree", "block"]
    )
    return topmost.unionByName(inner)


@dataclass(frozen=True)
class Manifest:
    """``root`` in hexadecimal. ``storeys`` are the block tables of the group
    trees, ``crown`` those of the tree of group roots: tree, block, total (leaves of the tree
    in this storey), n (leaves of the block), height, root, nodes. The rows of the first storey
    also hold the rows' id, leaf and claimed leaf."""

    root: str
    storeys: list[DataFrame]
    crown: list[DataFrame]
    block_height: int
    scratch: Scratch


def build_manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group_column: str = "source",
    fields: Sequence[str] = FIELDS,
    claimed: Column | None = None,
    block_height: int = BLOCK_HEIGHT,
) -> Manifest | None:
    """Writes the trees of all rows and returns where they are.

    Rows of a group ascend by id, a missing id first; rows with the same id by their leaf, and
    rows that are equal in every field are leaves of their own. A missing group is a group that
    comes first. Null fields count as ``-``, empty ones as ``0:``; columns beyond ``fields`` have
    no part in it. ``claimed`` is a leaf to hold against the proofs in place of the row's own.
    Without rows there is no manifest.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    leaf = row_digest(*fields)
    rows = docs.select(
        _group_key(group_column).alias("tree"),
        F.col(id_column).alias("id"),
        F.unhex(leaf).alias("digest"),
        F.unhex(F.coalesce(claimed if claimed is not None else leaf, leaf)).alias("claimed"),
    )
    rows = scratch.save(rows, "leaves")
    placed = scratch.save(_placed(rows, ("id", "digest", "claimed"), scratch, "sorted"), "placed")
    scratch.drop("leaves", "sorted")
    most = placed.agg(F.max("total")).first()[0]
    if most is None:
        return None
    storeys = _storeys(placed, most, block_height, scratch, "storey", "id", "claimed")

    tops = scratch.save(_tops(storeys, ARITY**block_height), "tops")
    group_roots = tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("digest"))
    placed_groups = scratch.save(_placed(group_roots, ("group",), scratch, "sorted_groups"), "groups")
    crown = _storeys(placed_groups, placed_groups.count(), block_height, scratch, "crown", "group")
    root = _tops(crown, ARITY**block_height).first()["root"].hex()
    scratch.release()
    return Manifest(root, storeys, crown, block_height, scratch)


def prove(manifest: Manifest) -> DataFrame:
    """One row per row of the manifest: ``id``, ``leaf``, ``subroot``, ``root``, ``before`` and
    ``after`` (digests beside the path, a text for each level), ``proof_sha256``, ``folded_root``
    (from the claimed leaf) and ``verified``."""
    scratch, width = manifest.scratch, ARITY**manifest.block_height

    # Down the tree of group roots: each of its leaves is the root of a group's tree.
    paths = None
    for at in reversed(range(1, len(manifest.crown))):
        above = _above(manifest.crown, at, width, None, paths)
        paths = scratch.save(_leaf_paths(above, width), f"crown_paths{at}")
    above = _above(manifest.crown, 0, width, None, paths)

    def group_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = siblings_in_block(row["nodes"], row["n"], row["height"])
                named = pa.schema([f for f in _PATH_ARROW if f.name != "index"])
                columns = [
                    pa.array([r["group"] for r in row["rows"]], pa.string()),
                    pa.array([r["digest"].hex() for r in row["rows"]], pa.string()),
                    pa.array([before + row["before"] for before, _ in found], pa.list_(pa.string())),
                    pa.array([after + row["after"] for _, after in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=named)

    schema = "tree string, subroot string, before array<string>, after array<string>"
    tops = scratch.save(above.mapInArrow(group_paths, schema), "group_paths")

    # Down the group trees to the rows.
    paths = None
    for at in reversed(range(1, len(manifest.storeys))):
        above = _above(manifest.storeys, at, width, tops, paths)
        paths = scratch.save(_leaf_paths(above, width), f"paths{at}")
    above = _above(manifest.storeys, 0, width, tops, paths)
    root = manifest.root

    def row_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = siblings_in_block(row["nodes"], row["n"], row["height"])
                made = {name: [] for name in out.names}
                for own, (before, after) in zip(row["rows"], found, strict=True):
                    before, after = before + row["before"], after + row["after"]
                    folded = fold(own["claimed"].hex(), before, after)
                    values = (
                        own["id"], own["digest"].hex(), row["subroot"], root, before, after,
                        proof_digest(before, after), folded, folded == root,
                    )
                    for name, value in zip(out.names, values, strict=True):
                        made[name].append(value)
                yield pa.RecordBatch.from_pydict(made, out)

    id_field = manifest.storeys[0].schema["rows"].dataType.elementType["id"]
    texts = pa.list_(pa.string())
    out = pa.schema(
        [
            ("id", to_arrow_type(id_field.dataType)), ("leaf", pa.string()), ("subroot", pa.string()),
            ("root", pa.string()), ("before", texts), ("after", texts), ("proof_sha256", pa.string()),
            ("folded_root", pa.string()), ("verified", pa.bool_()),
        ]
    )
    returned = (
        f"id {id_field.dataType.simpleString()}, leaf string, subroot string, root string, before array<string>, "
        "after array<string>, proof_sha256 string, folded_root string, verified boolean"
    )
    return above.mapInArrow(row_proofs, returned)


def tampered_leaf(id_column: str = "doc_id", text_column: str = "text", fields: Sequence[str] = FIELDS) -> Column:
    """The leaf of a row whose text lost its line feeds, where 2 divides the CRC-32 of the id;
    the row's own leaf otherwise and for rows without an id."""
    struck = F.crc32(F.col(id_column).cast("string")) % 2 == 0
    text = F.when(struck, F.replace(text_column, F.lit("\n"), F.lit(""))).otherwise(F.col(text_column))
    return row_digest(*(text if f == text_column else f for f in fields))


def audit(docs: DataFrame, block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """Proofs of all documents against tampered texts, one row per document.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. A lone document
    of a source is its subroot; a lone source's subroot is the root, and the proof of a tree of one
    leaf is the digest of nothing. Documents without an id are never tampered with. No documents,
    no rows.
    """
    manifest = build_manifest(docs, claimed=tampered_leaf(), block_height=block_height)
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    if manifest is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        columns = [f"doc_id {kind}", *(f"{n} string" for n in names), "verified boolean"]
        return docs.sparkSession.createDataFrame([], ", ".join(columns))
    return prove(manifest).select(F.col("id").alias("doc_id"), *names, "verified")
