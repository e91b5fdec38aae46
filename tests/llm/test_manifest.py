from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import manifest


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text=None):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"] if text is None else text)
    texts = [None if v is None else str(v) for v in values]
    return digest("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def tree(leaves):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def path(levels, at):
    """Digests before and after the path, by level."""
    found = []
    for level in levels[:-1]:
        first = at - at % 3
        found.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return found


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"], leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: None for s in names}
    for s in names:
        groups[s].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
        trees[s] = tree([r[2] for r in groups[s]])
    crown = tree([trees[s][-1][0] for s in names])
    root = crown[-1][0]
    out = []
    for at, s in enumerate(names):
        for i, (_, doc_id, own, row) in enumerate(groups[s]):
            beside = path(trees[s], i) + path(crown, at)
            proof = digest("".join("".join(a + b) for a, b in beside))
            node = own
            if doc_id is not None and crc32(str(doc_id).encode()) % 2 == 0 and row["text"] is not None:
                node = leaf(row, row["text"].replace("\n", ""))
            for before, after in beside:
                node = digest("".join(before) + node + "".join(after))
            out.append((doc_id, own, trees[s][-1][0], root, proof, node, node == root))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_odd_documents(odd):
    rows = odd.collect()
    assert ordered(manifest.audit(odd).collect()) == ordered(brute_force([r.asDict() for r in rows]))


def test_clashing_columns(clashing):
    clash = clashing.withColumns({n: F.lit("x") for n in ("leaf", "root", "tree", "index", "digest", "total", "block")})
    found = manifest.audit(clash)
    assert found.columns == list(COLUMNS) and found.count() == clash.count()


def test_nothing(nothing):
    found = manifest.audit(nothing)
    assert found.columns == list(COLUMNS) and found.count() == 0


@pytest.mark.parametrize("height", [1, 2, 6])
def test_whole_table(spark, small, height):
    """Blocks of few levels make several storeys, for documents and for sources."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = manifest.audit(docs, block_height=height).collect()
    assert ordered(found) == ordered(brute_force([r.asDict() for r in docs.collect()]))
    assert {r.verified for r in found} == {True, False}


def test_many_sources_and_a_hot_one(spark):
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 97))
    docs = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("a\n"), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        source.alias("source"), F.lit(3).cast("bigint").alias("n_chars"),
    )
    assert ordered(manifest.audit(docs, block_height=2).collect()) == ordered(brute_force([r.asDict() for r in docs.collect()]))


@pytest.mark.parametrize("height", range(8))
def test_layout_holds_each_node_once(height):
    for leaves in sorted({1, 2, 3, 4, 3**height // 2, 3**height - 1, 3**height}):
        if not 1 <= leaves <= 3**height:
            continue
        places = manifest.addresses(leaves, height)
        assert [len(level) for level in places] == [-(-leaves // 3**k) for k in range(height + 1)]
        assert sorted(np.concatenate(places)) == list(range(sum(map(len, places))))
        assert places[-1][0] == 0


def test_layout_keeps_subtrees_together():
    """A tree of four levels: two upper levels in front, then nine lower parts of four nodes."""
    places = manifest.addresses(27, 3)
    assert sorted([*places[3], *places[2]]) == [0, 1, 2, 3]
    assert [places[1][i] for i in range(3)] == [4, 8, 12]
    assert [list(places[0][3 * i : 3 * i + 3]) for i in range(2)] == [[5, 6, 7], [9, 10, 11]]


def test_a_proof_needs_only_its_digests(odd):
    made = manifest.build_manifest(odd)
    for row in manifest.prove(made).collect():
        assert row.verified and manifest.fold(row.leaf, row.before, row.after) == made.root
        assert manifest.fold("0" * 64, row.before, row.after) != made.root
