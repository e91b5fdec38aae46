import xxhash
from pyspark.sql import functions as F

from tillwise.llm import simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(rows):
    """Component of each (id, fingerprint) by comparing all pairs."""
    prints = sorted({p for _, p in rows})
    group = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    least = {}
    for doc, p in rows:
        if doc is not None:
            least[group[p]] = min(doc, least.get(group[p], doc))
    return sorted(((d, f"{p:016x}", least.get(group[p])) for d, p in rows), key=str)


def test_equals_brute_force(spark, odd, clashing, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*odd.columns)
    for frame in (odd, clashing, docs):
        rows = [(r.doc_id, slow_print(r.text)) for r in frame.select("doc_id", "text").collect()]
        found = simhash.near_duplicates(frame).collect()
        assert sorted(map(tuple, found), key=str) == slow_classes(rows)


def test_no_rows(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.keep_one(nothing).collect() == []


def test_one_of_each_group_stays(clashing):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    classes = {r.component_id for r in simhash.near_duplicates(clashing).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(c for c in classes if c is not None)
    assert 2 not in ids and 1 in ids


def test_chain_of_fingerprints(spark):
    prints = spark.createDataFrame([(0,), (3,), (15,), (63,), (-1,), (-4,)], "fp bigint")
    for bits, expected in ((2, {(0, 3), (3, 15), (15, 63), (-4, -1)}), (1, set()), (3, None), (4, None)):
        found = simhash.links(prints, bits).collect()
        assert all((a ^ b).bit_count() <= bits for a, b in ((r.a & 2**64 - 1, r.b & 2**64 - 1) for r in found))
        if expected is not None:
            assert {tuple(sorted(r)) for r in found} == expected


def test_links_do_not_grow_with_the_square(spark):
    """Many fingerprints around one value: a key holds no more than a ball."""
    near = [((1 << i) | (1 << j),) for i in range(40) for j in range(i)]
    prints = spark.createDataFrame([(0,), *near], "fp bigint")
    assert simhash.links(prints).count() <= 66 * len(near)
    assert simhash.links(prints).select(F.col("a")).distinct().count() == len(near)
