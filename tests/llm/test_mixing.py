from collections import defaultdict

import duckdb

from tillwise.llm import mixing
from tillwise.llm.queries import MIXING_SQL


def by_source(docs):
    mixed = {(r.doc_id, r.size): r for r in mixing.mix(docs).collect()}
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.source].append(mixed[r.doc_id, len((r.text or "").encode().split())])
    return groups


def test_equals_sql(spark, small):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = mixing.mix(spark.read.parquet(f"{small}/documents.parquet")).drop("copies").collect()
    assert sorted(map(tuple, found)) == sorted(connection.sql(MIXING_SQL).fetchall())


def test_targets_and_limits(odd, nothing, clashing):
    groups = by_source(odd)
    sizes = {s: sum(r.size for r in rows) for s, rows in groups.items()}
    budget = 1.5 * sum(sizes.values())
    for source, rows in groups.items():
        assert all(r.source_size == sizes[source] for r in rows)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)
        assert rows[0].target <= 2 * sizes[source]
    assert abs(sum(rows[0].target for rows in groups.values()) - budget) < 1e-6
    assert mixing.mix(nothing).collect() == []
    assert mixing.mix(clashing).count() == odd.count()


def test_reruns_and_layout_agree(odd):
    first = sorted(map(str, mixing.mix(odd).collect()))
    assert first == sorted(map(str, mixing.mix(odd.repartition(7)).collect()))


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [(r.size, r.taken, r.target) for r in mixing.mix(docs).collect()] == [(0, 0, 0.0)] * 2


def test_documents_as_often_as_taken(clashing):
    copies = sum(r.copies for r in mixing.mix(clashing).collect())
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns and abs(mixed.count() - copies) <= 4
