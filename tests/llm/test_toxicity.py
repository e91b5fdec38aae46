import math
import zlib

import numpy as np
from hypothesis import given, settings as limits, strategies as st

from tillwise.llm import toxicity


def slow_segments(values):
    """The best stretch, then the same to its left and right."""

    def inside(low, high):
        best, where = 0.0, None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += values[j]
                if total > best + 1e-9:
                    best, where = total, (i, j + 1)
        if where is None:
            return []
        return [*inside(low, where[0]), (*where, best), *inside(where[1], high)]

    return inside(0, len(values))


@limits(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.13, -1.029, -0.571, 1.017, 2.071, 0.3331]), max_size=25))
def test_maximal_segments(values):
    found = toxicity.maximal_segments(np.array(values, float))
    slow = slow_segments(values)
    assert [s[:2] for s in found] == [s[:2] for s in slow]
    assert all(math.isclose(a[2], b[2]) for a, b in zip(found, slow, strict=True))


def test_rate_solves_its_equation():
    values, shares = np.array([-1.0, 2.0]), np.array([0.9, 0.1])
    rate = toxicity.solve_rate(values, shares)
    assert abs(np.dot(shares, np.exp(rate * values)) - 1) < 1e-9 and rate > 0
    assert toxicity.solve_rate(np.array([-1.0]), np.array([1.0])) == 0.0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxic_passages(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.toxic for r in held) / len(held)
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    assert right > 0.97 and caught > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark, small):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(str, toxicity.toxic_passages(docs, x).collect())) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_odd_documents(spark, clashing, nothing):
    labels = spark.createDataFrame([(1, 0), (9, 0), (3, 1), (None, 1), (7, None)], "doc_id bigint, toxic int")
    found = toxicity.toxic_passages(clashing, labels).collect()
    assert len(found) == clashing.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxic_passages(nothing, labels).collect() == []
    assert all(r.predicted == 0 for r in toxicity.toxic_passages(clashing, labels.where("false")).collect())


def test_all_segments_count():
    """More than fifty segments above chance in one text, and none below it."""
    rate, size, words = 1.0, 0.1, 10_000
    tails = [toxicity._tail([9.0] * n, words, rate, size) for n in (1, 40, 50, 60, 200)]
    assert tails == sorted(tails) and len(set(tails)) == 5
    assert toxicity._tail([9.0] * 60 + [1.0] * 500, words, rate, size) == tails[3]
    assert toxicity._tail([], words, rate, size) == 0.0
