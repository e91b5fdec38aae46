"""Appending under running numbers: several writers, repeated batches, writers that die."""

import threading

import pytest

from tillwise.sources import numbered
from tillwise.sources.staging import new_path


@pytest.fixture
def log(spark):
    path = new_path(spark, "log")
    numbered.create_log(spark.createDataFrame([], "id bigint, text string"), path)
    return path


def rows(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def held(spark, path):
    return [(r.id, r.text) for r in spark.read.parquet(path).orderBy("id").collect()]


def test_batches_are_numbered_on(spark, log):
    assert numbered.append_numbered(rows(spark, "b", "a"), log, ["text"])
    assert numbered.append_numbered(rows(spark), log, ["text"])
    assert numbered.append_numbered(rows(spark, "a"), log, ["text"])
    assert held(spark, log) == [(1, "a"), (2, "b"), (3, "a")]
    numbered.create_log(spark.createDataFrame([], "id bigint, text string"), log)
    assert held(spark, log) == []
    numbered.append_numbered(rows(spark, "x"), log, ["text"])
    assert held(spark, log) == [(1, "x")]


def test_a_repeated_batch_is_there_once(spark, log):
    assert numbered.append_numbered(rows(spark, "a"), log, ["text"], batch="monday")
    assert not numbered.append_numbered(rows(spark, "a"), log, ["text"], batch="monday")
    assert numbered.append_numbered(rows(spark, "a"), log, ["text"], batch="tuesday")
    assert held(spark, log) == [(1, "a"), (2, "a")]


def test_writers_at_the_same_time(spark, log):
    failures = []

    def run(i):
        try:
            numbered.append_numbered(rows(spark, *[f"{i}-{k}" for k in range(3)]), log, ["text"])
        except Exception as failure:
            failures.append(failure)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert failures == []
    found = held(spark, log)
    assert [i for i, _ in found] == list(range(1, 13)) and len({t for _, t in found}) == 12
    for first in range(0, 12, 3):
        assert len({t.split("-")[0] for _, t in found[first : first + 3]}) == 1


def test_the_same_batch_at_the_same_time(spark, log):
    threads = [
        threading.Thread(target=numbered.append_numbered, args=(rows(spark, "a", "b"), log, ["text"], "id", "one"))
        for _ in range(3)
    ]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = held(spark, log)
    assert [t for _, t in found] == ["a", "b"] and found[1][0] == found[0][0] + 1


def test_a_writer_that_dies_leaves_no_rows(spark, log, monkeypatch):
    from tillwise.sources.shared import SharedFolder

    def dies(self, name, to):
        raise OSError("the driver is gone")

    monkeypatch.setattr(SharedFolder, "move", dies)
    with pytest.raises(OSError):
        numbered.append_numbered(rows(spark, "a", "b"), log, ["text"], batch="one")
    monkeypatch.undo()
    assert held(spark, log) == []
    assert numbered.append_numbered(rows(spark, "a", "b"), log, ["text"], batch="one")
    assert [t for _, t in held(spark, log)] == ["a", "b"]
