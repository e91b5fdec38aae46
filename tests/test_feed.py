"""Deliveries appended one by one are the same as all of them cleaned together."""

import random

import pytest
from frames import raw, raw_row
from pyspark.sql import functions as F

from tillwise.operators.cleaning import clean
from tillwise.operators.membership import build_filter, maybe_known
from tillwise.plans import feed
from tillwise.sources import snapshots
from tillwise.sources.staging import new_path, stage


def lines(n, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        k = pick.randrange(n // 2)
        rows.append(raw_row(
            invoice=f"C{k}" if k % 17 == 0 else str(k), stock=None if k % 13 == 0 else f"S{k % 5}",
            text=None if k % 11 == 0 else f"thing {k}", quantity=(k % 7) - 1,
            when="no date" if k % 19 == 0 else f"{1 + k % 12}/{1 + k % 28}/2020 {'0' * (i % 2)}9:00",
            price=0.5 * (k % 9), customer=None if k % 23 == 0 else float(k % 40), country="UK",
        ))
    return rows


def held(df):
    return sorted(map(str, df.collect()))


def test_deliveries_add_up(spark):
    rows = lines(600)
    a, b, c = rows[:300], rows[200:450], rows[400:]
    folder = new_path(spark, "feed")
    for delivery in (a, b, c, b):
        feed.append_feed(spark, raw(spark, *delivery), folder)
    wanted = held(clean(raw(spark, *rows)))
    assert held(feed.read_feed(spark, folder)) == wanted
    feed.merge_filters(spark, folder)
    feed.append_feed(spark, raw(spark, *a), folder)
    assert held(feed.read_feed(spark, folder)) == wanted
    assert feed.read_feed(spark, folder).columns == clean(raw(spark, *rows)).columns


def test_without_broadcast(spark):
    rows, folder = lines(200, seed=2), new_path(spark, "feed")
    for delivery in (rows[:150], rows[50:]):
        feed.append_feed(spark, raw(spark, *delivery), folder, broadcast_lines=0)
    assert held(feed.read_feed(spark, folder)) == held(clean(raw(spark, *rows)))


def test_empty_deliveries(spark):
    folder, row = new_path(spark, "feed"), raw_row()
    for delivery in ([], [row], [], [row]):
        feed.append_feed(spark, raw(spark, *delivery), folder)
    assert feed.read_feed(spark, folder).count() == 1


def test_other_patterns_are_refused(spark):
    folder = new_path(spark, "feed")
    feed.append_feed(spark, raw(spark, raw_row()), folder)
    with pytest.raises(ValueError, match="patterns"):
        feed.append_feed(spark, raw(spark, raw_row()), folder, patterns="d/M/yyyy H:m")


def test_a_delivery_in_between_is_seen(spark, monkeypatch):
    folder, rows = new_path(spark, "feed"), lines(100, seed=3)
    real, others = snapshots.commit, [rows[:60]]

    def late(*args, **options):
        if others:
            delivery = others.pop()
            feed.append_feed(spark, raw(spark, *delivery), folder)
        return real(*args, **options)

    monkeypatch.setattr(feed, "commit", late)
    feed.append_feed(spark, raw(spark, *rows[40:]), folder)
    assert held(feed.read_feed(spark, folder)) == held(clean(raw(spark, *rows)))


def test_stored_lines_are_pruned_and_not_shuffled(spark, monkeypatch):
    folder = new_path(spark, "feed")
    feed.append_feed(spark, raw(spark, *[raw_row(invoice=str(i), when=f"{1 + i % 12}/3/2020 9:00") for i in range(60)]), folder)
    seen = []
    real = feed._known

    def known(*args):
        found = real(*args)
        seen.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(feed, "_known", known)
    feed.append_feed(spark, raw(spark, *[raw_row(invoice=str(i), when=f"{1 + i % 12}/3/2020 9:00") for i in (2, 14, 99)]), folder)
    assert "BroadcastHashJoin" in seen[0] and "SortMergeJoin" not in seen[0]
    pruned = seen[0].split("PartitionFilters: [")[1].split("]")[0]
    assert "year_month" in pruned and "2020-03" in pruned
    assert feed.read_feed(spark, folder).count() == 61


def test_filters_miss_nothing_and_pass_little(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("row"), F.concat(F.lit("2020-0"), F.col("id") % 2 + 1).alias("m"), F.xxhash64("id").alias("h")
    )
    filters = stage(build_filter(rows.where("row < 10000"), "m", "h", "a").unionByName(
        build_filter(rows.where("row >= 18000"), "m", "h", "b")), "filters")
    found = {r.row for r in maybe_known(rows, filters, "m", "h", "row").collect()}
    assert found >= {*range(10_000), *range(18_000, 20_000)}
    assert len(found) - 12_000 < 8_000 * 0.02
    assert filters.where("part_id = 'a'").count() <= 2 * 3
