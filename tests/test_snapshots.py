"""Versions of tables: all at once or not at all."""

import threading

import pytest
from frames import raw, raw_row
from pyspark.sql import functions as F

from tillwise.operators.cleaning import clean
from tillwise.plans import pipeline, reports
from tillwise.sources import snapshots
from tillwise.sources.shared import SharedFolder
from tillwise.sources.staging import stage


def feed(spark, price=2.0, lines=40):
    rows = [
        raw_row(invoice=str(i), stock=f"S{i % 7}", when=f"{1 + i % 12}/{1 + i % 28}/2020 10:{i % 60:02d}", price=price,
                customer=float(i % 5), country="UK")
        for i in range(lines)
    ]
    return stage(clean(raw(spark, *rows)), "clean")


def held(spark, folder):
    star = pipeline.read_star(spark, folder)
    return reports.kpis(star).first().total_revenue, {n: t.count() for n, t in star.tables().items()}


def test_a_refresh_that_fails_leaves_the_last_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    pipeline.write_star(feed(spark), folder)
    before = held(spark, folder)
    reading = pipeline.read_star(spark, folder).fact
    write = snapshots.write_part
    for failing in range(4):
        calls = []

        def broken(df, folder, table, partition_by=()):
            calls.append(table)
            if len(calls) > failing:
                raise OSError("the disk is gone")
            return write(df, folder, table, partition_by)

        monkeypatch.setattr(pipeline, "write_part", broken)
        with pytest.raises(OSError):
            pipeline.write_star(feed(spark, price=9.0), folder)
        assert held(spark, folder) == before
    monkeypatch.setattr(pipeline, "write_part", write)

    def no_commit(*args, **options):
        raise OSError("the driver is gone")

    monkeypatch.setattr(pipeline, "commit", no_commit)
    with pytest.raises(OSError):
        pipeline.write_star(feed(spark, price=9.0), folder)
    assert held(spark, folder) == before
    monkeypatch.undo()
    pipeline.write_star(feed(spark, price=4.0, lines=50), folder)
    revenue, rows = held(spark, folder)
    assert revenue == 200.0 and rows["fact_sales"] == 50
    assert reading.count() == 40  # whoever reads the old version goes on with it


def test_a_first_build_that_fails_is_built_again(spark, tmp_path, monkeypatch):
    folder, source = str(tmp_path), raw(spark, *[raw_row(invoice=str(i), customer=float(i)) for i in range(9)])
    write, calls = snapshots.write_part, []

    def broken(df, folder, table, partition_by=()):
        calls.append(table)
        if len(calls) == 3:
            raise OSError("the disk is gone")
        return write(df, folder, table, partition_by)

    monkeypatch.setattr(pipeline, "write_part", broken)
    with pytest.raises(OSError):
        pipeline.build_all(spark, source, folder, k=2)
    with pytest.raises(FileNotFoundError):
        pipeline.read_star(spark, folder)
    built = pipeline.build_all(spark, source, folder, k=2)
    assert built.log[0].startswith("star: built") and len(set(calls)) == 4
    assert {r["table_name"]: r["row_count"] for r in built.reports["tables"]}["fact_sales"] == 9


def test_results_belong_to_a_version_of_the_star(spark, tmp_path):
    folder, source = str(tmp_path), raw(spark, *[raw_row(invoice=str(i), customer=float(i)) for i in range(9)])
    pipeline.build_all(spark, source, folder, k=2)
    assert pipeline.build_all(spark, source, folder, k=2).log[:2] == ["star: present", "segments: present"]
    pipeline.write_star(feed(spark), folder)
    again = pipeline.build_all(spark, source, folder, k=2)
    assert again.log[:2] == ["star: present", "segments: built"]
    assert sum(r["customers"] for r in again.reports["segment_sizes"]) == 5


def test_two_writers_from_the_same_version(spark, tmp_path):
    folder = str(tmp_path)
    base = snapshots.current(spark, folder)
    parts = [snapshots.write_part(spark.range(n), folder, "numbers") for n in (3, 4)]
    first = snapshots.commit(spark, base, appended={"numbers": parts[0]})
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, base, appended={"numbers": parts[1]})
    assert snapshots.current(spark, folder) == first
    second = snapshots.commit(spark, first, appended={"numbers": parts[1]})
    assert second.read(spark, "numbers").count() == 7 and first.read(spark, "numbers").count() == 3


def test_partition_columns_keep_their_type(spark, tmp_path):
    rows = spark.range(20).select("id", F.concat(F.lit("2020-0"), F.col("id") % 3 + 1).alias("year_month"))
    part = snapshots.write_part(rows, str(tmp_path), "rows", ("year_month",))
    made = snapshots.commit(spark, snapshots.current(spark, str(tmp_path)), replaced={"rows": part})
    read = made.read(spark, "rows")
    assert read.dtypes == rows.dtypes and sorted(read.collect()) == sorted(rows.collect())


def test_old_versions_and_remains_go(spark, tmp_path):
    folder = str(tmp_path)
    for n in (1, 2, 3):
        part = snapshots.write_part(spark.range(n), folder, "numbers")
        snapshots.commit(spark, snapshots.current(spark, folder), replaced={"numbers": part})
    left_over = snapshots.write_part(spark.range(9), folder, "numbers")
    assert len(snapshots.clean_up(spark, folder, keep=2)) == 1
    assert snapshots.clean_up(spark, folder, keep=2, idle_seconds=-1) == [left_over.path]
    assert snapshots.current(spark, folder).read(spark, "numbers").count() == 3


def test_one_of_many_claims_succeeds(spark, tmp_path):
    won = []

    def run(i):
        if SharedFolder(spark, str(tmp_path)).claim("deep/number", f"writer {i}"):
            won.append(i)

    SharedFolder(spark, str(tmp_path)).claim("deep/other", "")
    threads = [threading.Thread(target=run, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    files = SharedFolder(spark, str(tmp_path))
    assert len(won) == 1 and files.read("deep/number") == f"writer {won[0]}"
    assert files.names("deep") == ["number", "other"]


def test_months_are_pruned(spark, tmp_path):
    pipeline.write_star(feed(spark), str(tmp_path))
    star = pipeline.read_star(spark, str(tmp_path))
    for report in (reports.country_quarter_change(star), reports.country_last_month(star)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year_month" in plan and "year_month#" in plan.split("PartitionFilters")[1][:120]


def test_the_fact_is_written_once_and_numbered(spark, tmp_path):
    cleaned = feed(spark)
    pipeline.write_star(cleaned, str(tmp_path))
    rows = pipeline.read_star(spark, str(tmp_path)).fact.orderBy("line_id").collect()
    assert [r.line_id for r in rows] == list(range(1, 41))
    assert [r.invoice_datetime for r in rows] == sorted(r.invoice_datetime for r in rows)
    assert {r.year_month for r in rows} == {f"2020-{m:02d}" for m in range(1, 13)}
