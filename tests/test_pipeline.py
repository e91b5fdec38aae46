"""From a CSV in latin-1 to stored tables and back."""

import csv
import random
from datetime import datetime, timedelta

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from tillwise.plans import pipeline, reports
from tillwise.plans.forecast import fit_linear
from tillwise.sources.files import read_forecast, read_raw_csv, read_segments

HEADERS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "raw.csv"
    pick = random.Random(1)
    start = datetime(2010, 1, 1)
    with open(path, "w", encoding="latin1", newline="") as file:
        out = csv.writer(file)
        out.writerow(HEADERS)
        for i in range(600):
            when = start + timedelta(hours=pick.randrange(24 * 200))
            customer = "" if i % 30 == 0 else f"{pick.randrange(40)}.0"
            out.writerow([
                f"C{i}" if i % 50 == 0 else i, 10000 + i % 12, "CAFÉ, BLUE", pick.randint(1, 9),
                f"{when.month}/{when.day}/{when.year} {when.hour}:{when.minute:02d}", f"{pick.randint(1, 999) / 100}",
                customer, "España",
            ])
    return str(path)


def test_feed_is_read_with_declared_types(spark, feed):
    raw = read_raw_csv(spark, feed)
    assert raw.columns == ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                           "CustomerID", "Country", "_corrupt_record"]
    assert dict(raw.dtypes)["StockCode"] == "string" and dict(raw.dtypes)["CustomerID"] == "double"
    row = raw.first()
    assert (row.Description, row.Country) == ("CAFÉ, BLUE", "España")


def test_build_all_and_rebuild(spark, feed, tmp_path):
    folder = str(tmp_path / "tables")
    first = pipeline.build_all(spark, feed, folder, model=fit_linear, k=3)
    assert first.log[0].startswith("star: built from") and first.log[1:] == ["segments: built", "forecast: built"]
    assert first.cleaned["rows_before"] == 600 and first.cleaned["corrupt"] == 0
    star = pipeline.read_star(spark, folder)
    assert star.fact.agg({"line_id": "max"}).first()[0] == star.fact.count()
    assert "year_month" in star.fact.columns
    assert reports.kpis(star).first().total_orders > 500
    segments = read_segments(spark, f"{folder}/customer_segments.csv")
    assert segments.count() == star.customers.count()
    assert sorted(map(tuple, segments.collect())) == sorted(map(tuple, spark.read.parquet(f"{folder}/segments").collect()))
    forecast = read_forecast(spark, f"{folder}/forecast.csv")
    assert forecast.where("actual IS NULL").count() == 90
    assert pipeline.build_all(spark, feed, folder).log == [
        "star: present", "segments: present", "forecast: present",
    ]


def test_refresh_keeps_the_audit_log(spark, feed, tmp_path):
    from tillwise.operators.cleaning import clean
    from tillwise.plans.guard import append_history

    folder = str(tmp_path / "tables")
    cleaned = clean(read_raw_csv(spark, feed))
    pipeline.write_star(cleaned, folder)
    entry = spark.sql(
        "SELECT TIMESTAMP_NTZ '2020-01-01' AS asked_at, 'q' AS user_question, 's' AS sql_generated, "
        "1L AS row_count, '' AS ai_insight, 'success' AS status, '' AS error_message"
    )
    append_history(entry, f"{folder}/query_history")
    pipeline.write_star(cleaned, folder)
    assert spark.read.parquet(f"{folder}/query_history").count() == 1
    pipeline.write_star(cleaned, folder, reset_audit=True)
    assert spark.read.parquet(f"{folder}/query_history").count() == 0


def test_a_failing_forecast_is_not_fatal(spark, feed, tmp_path):
    def broken(series, keys):
        raise PySparkException("no model here")

    log = pipeline.build_all(spark, feed, str(tmp_path / "tables"), model=broken, k=2).log
    assert log[0].startswith("star: built") and log[1] == "segments: built" and "no model here" in log[2]


def test_quotes_and_missing_cells_read_like_pandas(spark, tmp_path):
    import pandas as pd

    path = str(tmp_path / "odd.csv")
    with open(path, "w", encoding="latin1") as file:
        file.write(",".join(HEADERS) + "\n")
        file.write('1,A,"SET ""RED"", 6",1,1/2/2010 8:00,1.5,7,UK\n')
        file.write('2,B,"",1,1/2/2010 8:00,1.5,,NA\n')
        file.write("3,C, padded ,x,1/2/2010 8:00,NA,7.0,null\n")
    ours = read_raw_csv(spark, path).collect()
    theirs = pd.read_csv(path, encoding="latin1")
    for row, (_, expected) in zip(ours, theirs.iterrows()):
        for name, alias in (("Description", "Description"), ("Country", "Country"), ("CustomerID", "Customer ID")):
            value = expected[alias]
            assert row[name] == (None if pd.isna(value) else value)
    assert ours[2].Quantity is None and ours[2].UnitPrice is None


LINE = '1,A,"{text}",3,12/1/2010 8:26,2.5,7.0,France'


def write_feed(path, *lines, header=",".join(HEADERS)):
    path.write_text("\n".join([header, *lines]) + "\n", encoding="latin1")


def test_line_breaks_in_quotes(spark, tmp_path):
    write_feed(tmp_path / "raw.csv", LINE.format(text="two\nlines"), LINE.format(text="one"))
    rows = read_raw_csv(spark, str(tmp_path / "raw.csv"), multi_line=True).collect()
    assert sorted(r.Description for r in rows) == ["one", "two\nlines"]


def test_unreadable_records_are_counted(spark, tmp_path):
    from tillwise.operators.cleaning import clean_report

    write_feed(tmp_path / "raw.csv", LINE.format(text="x"), "2,B,y,many,12/1/2010 8:26,2.5,7.0,France", "3,C")
    report = clean_report(read_raw_csv(spark, str(tmp_path / "raw.csv"))).first()
    assert (report.rows_before, report.rows_after, report.corrupt) == (3, 1, 2)


def test_files_with_differing_headers_are_refused(spark, tmp_path):
    write_feed(tmp_path / "a.csv", LINE.format(text="x"))
    other = [*HEADERS[:3], HEADERS[5], HEADERS[4], HEADERS[3], *HEADERS[6:]]
    write_feed(tmp_path / "b.csv", "1,A,x,2.5,12/1/2010 8:26,3,7.0,France", header=",".join(other))
    with pytest.raises((PySparkException, Py4JError), match="header"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_a_feed_of_unreadable_dates_is_refused(spark, tmp_path):
    write_feed(tmp_path / "raw.csv", *[LINE.format(text=i).replace("12/1/2010 8:26", f"day {i}") for i in range(4)])
    with pytest.raises(ValueError, match="4 of 4 dates"):
        pipeline.build_all(spark, str(tmp_path / "raw.csv"), str(tmp_path / "tables"))
