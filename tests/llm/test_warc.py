import base64
import gzip
from hashlib import sha1
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tillwise.llm import queries, warc

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
LONG = "<p>" + "long text " * 200_000
ROWS = [
    (1, "http://www.Example.com/a b?x=1#top", "<p>one</p>"),
    (2, "https://user@example.com:443/a", "<p>one</p>"),
    (3, None, None),
    (4, "https://example.com:8080", ""),
    (5, "no url at all\r\n", "Ünï ≈ 😀\r\n\r\nHTTP/1.1"),
    (6, "http://b.example.org/x", LONG),
    (None, "http://b.example.org/x", "<p>one</p>"),
    (None, "http://b.example.org/y", "alone"),
    (None, "http://b.example.org/z", "alone"),
    (7, "http://b.example.org/x", "twice"),
    (7, "http://b.example.org/x", "twice"),
    (6, "http://a.example.org/", "same id"),
]


def brute_force(rows, revisit_from=0):
    largest = {}
    for page, _, html in rows:
        key = html or ""
        if page is not None:
            largest[key] = max(page, largest.get(key, page))
    out = []
    for page, _, html in rows:
        data, top = (html or "").encode(), largest.get(html or "")
        revisit = len(data) >= revisit_from and top is not None and page != top
        digest = base64.b32encode(sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("revisit_from", [0, 6])
def test_odd_pages(spark, revisit_from):
    pages = frame(spark, ROWS).withColumns({n: F.lit("x") for n in ("id", "payload", "size", "key", "file", "cold", "same")})
    assert found(warc.archive_pages(pages, revisit_from=revisit_from)) == brute_force(ROWS, revisit_from)


def test_small_files_and_blocks(spark):
    rows = [(i, f"http://h{i % 7}.example.com/{i % 40}", "copy" if i % 3 == 0 else f"page {i % 150}") for i in range(400)]
    pages = frame(spark, rows)
    archive = warc.write_archive(pages, archive_bytes=2000, block_lines=3)
    captures = warc.all_captures(spark, archive)
    assert found(warc.read_records(archive, captures)) == brute_force(rows)
    assert sum(p[3] for p in archive.parts) == 400 and archive.parts == sorted(archive.parts, key=lambda p: p[1:3])

    asked = frame(spark, [(0, u, "") for u in (rows[3][1], rows[3][1] + "#part", rows[10][1].upper().replace("HTTP", "http"), "http://gone/")])
    hits = warc.lookup(archive, asked)
    wanted = [r for u in (rows[3][1], rows[3][1], rows[10][1]) for r in rows if r[1] == u]
    assert sorted(r.page_id for r in hits.collect()) == sorted(r[0] for r in wanted)
    texts = warc.read_records(archive, hits.where("record_type = 'response'"), with_payload=True).collect()
    assert texts and all(bytes(r.payload).decode() == rows[r.page_id][2] for r in texts)


def test_nothing(spark):
    empty = frame(spark, [])
    assert warc.archive_pages(empty).select(*COLUMNS).count() == 0
    archive = warc.write_archive(empty)
    assert warc.lookup(archive, frame(spark, ROWS)).count() == 0


def test_files_are_plain_warc(spark, tmp_path):
    warc.write_archive(frame(spark, ROWS[:5]), str(tmp_path))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "archive").iterdir())
    assert text.count(b"WARC/1.1\r\n") == 5 and text.count(b"WARC-Type: revisit") == 2
    assert "😀\r\n\r\nHTTP/1.1\r\n\r\n".encode() in text


def test_keys():
    assert warc.url_key("http://User@WWW.Example.com:80/A?b#c") == "com,example,www)/A?b"
    assert warc.url_key("https://example.com:8080?q=1 2") == "com,example:8080)/?q=1%202"
    assert warc.url_key(None) == "" and warc.url_key("a\tb") == "a%09b"


def test_a_damaged_record_is_an_error():
    data = warc.record(1, "http://a/", "2020-01-01T00:00:00Z", warc.bare_digest(sha1(b"abc").digest()), 3, b"abc", None)
    assert warc.parse_record(data)["payload"] == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(data.replace(b"abc", b"abd"))


def test_whole_table(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.queries()["op13_warc"](spark, small)) == brute_force(pages)
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{small}/pages.parquet')")
    sql = duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.oracle_sql()['op13_warc']})").fetchall()
    assert sorted(sql, key=str) == brute_force(pages)
