"""CSV records with line breaks inside quotes, cut by many tasks."""

import csv
import io
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException

from tillwise.sources.files import read_raw_csv
from tillwise.sources.records import records, running_states

HEADERS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]


@pytest.fixture
def pieces(settings):
    """Pieces of a few lines."""
    settings(files__maxPartitionBytes=3000, files__openCostInBytes=0)


def write(path, rows, ending="\r\n"):
    text = io.StringIO()
    csv.writer(text, lineterminator=ending).writerows(rows)
    path.write_text(text.getvalue(), encoding="latin1", newline="")
    return text.getvalue()


def feed(n, seed):
    pick = random.Random(seed)
    texts = ["RED, 6\" LAMP", "two\nlines", "\n\n\"quoted\"\n", "CAFÉ", "tail\r\nx", "x" * 200, "\"", ",\n,", " padded "]
    for i in range(n):
        customer = "" if i % 30 == 0 else f"{pick.randrange(40)}.0"
        yield [f"{i}", f"S{i % 12}", pick.choice(texts), pick.randint(1, 9), f"12/{1 + i % 28}/2010 8:26",
               f"{pick.randint(1, 999) / 100}", customer, pick.choice(["España", "UK\nwest"])]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_like_pandas(spark, pieces, tmp_path, ending):
    write(tmp_path / "raw.csv", [HEADERS, *feed(2000, 1)], ending)
    found = read_raw_csv(spark, str(tmp_path / "raw.csv"), multi_line=True)
    assert records(spark, str(tmp_path / "raw.csv")).rdd.getNumPartitions() > 20
    theirs = pd.read_csv(tmp_path / "raw.csv", encoding="latin1", dtype={"Invoice": str})
    theirs = [tuple(None if pd.isna(v) else v for v in row) for row in theirs.itertuples(index=False)]
    ours = [tuple(r)[:8] for r in found.collect()]
    assert sorted(ours, key=str) == sorted(theirs, key=str)
    assert found.where("_corrupt_record IS NOT NULL").count() == 0


def test_several_files_and_a_long_record(spark, pieces, tmp_path):
    rows = [list(feed(50, i)) for i in range(3)]
    rows[1][7][2] = "long\n" * 2500  # over several pieces
    for i, own in enumerate(rows):
        write(tmp_path / f"{i}.csv", [HEADERS, *own])
    found = read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert len(found) == 150 and "long\n" * 2500 in {r.Description for r in found}


def test_faults(spark, pieces, tmp_path):
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "raw.csv").write_text(",".join(HEADERS) + '\n1,A,"never closed,1\n' + "2,B,x,1\n" * 50)
    with pytest.raises(ValueError, match="ends inside quotes"):
        read_raw_csv(spark, str(tmp_path / "open"), multi_line=True)
    (tmp_path / "open" / "raw.csv").write_text(",".join(HEADERS) + '\n1,A,"never closed,1\n' + "2,B,x,1\n" * 8000)
    with pytest.raises(ValueError, match="is not closed"):
        read_raw_csv(spark, str(tmp_path / "open"), multi_line=True)
    (tmp_path / "two").mkdir()
    write(tmp_path / "two" / "a.csv", [HEADERS, *feed(3, 1)])
    write(tmp_path / "two" / "b.csv", [HEADERS[::-1], *feed(3, 1)])
    with pytest.raises(PySparkException, match="header"):
        read_raw_csv(spark, str(tmp_path / "two"), multi_line=True).collect()


def test_blank_lines_and_stray_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h,i\n\n  \n5" pipe,x\n"a"b"c,"d\n\n"\nlast,""')
    assert sorted(r.record for r in records(spark, str(tmp_path / "a.csv")).collect()) == sorted(
        ["h,i", '5" pipe,x', '"a"b"c,"d\n\n"', 'last,""']
    )
    (tmp_path / "b.csv").write_text("")
    assert records(spark, str(tmp_path / "b.csv")).collect() == []


def test_states_by_all_functions():
    kinds = [(0, 0), (1, 1), (0, 1), (1, 0)]
    for line in itertools.product(kinds, repeat=4):
        outside, inside = (np.array(c, np.int64) for c in zip(*line, strict=True))
        for first in (0, 1):
            states = [first]
            for f in line:
                states.append(f[states[-1]])
            assert running_states(outside, inside, first).tolist() == states
