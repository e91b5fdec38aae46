import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

# Null, empty and white texts, ties, copies, near copies, repeated rows, a long text.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
ODD = [
    (1, BASE, "en", "b", 1),
    (2, BASE, "en", "b", 2),
    (3, BASE.replace("alpha30", "omega"), "en", "a", 3),
    (4, None, None, None, None),
    (5, "", "en", "a", 0),
    (6, " \t\n\x0b ", "en", "a", 0),
    (7, "one", "en", "c", 3),
    (8, "Ünï cöde — ≈ 😀 text\x1cwith odd spaces", "fr", "c", 9),
    (9, LONG, "en", "a", 4),
    (10, "same same same same same same same same same same same same", "en", "c", 5),
    (None, "no id " + BASE[:300], "en", "a", 1),
    (None, None, "en", None, 1),
    (2, BASE, "en", "b", 2),
    (11, BASE + " " + BASE[:400], "en", "b", 2),
]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with further columns named like results and like inner columns."""
    from pyspark.sql import functions as F

    names = ("fingerprint", "component_id", "kept", "size", "key", "id", "data", "hash", "fp", "node", "n_words")
    return odd.withColumns({name: F.lit("x") for name in (*names, "_key", "_leaks", "_words", "_hashes")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


def plain(rows):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(type(v)), v) if not isinstance(v, list) else (True, "list", str(v)) for v in r])
