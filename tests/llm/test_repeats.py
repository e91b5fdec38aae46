import hashlib
import random

import numpy as np
import pytest

from tillwise.llm import repeats


def slow(rows, length=100):
    seen, out = set(), []
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1]).hexdigest())
    for doc, data in sorted(rows, key=order):
        covered, end = bytearray(len(data)), 0
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in seen:
                covered[max(p, end) : p + length] = b"\1" * (p + length - max(p, end))
                end = p + length
            else:
                seen.add(string)
        runs = sum(covered[q] and not (q and covered[q - 1]) for q in range(len(data)))
        kept = bytes(c for c, z in zip(data, covered, strict=True) if not z)
        out.append((doc, len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def check(frame):
    rows = [(r.doc_id, (r.text or "").encode()) for r in frame.select("doc_id", "text").collect()]
    found = [(*tuple(r)[:5], bytes(r.kept)) for r in repeats.remove_repeats(frame).collect()]
    assert sorted(found, key=str) == slow(rows)


def test_odd_documents(clashing, nothing):
    check(clashing.where("doc_id IS NULL OR doc_id <> 9"))
    assert repeats.remove_repeats(nothing).collect() == []


def test_documents(spark, small):
    check(spark.read.parquet(f"{small}/documents.parquet"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_copies_runs_and_edits(spark, seed):
    draw = random.Random(seed)
    words = lambda n: " ".join(draw.choice(["al", "be", "gamma", "de", "eps", "zet"]) for _ in range(n))
    base = [words(60) for _ in range(6)]
    rows = []
    for i in range(100):
        text, kind, at = draw.choice(base), draw.random(), draw.randrange(150)
        if kind < 0.3:
            text = text[:at] + draw.choice(["x", "é", "", words(3)]) + text[at + draw.randrange(3) :]
        elif kind < 0.45:
            text = "a" * draw.randrange(90, 400)
        elif kind < 0.6:
            text = (words(draw.randrange(1, 9)) + " ") * draw.randrange(1, 30)
        elif kind < 0.8:
            text = words(draw.randrange(10, 80)) + text[at:]
        rows.append((i if draw.random() < 0.95 else None, text))
    check(spark.createDataFrame(rows + rows[:5], "doc_id bigint, text string"))


def test_positions_are_shuffled_slice_by_slice(spark, monkeypatch):
    """All single positions, the largest shuffle, were on the disks at once, beside their table."""
    sizes, later = [], repeats._later

    def counted(rows, *rest):
        sizes.append(rows.count())
        return later(rows, *rest)

    monkeypatch.setattr(repeats, "_later", counted)
    draw = random.Random(3)
    words = lambda n: " ".join(draw.choice(["al", "be", "gamma", "de", "eps", "zet"]) for _ in range(n))
    base = [words(60) for _ in range(6)]
    rows = [(i, words(20) + draw.choice(base) + words(20)) for i in range(100)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert 0 < max(sizes) < 0.5 * sum(sizes)


def slow_anchors(data, length=100):
    """Runs of strings with the same anchor, string by string: first, last and the anchor's place."""
    rank, runs = repeats.names(np.frombuffer(data, np.uint8), 64)[repeats.ANCHOR], []
    for p in range(len(data) - length + 1):
        at = min(range(p, p + length - repeats.ANCHOR + 1), key=lambda q: (rank[q], q))
        if runs and runs[-1][2] == at:
            runs[-1][1] = p
        else:
            runs.append([p, p, at])
    return runs


def test_short_documents_are_named_together():
    """Each document had passes of its own, whose fixed costs were a large part of the time."""
    draw = random.Random(4)
    docs = [b"", b"ab", b"a" * 99, b"a" * 100, b"a" * 350, b"xyz" * 70, bytes(100)]
    docs += [bytes(draw.choices(b"abcdefgh ", k=draw.randrange(600))) for _ in range(20)]
    docs += [bytes(draw.choices(b"abcdefgh ", k=40)) * draw.randrange(8) for _ in range(10)]  # equal ranks in a window
    draw.shuffle(docs)
    sizes = np.array([len(d) for d in docs])
    found = repeats.document_anchors(np.frombuffer(b"".join(docs), np.uint8), sizes)
    rows = sorted(zip(*(column.tolist() for column in found), strict=True))
    alone = [
        (i, *(int(x) for x in anchor[1:]))
        for i, d in enumerate(docs)
        for anchor in zip(*repeats.document_anchors(np.frombuffer(d, np.uint8), np.array([len(d)])), strict=True)
    ]
    assert rows == sorted(alone)
    expected = [(i, *run) for i, d in enumerate(docs) for run in slow_anchors(d)]
    assert sorted((doc, first, last, at) for doc, _, at, first, last, _ in rows) == sorted(expected)
    names = {}
    for doc, _, at, first, last, stretch in rows:  # equal stretches, their anchors in the same place: equal names
        text = docs[doc][first : last + 100]
        assert names.setdefault((text, at - first, last - first), stretch) == stretch
    assert len(set(names.values())) == len(names)
