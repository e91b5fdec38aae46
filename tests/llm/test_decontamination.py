from hypothesis import given, settings as limits, strategies as st

from tillwise.llm import decontamination as d


def distances(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row


@limits(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=90))
def test_myers_distance(pattern, text):
    assert d.best_match(pattern, text)[0] == min(distances(pattern, text))


ITEM = "Which of the listed rivers carries the most water to the sea in spring, and why is that so?"


def test_finds_all_within_the_budget(spark, odd, nothing):
    text = d.normalise(ITEM)
    budget = d.budget_of(len(text))
    assert budget >= 5
    changed = text[:20] + "x" + text[21:50] + text[52:70] + "yy" + text[70:]
    far = "".join(c if i % 6 else "q" for i, c in enumerate(text))
    rows = [(20, "before " + ITEM.upper() + " after"), (21, f"some {changed} thing"), (22, far), (23, text[:40])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(odd.select("doc_id", "text"))
    items = spark.createDataFrame([(7, ITEM), (8, ITEM), (9, None), (10, "the")], "item_id bigint, text string")
    found = {r.doc_id: r for r in d.leaked_documents(docs, items).collect()}
    assert set(found) == {20, 21}
    assert found[20].item_ids == [7, 8] and found[20].distance == 0
    assert found[21].distance == min(distances(text, d.normalise(rows[1][1])))
    assert d.leaked_documents(nothing, items).collect() == []
    assert d.clean_documents(docs, items.where("false")).count() == docs.count()


def test_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 1500")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    texts = [(r.item_id, d.normalise(r.text)) for r in items.collect()]
    slow = set()
    for r in docs.collect():
        text = d.normalise(r.text)
        slow |= {(r.doc_id, i) for i, p in texts if d.best_match(p, text)[0] <= d.budget_of(len(p))}
    found = d.leaked_documents(docs, items).collect()
    assert {(r.doc_id, i) for r in found for i in r.item_ids} == slow and slow


def test_blocks_of_items(spark, small, monkeypatch):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(str, d.leaked_documents(docs, items).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 2000)
    assert sorted(map(str, d.leaked_documents(docs, items).collect())) == whole


def test_clean_documents_keep_their_columns(clashing, spark):
    items = spark.createDataFrame([(1, "alpha30 beta2 alpha31 beta3 alpha32 beta4")], "item_id bigint, text string")
    kept = d.clean_documents(clashing, items)
    assert kept.columns == clashing.columns
    assert {1, 2, 11}.isdisjoint(r.doc_id for r in kept.collect())


def test_short_items_as_they_are_written(spark):
    docs = spark.createDataFrame(
        [(1, "what is 2 + 2 = 4"), (2, "so 2+2=? he asked"), (3, "page 2 2 of 9"), (4, "什么是最长的河流。"), (5, "=>="), (6, "we WHAT  is 2 +\n2 = 4"),
         (7, "12+2=?"), (8, None)], "doc_id bigint, text string",
    )
    items = spark.createDataFrame(
        [("a", "What is 2 + 2 = 4"), ("b", "2+2=?"), ("c", "最长的河流"), (None, "=>="), (None, None), ("d", " "), ("e", "page")],
        "item_id string, text string",
    )
    found = {r.doc_id: r.item_ids for r in d.leaked_documents(docs, items).collect()}
    assert found == {1: ["a"], 2: ["b"], 4: ["c"], 5: [None], 6: ["a"]}
    assert {r.doc_id for r in d.clean_documents(docs, items).collect()} == {3, 7, 8}


def test_items_without_id_beside_others(spark):
    docs = spark.createDataFrame([(1, f"x {ITEM} y")], "doc_id int, text string")
    items = spark.createDataFrame([(None, ITEM), (3, ITEM), (None, ITEM)], "item_id int, text string")
    assert [r.item_ids for r in d.leaked_documents(docs, items).collect()] == [[3, None]]
