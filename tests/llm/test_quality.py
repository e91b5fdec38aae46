import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tillwise.llm import quality


def slow_figures(text):
    words = [w.decode() for w in (text or "").encode().split()]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    n, symbols = len(words), len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), symbols, dup, len(covered), failed


def test_equals_brute_force(spark, odd, small):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*odd.columns)
    repeated = spark.createDataFrame([(70, "a b\n\nc\na b\nA b\n c\nc\n" * 9, "en", "z", 1)], odd.schema)
    for frame in (odd.unionByName(repeated), docs):
        for r in quality.assess(frame, labels).collect():
            assert tuple(r)[5:11] == slow_figures(r.text)
            assert r.kept == (not r.base_failed and r.log_ratio >= quality.THRESHOLD)


def test_likelihood_ratio(spark):
    import math

    docs = spark.createDataFrame([(1, "good good words here"), (2, "bad words"), (3, "good x")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, quality int")
    buckets = 64
    signed = lambda h: h - 2**64 if h >= 2**63 else h

    def grams(text):
        words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in text.split()]
        pairs = []
        for a, b in zip(words, words[1:], strict=False):
            first = xxhash.xxh64_intdigest((a & 2**64 - 1).to_bytes(8, "little"), 42)
            pairs.append(signed(xxhash.xxh64_intdigest((b & 2**64 - 1).to_bytes(8, "little"), first)))
        return [g % buckets for g in words + pairs]

    texts = {1: "good good words here", 2: "bad words", 3: "good x"}
    raw = Counter(g for t in texts.values() for g in grams(t))
    target = Counter(grams(texts[1]))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    weight = {b: math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in range(buckets)}
    for r in quality.assess(docs, labels, buckets=buckets).collect():
        mean = sum(weight[g] for g in grams(r.text)) / len(grams(r.text))
        assert abs(r.log_ratio - mean) < 1e-12


def test_ratio_of_whole_tables(spark, small, odd):
    """The registered form: own counts of the target's n-grams, classes for all others."""
    import math

    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(odd)
    signed = lambda h: h - 2**64 if h >= 2**63 else h

    def grams(text):
        words = [signed(xxhash.xxh64_intdigest(w, 42)) for w in (text or "").encode().split()]
        pairs = []
        for a, b in zip(words, words[1:], strict=False):
            first = xxhash.xxh64_intdigest((a & 2**64 - 1).to_bytes(8, "little"), 42)
            pairs.append(signed(xxhash.xxh64_intdigest((b & 2**64 - 1).to_bytes(8, "little"), first)))
        return words + pairs

    trusted = {r.trusted for r in quality.trusted_ids(labels).collect()}
    rows = [(r, grams(r.text)) for r in docs.collect()]
    target = Counter(g for r, own in rows if r.doc_id in trusted for g in own)
    symbol = lambda g: g if g in target else ("other", g % quality.OTHER_CLASSES)
    raw = Counter(symbol(g) for _, own in rows for g in own)
    added = len(target) + quality.OTHER_CLASSES
    scale = math.log((sum(raw.values()) + added) / (sum(target.values()) + added))
    expected = {}
    for r, own in rows:
        if own:
            weights = [math.log((target.get(g, 0) + 1) / (raw[symbol(g)] + 1)) for g in own]
            expected[r.doc_id, r.text] = sum(weights) / len(own) + scale
    for r in quality.assess(docs, labels).collect():
        assert abs(r.log_ratio - expected.get((r.doc_id, r.text), 0.0)) < 1e-9


def test_no_rows_no_labels_and_clashing_names(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert quality.assess(nothing, labels).collect() == []
    none = labels.where("false")
    assert all(r.log_ratio == 0 and r.kept == (not r.base_failed) for r in quality.assess(odd, none).collect())
    names = {n: f"q_{n}" for n in ("n_words", "kept")}
    judged = quality.assess(clashing, labels, names=names)
    assert judged.columns[: len(clashing.columns)] == clashing.columns
    assert judged.where("q_kept").count() == judged.where("q_kept = true").count()


def test_no_python_in_the_plan(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    plan = quality.assess(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_each_ngram_has_its_own_counts(spark):
    """Many distinct n-grams of good texts must not lift junk, as they did in 2^16 buckets."""
    word = lambda i: f"w{i * 7919 % 1_000_003}"
    good = [(i, " ".join(word(j * 331 + i) for j in range(300))) for i in range(1500)]
    junk = [(9000 + i, " ".join(f"j{(i * 37 + j) % 997}$$$" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(good + junk, "doc_id int, text string")
    labels = [(i, 1) for i in range(0, 1500, 2)] + [(9000 + i, 0) for i in range(20)]
    rows = quality.assess(docs, spark.createDataFrame(labels, "doc_id int, quality int")).collect()
    assert all(r.kept == (r.doc_id < 9000) for r in rows)


def test_target_ngrams_slice_by_slice(spark, small, monkeypatch):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    held = {r.doc_id: (r.log_ratio, r.kept) for r in quality.assess(docs, labels).collect()}
    monkeypatch.setattr(quality, "SLICE_GRAMS", 5_000)
    for r in quality.assess(docs, labels).collect():
        assert abs(r.log_ratio - held[r.doc_id][0]) < 1e-9 and r.kept == held[r.doc_id][1]


def test_threshold_parts_the_labelled_rows():
    assert round(quality.best_threshold({-300: (9, 0), -100: (2, 1), -40: (0, 9)}), 6) == -0.695
    assert quality.best_threshold({-300: (4, 0), -40: (0, 9)}) is None


def test_target_is_all_labelled_rows(spark):
    """The target was cut at 4,000 labelled documents."""
    labels = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.trusted_ids(labels).count() == 9_000


def test_rare_ngrams_count_in_their_class(spark, small, monkeypatch):
    """Beyond OWN_GRAMS the rarest n-grams of the target share the classes, with what they count there."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    # Single words only, so the expected counts are short.
    grams = lambda text: [signed(xxhash.xxh64_intdigest(w, 42)) for w in (text or "").encode().split()]
    rows = [(r.doc_id, grams(r.text)) for r in docs.collect()]
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    every = Counter(g for i, own in rows if i in good for g in own)
    monkeypatch.setattr(quality, "OWN_GRAMS", 300)
    least = next(c for c in range(1, 10**6) if sum(n >= c for n in every.values()) <= 300)
    symbol = lambda g: g if every[g] >= least else ("other", g % quality.OTHER_CLASSES)
    target, raw = Counter(), Counter()
    for i, own in rows:
        raw.update(map(symbol, own))
        target.update(symbol(g) for g in own if i in good)
    added = sum(n >= least for n in every.values()) + quality.OTHER_CLASSES
    scale = math.log((sum(raw.values()) + added) / (sum(target.values()) + added))
    expected = {i: sum(math.log((target[symbol(g)] + 1) / (raw[symbol(g)] + 1)) for g in own) / len(own) + scale
                for i, own in rows if own}
    for r in quality.assess(docs, labels, max_ngram=1).collect():
        assert abs(r.log_ratio - expected.get(r.doc_id, 0.0)) < 1e-9


def test_broadcast_rows_hold_several_ngrams(spark):
    """A row for each n-gram took 201 MB a table, two at a time, more than the driver had."""
    own = spark.range(-500, 500).select((F.col("id") * 7918).alias("gram"), F.col("id").alias("weight"))
    table, rows = quality._packed(own, 1000)
    assert table.count() <= rows <= 2 * 1000 // quality.GRAMS_PER_ROW
    looked = spark.range(-4000, 4000).select((F.col("id") * 3959).alias("gram"))
    expected = {g: g // 7918 if g % 7918 == 0 and -500 <= g // 7918 < 500 else None for (g,) in looked.collect()}
    assert {r.gram: r.weight for r in quality._looked_up(looked, (table, rows), "left", "weight").collect()} == expected
    known = quality._looked_up(looked, (table, rows), "inner", "weight").collect()
    assert {r.gram: r.weight for r in known} == {g: w for g, w in expected.items() if w is not None}


def test_held_out_scores(spark, monkeypatch):
    """Copies, n-grams only the target or only the rest has, own counts and classes."""
    monkeypatch.setattr(quality, "OWN_GRAMS", 3)
    texts = {1: "a a b c", 2: "a b d d", 3: "a e e f", 4: "g a b"}
    rows = [(1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (None, 4)]
    docs = spark.createDataFrame([(i, texts[t], t) for i, t in rows], "id int, text string, key int")
    trusted = spark.createDataFrame([(1,), (2,), (99,)], "trusted int")
    docs = docs.withColumn("key", F.struct(F.coalesce("id", F.lit(0)).alias("a"), F.col("key").alias("b")))
    found = quality.log_ratios(docs, trusted, quality.Scratch(spark, "test"), None, 1).collect()
    gram = lambda w: (h := xxhash.xxh64_intdigest(w.encode(), 42)) - 2**64 * (h >= 2**63)
    target = Counter(w for i, t in rows if i in (1, 2) for w in texts[t].split())
    own = {w for w in target if target[w] > 2}  # a, b: with those counted twice there are four
    symbol = lambda w: w if w in own else gram(w) % quality.OTHER_CLASSES
    raw = Counter(symbol(w) for _, t in rows for w in texts[t].split())
    good = Counter(symbol(w) for i, t in rows if i in (1, 2) for w in texts[t].split())
    added = len(own) + quality.OTHER_CLASSES
    n_raw, n_good = sum(raw.values()) + added, sum(good.values()) + added
    assert len(found) == 5
    for r in found:
        words, copies = texts[r.key.b].split(), rows.count((r.key.a or None, r.key.b))
        mine = Counter({symbol(w): 0 for w in words})
        if r.key.a in (1, 2):
            mine.update(symbol(w) for w in words * copies)
        mean = sum(math.log((good[symbol(w)] + 1) / (raw[symbol(w)] + 1)) for w in words) / len(words)
        held = sum(math.log((good[symbol(w)] - mine[symbol(w)] + 1) / (raw[symbol(w)] + 1)) for w in words) / len(words)
        assert abs(r.log_ratio - mean - math.log(n_raw / n_good)) < 1e-9
        assert abs(r.held_out - held - math.log(n_raw / (n_good - sum(mine.values())))) < 1e-9
