import hashlib
import re

from hypothesis import given, settings as limits, strategies as st

from tillwise.llm import pii


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def slow_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@limits(max_examples=400, deadline=None)
@given(st.text("ab1290.@+-% ()٣é", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == slow_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "1." * 100_000, "+1" * 100_000):
        pii.base_spans(text)


SEEDS = [f"noise {i} my contact email: user{i}@mail{i % 7}.example.com fine" for i in range(12)]
HIDDEN = [f"word{i} the contact email: joe{i} at mail dot example dot com then" for i in range(6)]
PLAIN = ["the 4 of 55 and 6789 in the 12345 of the end", "contact nobody", "of 123456 the 1999 of 77777"]


def test_discovers_what_shares_the_context(spark):
    rows = list(enumerate(SEEDS + HIDDEN + PLAIN))
    found = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(found) == len(rows)
    for doc, text in rows:
        r, base = found[doc], slow_spans(text)
        assert r.base_sha256 == hashlib.sha256(pii.as_text(base).encode()).hexdigest()
        assert r.n_email == sum(k == 0 for _, k, _ in base)
        if text in HIDDEN:
            start = text.index("joe")
            assert r.spans == f"email:{start}:{text.index(' then')}" and r.n_discovered == 1
        else:
            assert r.spans == pii.as_text(base)


def test_blocks_of_patterns(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(SEEDS + HIDDEN)), "doc_id bigint, text string")
    whole = sorted(map(str, pii.find_personal_data(docs).collect()))
    monkeypatch.setattr(pii, "BLOCK_PATTERNS", 1)
    assert sorted(map(str, pii.find_personal_data(docs).collect())) == whole


def test_odd_documents(odd, clashing, nothing, spark, small):
    assert pii.find_personal_data(nothing).collect() == []
    for frame in (clashing, spark.read.parquet(f"{small}/documents.parquet")):
        texts = sorted((str(r.doc_id), pii.as_text(slow_spans(r.text or ""))) for r in frame.collect())
        found = pii.find_personal_data(frame).collect()
        hashes = sorted((str(r.doc_id), r.base_sha256) for r in found)
        assert hashes == sorted((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in texts)


def discovered(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {texts[r.doc_id] for r in pii.find_personal_data(docs).collect() if r.n_discovered == 1}


def test_unseen_identifiers_do_not_count_against_their_context_and_make_new_ones(spark):
    seeds = [f"a{i} phone +1 555 010 {2000 + i} x" for i in range(8)]
    unseen = [f"a{i} phone (555) 123-{4000 + i} x" for i in range(8)]
    again = [f"b{i} reachable (555) 123-{4000 + i} x" for i in range(5)]
    further = [f"b{i} reachable (555) 777-{4000 + i} x" for i in range(5)]
    plain = ["room 12345678 x", "the phone rings"]
    assert discovered(spark, seeds + unseen + again + further + plain) == {*unseen, *again, *further}
    # Words mostly followed by something else introduce nothing.
    assert discovered(spark, seeds + unseen + ["the phone rings"] * 20) == set()


def test_glued_contexts_and_spelled_dots_are_searched(spark):
    glued = [f"a{i} Tel:+1 555 010 {2000 + i} x" for i in range(8)]
    hidden = [f"a{i} Tel:01234567{i}9 x" for i in range(3)]
    spelled = [f"a{i} my email john dot doe{chr(97 + i)} at example dot com" for i in range(3)]
    seeds = [f"a{i} my email user{i}@mail.example.com x" for i in range(8)]
    assert discovered(spark, glued + hidden + seeds + spelled) == {*hidden, *spelled}


def test_merge_by_brute_force():
    import random

    pick = random.Random(4)
    for _ in range(300):
        spans = [[(a := pick.randrange(60), pick.randrange(4), a + pick.randint(1, 9)) for _ in range(pick.randrange(9))] for _ in "ab"]
        taken = sorted(spans[0])
        for start, kind, end in sorted(set(spans[1])):
            if all(end <= a or b <= start for a, _, b in taken):
                taken.append((start, kind, end))
        assert pii.merge(*spans) == sorted(taken)
    many = [(10 * i, 0, 10 * i + 5) for i in range(100_000)]
    assert len(pii.merge(many, [(10 * i + 6, 1, 10 * i + 9) for i in range(100_000)])) == 200_000


def test_marked_words_by_brute_force():
    """The one expression finds the words that each was tested for before."""
    import random

    pick = random.Random(1)
    signs = ["at", "AT", " ", "\n", ":", "=", "x", "7", "@", "[", "(", "dot", ")", " (at) ", " [dot] ", "com", "é", "\t", ".", "12345"]
    for _ in range(5000):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 30)))
        words = list(pii._PART.finditer(text))
        wanted = [
            w.start() for i, w in enumerate(words)
            if pii._MARKED.search(w.group()) or i + 1 < len(words) and pii._SECOND.match(words[i + 1].group())
        ]
        assert [m.start(1) for m in pii._BEGINS.finditer(text) if m[1]] == wanted
    pii._mentions("word " * 400_000)


def test_long_words_are_no_context():
    long = "k" * 65
    assert pii._before(f"{long} 7", 66) == [] and pii._context(long) == "" and pii._context("k" * 64)
    assert pii._before(f"a {'k' * 64} 7", 67) == ["k" * 64, "a " + "k" * 64]
