from hypothesis import given, settings as limits, strategies as st

from tillwise.llm import token_counts as t

VOCABULARY = t.vocabulary(t.public_tokenizers.path(t.VOCABULARY))


def slow_count(word):
    word, best = t.WORD_START + word, [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(end):
            weight = VOCABULARY.pieces.get(word[start:end])
            if weight is not None:
                ways.append((best[start][0] + weight, best[start][1] - 1))
        if word[end - 1] not in VOCABULARY.pieces:
            size = len(word[end - 1].encode())
            ways.append((best[end - 1][0] + size * VOCABULARY.byte, best[end - 1][1] - size))
        best.append(max(ways))
    return -best[-1][1]


@limits(max_examples=100, deadline=None)
@given(st.lists(st.text("aetionsh,.é😀", min_size=1, max_size=14), max_size=30))
def test_trie_equals_single_words(words):
    assert t.trie_counts(words, VOCABULARY) == [slow_count(w) for w in words]


def test_documents(spark, clashing, nothing, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 3000")
    for frame in (docs, clashing.where("doc_id IS NULL OR doc_id <> 9")):
        known, slow = {}, []
        for r in frame.collect():
            words = [w.decode() for w in (r.text or "").encode().split()]
            for w in words:
                known.setdefault(w, None)
                if known[w] is None:
                    known[w] = slow_count(w)
            slow.append((r.doc_id, len(words), sum(known[w] for w in words)))
        assert sorted(map(tuple, t.count_tokens(frame).collect()), key=str) == sorted(slow, key=str)
    assert t.count_tokens(nothing).collect() == []


def test_long_text(clashing):
    found = {r.doc_id: r for r in t.count_tokens(clashing).collect()}
    assert found[9].n_words == 20_000 and found[9].n_tokens > 20_000
