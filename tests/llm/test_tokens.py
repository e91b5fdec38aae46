import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as limits, strategies as st
from tokenizers import Tokenizer

from tillwise.llm import tokens

PATH = tokens.public_tokenizers.path(tokens.VOCABULARY)


@limits(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=1500))
def test_code_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, offsets = tokens.encode(ids)
    assert (tokens.decode(words, offsets, len(ids)) == ids).all()
    assert len(offsets) == -(-len(ids) // tokens.BLOCK)


def test_small_ids_share_words():
    words, _ = tokens.encode(np.ones(480, np.uint64))
    assert len(words) == 8
    assert len(tokens.encode(np.array([2**63], np.uint64))[0]) == 2


def test_words_have_the_ids_of_their_text():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["x <|endoftext|> y<|startoftext|>z", "á ́b  é c\x1cd q'S it's I'LL", "ΑΣ ΣΑΣ İ ǅ", "", "12 3a4 ---!!! ..,, ​ x"]
    for text in texts:
        found, sizes = tokens.tokenize(pa.array([text], pa.large_string()), PATH)
        assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert sizes.tolist() == [len(found)]


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes", [1, 64 << 20])
def test_file_holds_all_documents(spark, odd, clashing, small, shard_bytes, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_BYTES", shard_bytes)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()))
    assert sorted(map(tuple, tokens.token_index(docs).collect())) == expected(rows)


def test_odd_documents(odd, nothing):
    assert tokens.token_index(nothing).collect() == []
    found = sorted(tokens.token_index(odd).collect(), key=lambda r: r.start)
    assert len(found) == odd.count()
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in found[1:]] == list(np.cumsum([r.n_tokens for r in found])[:-1])
    assert sum(r.n_tokens == 1 for r in found) == 4


def test_files_outside_the_manifest_do_not_count(spark, odd, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = tokens.write_shards(odd, folder)
    before = sorted(map(str, tokens.read_shards(manifest, folder).collect()))
    (tmp_path / "tokens" / "part-000000-00000-left.s8b").write_bytes(b"half a file")
    assert sorted(map(str, tokens.read_shards(tokens.read_manifest(spark, folder), folder).collect())) == before


def test_kept_words(monkeypatch):
    """Short and long words, zero bytes, words met again, a full cache."""
    import numpy as np
    import public_tokenizers
    import pyarrow as pa

    path = public_tokenizers.path(tokens.VOCABULARY)
    words = ["a", "é", "a\x00", "a\x00b", "word", "x" * 24, "x" * 25, "y" * 90, "Ünï", "😀", "7", "ab", "ba"]
    for most in (0, 3, 1000):
        monkeypatch.setattr(tokens, "CACHED_WORDS", most)
        held = tokens.WordIds(path)
        plain = held.tokenizer
        for part in (words, words[::-1], words[3:9] + ["new"], [], ["new", "a"]):
            ids, first, n = held.of(pa.array(part, pa.large_string()))
            for word, a, size in zip(part, first, n, strict=True):
                assert ids[a : a + size].tolist() == plain.encode(word, add_special_tokens=False).ids
        assert len(held.hashes) <= most and (np.diff(held.hashes.astype(object)) > 0).all()
    assert len(held.hashes) > 8


def test_words_are_encoded_together():
    """Each distinct word was a text, with a result, of its own."""

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

        encode_batch = encode_batch_fast

    plain = [f"w{i}é{'x' * (i % 40)}." for i in range(2_100)]
    odd = ["a<|endoftext|>b", "<|endoftext|>", "<|startoftext|>x", "<|endoftext|<|", "|>", "́a", "'s", " "]
    for words, most in ((plain, 10), (odd + plain[:50], 100)):
        held = tokens.WordIds(PATH)
        held.tokenizer = counting = Counting(held.tokenizer)
        ids, first, n = held.of(pa.array(words, pa.large_string()))
        for word, a, size in zip(words, first, n, strict=True):
            assert ids[a : a + size].tolist() == counting.tokenizer.encode(word, add_special_tokens=False).ids
        assert counting.texts <= most
