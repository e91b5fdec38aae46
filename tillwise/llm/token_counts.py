"""Token counts of a unigram vocabulary, by dynamic programming over a trie of words."""

import math
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from tillwise.llm.common import coded_words, group_sums, slices, texts_of

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
# Words whose counts a Python worker remembers.
CACHED_WORDS = 800_000


class Vocabulary:
    """Log probabilities of pieces and bytes.

    The file ranks its pieces; the probability of a piece falls with its rank as 1 / (rank
    + 1), as word frequencies do.
    """

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        total = math.log(sum(1 / (i + 1) for i in range(n)))
        weight = lambda rank: -math.log(rank + 1) - total
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.pieces = {model.id_to_piece(i): weight(rank) for rank, i in enumerate(plain)}
        self.byte = weight(n)
        self.longest = max(map(len, self.pieces))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def trie_counts(words: list[str], vocabulary: Vocabulary) -> list[int]:
    """Tokens in the most probable segmentation of each word.

    The words, in sorted order, are a depth-first walk through their trie: the path kept from one word
    to the next is their common prefix, whose nodes have their best score and count from
    before. Only new nodes are computed, each from the nodes a piece's length above it, and
    the count at a word's last node is its result. Of equally probable ways the one with
    fewer tokens counts. A character without a piece counts one token per UTF-8 byte.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    counts = [0] * len(words)
    pieces, longest = vocabulary.pieces, vocabulary.longest
    path, before = [(0.0, 0)], ""
    for at in order:
        word = WORD_START + words[at]
        shared = len(os.path.commonprefix((before, word)))
        del path[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            char = word[end - 1]
            best = None
            for start in range(max(0, end - longest), end):
                weight = pieces.get(word[start:end])
                if weight is not None:
                    score, n = path[start]
                    candidate = (score + weight, -n - 1)
                    if best is None or candidate > best:
                        best = candidate
            if best is None or char not in pieces:
                size = len(char.encode())
                score, n = path[end - 1]
                candidate = (score + size * vocabulary.byte, -n - size)
                best = candidate if best is None else max(best, candidate)
            path.append((best[0], -best[1]))
        counts[at] = path[-1][1]
        before = word
    return counts


@cache
def _known(path: str) -> dict[str, int]:
    return {}


def count_tokens(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None
) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_tokens``.

    Words are separated by white space, which takes no token of its own. Each slice of
    documents inserts the distinct words it has not met before; nothing is shuffled, and
    memory is bounded by the slice and ``CACHED_WORDS``. Null and empty texts have no
    token, repeated rows equal counts; a null id stays null. No rows give no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, codes, sizes = coded_words(texts_of(piece, "text"))
                known = _known(path)
                words = words.to_pylist()
                new = [w for w in words if w not in known]
                found = dict(zip(new, trie_counts(new, vocabulary(path)), strict=True))
                of_word = np.array([known[w] if w in known else found[w] for w in words] or [0], np.int64)
                if len(known) < CACHED_WORDS:
                    known.update(found)
                tokens = group_sums(of_word[codes] if len(codes) else np.zeros(0, np.int64), sizes)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(sizes), pa.array(tokens)], names=["id", "n_words", "n_tokens"]
                )

    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(own.dtypes)["id"]
    counted = own.mapInArrow(run, f"id {kind}, n_words bigint, n_tokens bigint")
    return counted.withColumnRenamed("id", id_column)
