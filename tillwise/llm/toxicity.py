"""Toxic passages by maximum-scoring segments of token log-odds."""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import Scratch, coded_words, slices, texts_of, whole_text

# Labelled documents the model is fitted on at most, those with the smallest id hashes.
LABELLED_DOCUMENTS = 20_000
# Words the corpus is worth as a prior of either class.
PRIOR_WORDS = 100_000.0
# Standard errors a token's log-odds must be away from zero to count.
LEAST_EVIDENCE = 3.0
# What every other token costs a segment; keeps the expected score below zero.
PENALTY = 0.2
# Segments expected by chance in a text, below which a segment is significant.
LEAST_EXPECTED = 0.05
FOLDS = 5

_EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


class Model(NamedTuple):
    """Token scores, the parameters of the extreme value law, and of the calibration."""

    scores: dict[str, float]
    rate: float
    size: float
    slope: float
    shift: float


def fold(id_column: str) -> Column:
    """crc32 of the id as text modulo 5; 0 without an id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % FOLDS, F.lit(0))


def bare(word: str) -> str:
    """The token of a word: lower case, without punctuation around it."""
    low, high = 0, len(word)
    while low < high and not word[low].isalnum():
        low += 1
    while high > low and not word[high - 1].isalnum():
        high -= 1
    return word[low:high].lower()


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    Only positive scores can start or end one, so the scan visits those and takes what
    lies between from running sums. A segment absorbs earlier ones as long as that raises
    its score.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float]] = []
    lower: list[int] = []  # for each held segment, the last one before that begins lower
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, sums[i], sums[i + 1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j = lower[j]
            if j < 0 or held[j][3] >= right:
                held.append((start, end, left, right))
                lower.append(j)
                break
            start, left = held[j][0], held[j][2]
            del held[j:], lower[j:]
    return [(a, b, float(right - left)) for a, b, left, right in held]


def _tail(segments: list[float], n_words: int, rate: float, size: float) -> float:
    """-log of the probability that chance gives segments like the best r ones, for the best r.

    The r normalised scores exceed a sum t by chance with about exp(-t) t^(r-1) / (r! (r-1)!);
    r = 1 is the extreme value law of the best segment. Segments that chance gives anyway, whose
    normalised score is not positive, add nothing, and end the search.
    """
    base = math.log(max(size * max(n_words, 1), 1e-9))
    best, total = 0.0, 0.0
    for r, score in enumerate(sorted(segments, reverse=True), 1):
        if rate * score <= base:
            break
        total += rate * score - base
        log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
        best = max(best, -log_p - r * math.log(2))
    return best


def solve_rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * value)) = 1, for a negative mean."""
    if not (values > 0).any() or float(np.dot(values, shares)) >= 0:
        return 0.0
    excess = lambda x: float(np.dot(shares, np.exp(x * values))) - 1
    low, high = 0.0, 1e-3
    while excess(high) < 0 and high < 100:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a weak prior."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _labelled(labels: DataFrame, id_column: str, label: str) -> DataFrame:
    own = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & (fold(id_column) != 0))
    own = own.groupBy(F.col(id_column).alias("labelled")).agg(F.max(label).cast("int").alias("toxic"))
    return own.orderBy(F.xxhash64("labelled"), "labelled").limit(LABELLED_DOCUMENTS)


def token_evidence(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Documents with each token: of all, of toxic and of other labelled ones.

    A text counts once for each of its distinct words, so that neither a long nor a
    repetitive text outweighs others. Words are counted first and only distinct ones become
    tokens.
    """
    text = whole_text("text")
    for white in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(white), F.lit(" "))
    joined = docs.join(F.broadcast(labelled), F.col("id") == F.col("labelled"), "left")
    words = joined.select("toxic", F.explode(F.array_distinct(F.split(text, " "))).alias("word")).where("word <> ''")
    toxic, other = (F.col("toxic") == 1).cast("int"), (F.col("toxic") == 0).cast("int")
    counts = [F.count(F.lit(1)).alias("n"), F.sum(toxic).alias("y1"), F.sum(other).alias("y0")]
    counted = words.groupBy("word").agg(*counts)
    token = F.lower(F.regexp_replace("word", _EDGES, "")).alias("token")
    return counted.groupBy(token).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum("y1"), F.lit(0)).alias("y1"), F.coalesce(F.sum("y0"), F.lit(0)).alias("y0")
    )


def _token_scores(evidence: DataFrame) -> tuple[dict[str, float], float, float]:
    """Scores of the tokens with evidence; rate and size of the extreme value law.

    All tokens of the labelled documents whose odds are clear are held: their number is
    bounded by the vocabulary of ``LABELLED_DOCUMENTS`` texts.
    """
    totals = evidence.agg(F.sum("n"), F.sum("y1"), F.sum("y0")).first()
    n, n1, n0 = (float(x or 0) for x in totals)
    if not n1 or not n0:
        return {}, 0.0, 1.0
    prior = F.lit(PRIOR_WORDS / n) * F.col("n")
    odds1 = (F.col("y1") + prior) / (F.lit(n1 + PRIOR_WORDS) - F.col("y1") - prior)
    odds0 = (F.col("y0") + prior) / (F.lit(n0 + PRIOR_WORDS) - F.col("y0") - prior)
    spread = F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))
    scored = evidence.where("token <> '' AND y1 + y0 > 0").select("token", "y0", F.log(odds1 / odds0).alias("odds"), spread.alias("se"))
    strong = scored.where(F.abs("odds") >= LEAST_EVIDENCE * F.col("se"))
    rows = strong.orderBy("token").collect()
    scores = {r.token: r.odds - PENALTY for r in rows}
    known = sum(r.y0 for r in rows)
    values = np.array([scores[r.token] for r in rows] + [-PENALTY])
    shares = np.array([r.y0 + 0.5 for r in rows] + [max(n0 - known, 1.0)])
    shares = shares / shares.sum()
    rate = solve_rate(values, shares)
    # How often a segment can start: the share of positive tokens, discounted by the rate.
    size = float(shares[values > 0].sum()) or 1.0
    return scores, rate, size


def _segments_of(texts: pa.Array, scores: dict[str, float]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    words, codes, sizes = coded_words(texts)
    of_word = np.array([scores.get(bare(w), -PENALTY) for w in words.to_pylist()] or [0.0])
    values = of_word[codes] if len(codes) else np.zeros(0)
    ends = np.cumsum(sizes)
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        yield size, maximal_segments(values[end - size : end])


def _scan(docs: DataFrame, model: Model) -> DataFrame:
    """Each document's tail, and its significant passages."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("odds", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for piece in slices(batch, "text"):
                tails, passages = [], []
                for size, segments in _segments_of(texts_of(piece, "text"), m.scores):
                    tails.append(_tail([s[2] for s in segments], size, m.rate, m.size) if m.rate else 0.0)
                    passages.append(
                        [
                            {"first_word": a, "n_words": b - a, "odds": s}
                            for a, b, s in segments
                            if m.rate and m.size * size * math.exp(-m.rate * s) < LEAST_EXPECTED
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(tails, pa.float64()), pa.array(passages, pa.list_(passage))],
                    names=["id", "tail", "passages"],
                )

    kind = dict(docs.dtypes)["id"]
    schema = f"id {kind}, tail double, passages array<struct<first_word:bigint,n_words:bigint,odds:double>>"
    return docs.select("id", "text").mapInArrow(run, schema)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic"
) -> Model:
    """The model of the labelled documents outside the held-out fold.

    Token log-odds between toxic and other documents have a Dirichlet prior in the
    proportions of the whole corpus. The extreme value law of segment scores comes from the
    token frequencies of other documents; the calibration from the tails of the
    same labelled documents, ``LABELLED_DOCUMENTS`` at most.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    labelled = scratch.save(_labelled(labels, id_column, label), "labelled")
    scores, rate, size = _token_scores(scratch.save(token_evidence(own, labelled), "evidence"))
    scratch.drop("evidence")
    scratch.release()
    model = Model(scores, rate, size, 1.0, 0.0)
    texts = own.join(F.broadcast(labelled), F.col("id") == F.col("labelled"))
    tails = _scan(texts, model).join(F.broadcast(labelled), F.col("id") == F.col("labelled"))
    found = tails.select("tail", "toxic").collect()
    if not found or len({r.toxic for r in found}) < 2:
        share = sum(r.toxic for r in found) / len(found) if found else 0.0
        return model._replace(slope=0.0, shift=30.0 if share > 0.5 else -30.0)
    x = np.log1p(np.array([r.tail for r in found]))
    slope, shift = _fit_curve(x, np.array([float(r.toxic) for r in found]))
    return model._replace(slope=slope, shift=shift)


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, ``held_out``, ``score``, ``predicted``, ``passages``.

    Null, empty and wordless texts have no passage and the score of a text without one.
    Ids and other columns are no inputs of a score. Repeated rows get equal results; a
    row without id counts as held out. No rows give no rows.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    level = F.lit(model.slope) * F.log1p("tail") + F.lit(model.shift)
    probability = 1 / (1 + F.exp(-level))
    return _scan(own, model).select(
        F.col("id").alias(id_column),
        (fold("id") == 0).alias("held_out"),
        probability.alias("score"),
        (probability >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


def toxic_passages(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``score`` with the model that ``fit`` learns from the same documents and the labels."""
    return score(docs, fit(docs, labels, **options), **{k: v for k, v in options.items() if k != "label"})
