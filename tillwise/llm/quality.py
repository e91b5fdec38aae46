"""Quality rules: text statistics and a hashed n-gram likelihood ratio, all in DataFrame functions."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import SPACE, Scratch, free_name, whole_text

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"

# The likelihood ratio: added to each count, words in an n-gram.
SMOOTHING = 1.0
MAX_NGRAM = 2
# n-grams that have counts of their own, the most frequent of the target; as long as the target has
# no more, all of them.
OWN_GRAMS = 4_000_000
# Classes that all other n-grams share, told apart by their hash.
OTHER_CLASSES = 1 << 17
# The target's n-grams are counted in so many parts, which bounds what a count shuffles at once.
COUNT_PARTS = 2
# Labelled ids that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
# Target documents in one place while the n-grams of each are counted.
DOCS_PER_PIECE = 1_000
# n-grams of the target that are broadcast at once; more are taken slice by slice.
SLICE_GRAMS = 4_000_000
# n-grams in a row of a broadcast table; rows of their own would take three times the memory.
GRAMS_PER_ROW = 16
# The least score where fewer than LEAST_LABELLED rows of a label can be scored, and the
# steps of a score in which a threshold is looked for.
THRESHOLD = -0.25
LEAST_LABELLED = 5
SCORE_STEP = 0.01


def _words(text: Column) -> Column:
    """The words of the text, an array."""
    for white in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(white), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _joined(left: Column, right: Column, gap: int) -> Column:
    """Hashes of left[i] and right[i + gap], as far as both go."""
    n = F.greatest(F.least(F.size(left), F.size(right) - gap), F.lit(0))
    return F.zip_with(
        F.slice(left, F.lit(1), n), F.slice(right, F.lit(1 + gap), n), lambda a, b: F.xxhash64(a, b)
    )


def with_statistics(
    docs: DataFrame, text_column: str, words: str, names: dict[str, str]
) -> DataFrame:
    """Adds the counts of the base rules under the given names; see ``assess``. ``words`` is the
    column of their array.

    A window counts as found again if its 64-bit hash is. Windows are compared within one
    text, by sorting (hash, place) pairs in its own row, and only in texts where some
    window repeats. No row is shuffled.
    """
    text = whole_text(text_column)
    windows, pairs, places = (free_name(docs, f"_{n}") for n in ("windows", "pairs", "places"))
    word_chars = F.char_length(F.array_join(words, "")).cast("bigint")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    counted = (
        docs.withColumn(names["n_words"], F.size(words).cast("bigint"))
        .withColumn(names["word_chars"], word_chars)
        .withColumn(names["n_symbols"], F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"))
        .withColumn(
            names["n_dup_lines"], (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")
        )
    )
    # Windows of 2, 4, 8 words, each made of two halves; the last only where one of the
    # half as long ones is found again.
    width, longer = 1, words
    while width < WINDOW:
        joined = _joined(F.col(longer), F.col(longer), width)
        if 2 * width == WINDOW:
            joined = F.when(F.size(F.array_distinct(longer)) < F.size(longer), joined)
        longer, width = f"{windows}{width}", 2 * width
        counted = counted.withColumn(longer, joined)
    counted = counted.withColumnRenamed(longer, windows)
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    sorted_pairs = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    paired = counted.withColumn(pairs, F.when(repeats, sorted_pairs))
    found = F.filter(
        pairs,
        lambda p, i: (F.get(F.col(pairs), i - 1)["h"] == p["h"])
        | F.coalesce(F.get(F.col(pairs), i + 1)["h"] == p["h"], F.lit(False)),
    )
    placed = paired.withColumn(places, F.array_sort(F.transform(found, lambda p: p["i"])))
    covered = F.transform(
        places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(places), i + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return placed.withColumn(names["n_repeat_words"], F.coalesce(total, F.lit(0)).cast("bigint")).select(
        *docs.columns, *[names[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    )


def trusted_ids(labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> DataFrame:
    """All ids labelled 1."""
    trusted = labels.where(F.col(label) == 1).select(F.col(id_column).alias("trusted")).distinct()
    return trusted.where("trusted IS NOT NULL")


def row_hash(id_column: str, text_column: str) -> Column:
    """128 bits that tell rows apart by id and text: two hashes that start differently."""
    row_id = F.coalesce(F.col(id_column).cast("string"), F.lit("-"))
    text = whole_text(text_column)
    return F.struct(F.xxhash64(row_id, text).alias("a"), F.xxhash64(F.lit("text"), text, row_id).alias("b"))


def ngram_rows(docs: DataFrame, max_ngram: int, buckets: int | None) -> DataFrame:
    """A row per occurrence of an n-gram in documents with ``words``: key and hash.

    Each word is exploded beside those that follow it, and its n-grams are made in the row, so
    all but the shifted arrays is generated code.
    """
    beside = F.arrays_zip(*(F.slice("words", F.lit(1 + n), F.size("words")).alias(f"w{n}") for n in range(max_ngram)))
    rows = docs.select("key", F.explode(beside).alias("word"))
    hashed = [F.xxhash64(f"word.w{n}") for n in range(max_ngram)]
    grams = [hashed[0]]
    for n in range(1, max_ngram):
        grams.append(F.when(F.col(f"word.w{n}").isNotNull(), F.xxhash64(grams[-1], hashed[n])))
    rows = rows.select("key", F.explode(F.array(*grams)).alias("gram")).where("gram IS NOT NULL")
    return rows if buckets is None else rows.withColumn("gram", F.pmod("gram", F.lit(buckets).cast("bigint")))


def _other_class() -> Column:
    """The class of an n-gram without counts of its own, a small negative number."""
    return F.pmod("gram", F.lit(OTHER_CLASSES).cast("bigint")) - F.lit(OTHER_CLASSES)


def _slices(target: DataFrame, n: int) -> list[DataFrame]:
    """The target's n-grams in tables that are small enough to be broadcast."""
    parts = -(-n // SLICE_GRAMS)
    if parts <= 1:
        return [target]
    part = F.pmod(F.xxhash64("gram"), F.lit(parts))
    return [target.where(part == i) for i in range(parts)]


def _packed(grams: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The table (gram, ...) with about ``GRAMS_PER_ROW`` n-grams to a row, their columns as arrays,
    and by how many the rest of an n-gram is the number of its row."""
    rows = 1 << (n // GRAMS_PER_ROW).bit_length()
    row = F.pmod("gram", F.lit(rows).cast("bigint")).alias("row")
    packed = grams.groupBy(row).agg(F.collect_list(F.struct(*grams.columns)).alias("all"))
    return packed.select("row", *(F.col(f"all.{c}").alias(f"{c}s") for c in grams.columns)), rows


def _looked_up(rows: DataFrame, packed: tuple[DataFrame, int], how: str, *columns: str) -> DataFrame:
    """``rows`` with further columns of their n-grams from the broadcast table, null if it has none."""
    table, n = packed
    joined = rows.join(F.broadcast(table), F.pmod("gram", F.lit(n).cast("bigint")) == F.col("row"), how)
    at = F.array_position("grams", F.col("gram")).cast("int") - 1
    found = joined.select(*rows.columns, *(F.get(f"{c}s", at).alias(c) for c in columns))
    return found if how == "left" else found.where(F.col(columns[0]).isNotNull())


def _raw_counts(rows: DataFrame, slices: list[tuple[DataFrame, int]], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Occurrences in ``rows``: (gram, raw) of the n-grams of the slices, (other, raw) of all
    other n-grams by class. What leaves a task is at most a row per n-gram and class."""
    symbol = F.when(F.col("is_own"), F.col("gram")).otherwise(_other_class()).alias("symbol")
    counted = _looked_up(rows, slices[0], "left", "is_own").select(symbol)
    counted = counted.groupBy("symbol").agg(F.count(F.lit(1)).alias("raw"))
    counted = scratch.save(counted.where("symbol IS NOT NULL"), "counted")
    scratch.release()
    is_other = F.col("symbol").between(-OTHER_CLASSES, -1)
    counts = counted.where(~is_other).withColumnRenamed("symbol", "gram")
    others = counted.where(is_other).withColumnRenamed("symbol", "other")
    if len(slices) == 1:
        return counts, others
    more = []
    for i, part in enumerate(slices[1:]):
        part = _looked_up(rows, part, "inner", "is_own").groupBy("gram").agg(F.count(F.lit(1)).alias("raw"))
        more.append(scratch.save(part, f"counted{i + 1}"))
        scratch.release()
        counts = counts.unionByName(more[-1])
        # The first count had these among the others.
        others = others.unionByName(more[-1].select(_other_class().alias("other"), (-F.col("raw")).alias("raw")))
    return counts, others.groupBy("other").agg(F.sum("raw").alias("raw"))


def _target_counts(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, in_target) of all n-grams of the target documents."""
    parts = None
    for i in range(COUNT_PARTS):
        part = grams.where(F.pmod(F.xxhash64("gram"), F.lit(COUNT_PARTS)) == i)
        part = scratch.save(part.groupBy("gram").agg(F.count(F.lit(1)).alias("in_target")), f"target{i}")
        scratch.release()
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _least_count(target: DataFrame) -> int:
    """The least count with which an n-gram has counts of its own: at most OWN_GRAMS reach it."""
    n, least = 0, 1
    by_count = target.groupBy(F.least("in_target", F.lit(OWN_GRAMS)).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    for r in by_count.orderBy(F.desc("c")).collect():  # few: many different counts need far more n-grams
        n += r.n
        if n > OWN_GRAMS:
            return r.c + 1
        least = r.c
    return least


def log_ratios(
    docs: DataFrame, trusted: DataFrame, scratch: Scratch, buckets: int | None, max_ngram: int
) -> DataFrame:
    """(key, log_ratio, held_out) of documents (key, id, text): the mean log of target to raw
    probability of each document's n-grams; no row for a document without words.

    The target is all documents of ``trusted``. ``held_out`` is the same with each n-gram's target
    count less its occurrences in the document itself. The ``OWN_GRAMS`` most frequent n-grams of the
    target have their own counts; the others share ``OTHER_CLASSES`` of them, counted over all target
    documents and all documents as well, so what is common in the corpus and missing in the
    target weighs most. With ``buckets`` all n-grams share so many. Counts of the target are
    broadcast slice by slice, several n-grams to a row and one table at a time, so neither counting
    nor scoring shuffles occurrences. What the target has is counted once, and only the other
    documents are counted for the corpus; target documents are shuffled once, by their key, and
    their n-grams are counted and scored where they then lie.
    """
    n_ids = trusted.count()
    known_ids = F.broadcast(trusted) if n_ids <= BROADCAST_IDS else trusted
    is_known = F.col("id") == F.col("trusted")
    in_target = docs.join(known_ids, is_known).select("key", "text")
    elsewhere = docs.join(known_ids, is_known, "left_anti").select("key", "text")
    # The numbers of the other classes are no n-grams.
    is_gram = ~F.col("gram").between(-OTHER_CLASSES, -1)

    def grams_of(texts: DataFrame) -> DataFrame:
        words = texts.select("key", _words(F.col("text")).alias("words"))
        return ngram_rows(words, max_ngram, buckets).where(is_gram)

    target = _target_counts(grams_of(in_target).select("gram"), scratch)
    target_total = target.agg(F.coalesce(F.sum("in_target"), F.lit(0))).first()[0]
    if buckets is not None:  # every bucket counts by itself
        every = docs.sparkSession.range(buckets).select(F.col("id").alias("gram"))
        own = every.join(target, "gram", "left").select("gram", F.coalesce("in_target", F.lit(0)).alias("in_target"))
        rare = target.where("false")
    else:
        least = _least_count(target)
        own, rare = target.where(F.col("in_target") >= least), target.where(F.col("in_target") < least)
    own = scratch.save(own, "own")
    n_own = own.count()
    shared = scratch.save(
        rare.groupBy(_other_class().alias("other")).agg(F.sum("in_target").alias("in_class")), "shared"
    )
    scratch.drop(*(f"target{i}" for i in range(COUNT_PARTS)))
    scratch.release()

    rows = ngram_rows(elsewhere.select("key", _words(F.col("text")).alias("words")), max_ngram, buckets)
    parts = [(part, n_own // max(1, -(-n_own // SLICE_GRAMS))) for part in _slices(own, n_own)]
    marked = [_packed(part.select("gram", F.lit(True).alias("is_own")), n) for part, n in parts]
    counts, others = _raw_counts(rows, marked, scratch)
    smooth = F.lit(SMOOTHING)

    def weight(count: str) -> Column:
        return F.log((F.col(count) + smooth) / (F.col("raw") + smooth))

    weights = own.join(counts, "gram", "left").withColumn("raw", F.coalesce("raw", F.lit(0)) + F.col("in_target"))
    weights = scratch.save(weights.withColumn("weight", weight("in_target")), "weights")
    classes = others.join(shared, "other", "full").withColumn("in_class", F.coalesce("in_class", F.lit(0)))
    classes = classes.withColumn("raw", F.coalesce("raw", F.lit(0)) + F.col("in_class"))
    classes = classes.select("other", "in_class", weight("in_class").alias("other_weight"), "raw")
    classes = scratch.save(classes, "other_weights")
    raw_total = sum(df.agg(F.sum("raw")).first()[0] or 0 for df in (weights, classes))
    added = SMOOTHING * (buckets or n_own + OTHER_CLASSES)
    raw_total, target_total = raw_total + added, target_total + added

    def loss(count: str) -> Column:
        """What a score loses without the document's own n occurrences."""
        left = F.greatest(F.col(count) - F.col("n"), F.lit(0))
        return F.col("n") * F.log((left + smooth) / (F.col(count) + smooth))

    # All n-grams of a document lie in one place: no shuffle counts them, or adds up what they lose.
    placed = in_target.repartition(n_ids // DOCS_PER_PIECE + 1, "key")
    pairs = grams_of(placed).groupBy("key", "gram").agg(F.count(F.lit(1)).alias("n"))
    known_classes = F.broadcast(classes.select("other", "in_class", "other_weight"))
    none = F.lit(0).cast("bigint")
    saved = []
    for i, part in enumerate(_slices(weights.select("gram", "weight", "in_target"), n_own)):
        how = "left" if i == 0 else "inner"
        packed = _packed(part.drop("in_target"), parts[i][1])
        scored = _looked_up(rows, packed, how, "weight")
        packed = _packed(part, parts[i][1])
        held = _looked_up(pairs, packed, how, "weight", "in_target")
        if i == 0:
            scored = scored.withColumn("other", F.when(F.col("weight").isNull(), _other_class()))
            held = held.withColumn("other", F.when(F.col("weight").isNull(), _other_class()))
            score, n_scored, n_held = F.coalesce("weight", "other_weight"), F.count(F.lit(1)), F.sum("n")
            lost = F.coalesce(loss("in_target"), loss("in_class"))
        else:  # what the first slice has taken for another n-gram
            scored, held = scored.withColumn("other", _other_class()), held.withColumn("other", _other_class())
            score, n_scored, n_held = F.col("weight") - F.col("other_weight"), none, none
            lost = loss("in_target") - loss("in_class")
        scored = scored.join(known_classes, "other", "left").groupBy("key")
        scored = scored.agg(
            F.sum(score).alias("score"), n_scored.alias("n"), F.lit(0.0).alias("loss"), none.alias("held")
        )
        saved.append(scratch.save(scored, f"scored{i}"))  # its broadcast goes before the next is made
        scratch.release()
        held = held.join(known_classes, "other", "left").groupBy("key")
        held = held.agg(
            F.sum(F.col("n") * score).alias("score"), n_held.alias("n"), F.sum(lost).alias("loss"), n_held.alias("held")
        )
        saved.append(scratch.save(held, f"held{i}"))
        scratch.release()
    whole = saved[0]
    for part in saved[1:]:
        whole = whole.unionByName(part)
    whole = whole.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("score", "n", "loss", "held")))
    left = F.lit(float(target_total)) - F.col("held")
    held_out = (F.col("score") + F.col("loss")) / F.col("n") + F.log(F.lit(float(raw_total)) / left)
    return whole.select(
        "key",
        (F.col("score") / F.col("n") + F.lit(math.log(raw_total / target_total))).alias("log_ratio"),
        held_out.alias("held_out"),
    )


def best_threshold(steps: dict[int, tuple[int, int]]) -> float | None:
    """Where good and bad rows part best, from (bad, good) rows by step of their score.

    The cut with the largest share of good rows above it less that of bad ones; the middle
    of all that are equally good. None with too few rows of either.
    """
    bad, good = (sum(n[i] for n in steps.values()) for i in (0, 1))
    if min(bad, good) < LEAST_LABELLED:
        return None
    low_bad = low_good = 0
    cuts = []
    before = None
    for step in sorted(steps):
        gain = low_bad * good - low_good * bad
        cuts.append((gain, step if before is None else before + 1, step))
        low_bad, low_good, before = low_bad + steps[step][0], low_good + steps[step][1], step
    best = max(gain for gain, _, _ in cuts)
    return next((low + high) / 2 * SCORE_STEP for gain, low, high in cuts if gain == best)


def learned_threshold(judged: DataFrame, labels: DataFrame, id_column: str) -> float:
    """The score that parts the labelled rows of ``judged`` (id, base_failed, held_out)."""
    marked = labels.where("quality IN (0, 1)").groupBy(F.col(id_column).alias("id")).agg(F.max("quality").alias("quality"))
    scored = judged.where("NOT base_failed AND held_out IS NOT NULL").join(marked, "id")
    step = F.floor(F.col("held_out") / F.lit(SCORE_STEP)).alias("step")
    counted = scored.groupBy(step).agg(
        F.sum((F.col("quality") == 0).cast("int")).alias("bad"), F.sum((F.col("quality") == 1).cast("int")).alias("good")
    )
    found = best_threshold({r.step: (r.bad, r.good) for r in counted.collect()})
    return THRESHOLD if found is None else found


def assess(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float | None = None,
    names: dict[str, str] | None = None,
    buckets: int | None = None,
    max_ngram: int = MAX_NGRAM,
) -> DataFrame:
    """The documents with their statistics and verdict in further columns.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``; ``n_dup_lines``,
    lines with a word that equal an earlier line; ``n_repeat_words``, words inside 8-word
    windows found more than once; ``base_failed``, too few words or too many repeated;
    ``log_ratio``, mean log of target to raw probability of the text's hashed word
    n-grams, see ``log_ratios``; ``kept``, not base_failed and log_ratio at least ``threshold``. Without a
    given one, the threshold is where the held-out scores of the labelled rows part best.

    ``names`` renames the new columns; other columns stay. A null or empty text has no
    words and fails the base rules. Repeated rows get equal results, a row without id is
    never part of the target, no rows give no rows. Without any label of 1 there is no
    target: the ratio is 0 and only the base rules decide.
    """
    columns = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept"
    )
    names = {name: name for name in columns} | (names or {})
    scratch = Scratch(docs.sparkSession, "quality")
    trusted = scratch.save(trusted_ids(labels, id_column), "trusted")
    key = free_name(docs, "_row")
    own_key = row_hash(id_column, text_column)
    keyed = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"), own_key.alias("key"))
    plain = {name: name for name in columns}
    arrays = keyed.withColumn("words", _words(F.col("text")))
    judged = with_statistics(arrays, "text", "words", plain).drop("text", "words")
    judged = scratch.save(judged.dropDuplicates(["key"]), "figures")
    scratch.release()
    if trusted.isEmpty():
        judged = judged.withColumn("log_ratio", F.lit(0.0))
        threshold = 0.0
    else:
        judged = judged.join(log_ratios(keyed, trusted, scratch, buckets, max_ngram), "key", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = scratch.save(judged.withColumn("base_failed", failed), "judged")
    scratch.drop("own", "shared", "counted", "weights", "other_weights")
    scratch.release()
    if threshold is None:
        threshold = learned_threshold(judged, labels, id_column)
    judged = judged.withColumn("log_ratio", F.coalesce("log_ratio", F.lit(0.0)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
    judged = judged.select(F.col("key").alias(key), F.struct(*[F.col(n).alias(names[n]) for n in columns]).alias(f"{key}s"))
    joined = docs.withColumn(key, own_key).join(judged, key)
    return joined.select(*docs.columns, f"{key}s.*")
