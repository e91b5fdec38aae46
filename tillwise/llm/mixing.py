"""Mixing sources to target weights by weighted fair queueing."""

from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import Scratch, count_words, free_name, row_key, rows_of
from tillwise.operators.ranking import with_position, with_running_total

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MAX_EPOCHS = 2
SEED = 42

# A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 10_000


def source_targets(
    sizes: DataFrame,
    scratch: Scratch,
    weights: tuple[float, ...] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> tuple[DataFrame, float]:
    """A row per source with ``source_size`` and ``target``, and the whole budget.

    ``sizes`` has ``unknown`` (the source is null), ``name`` and ``size``. The weights
    repeat over the sources in code point order, the null source last. A target is the
    source's weight times a common level, at most ``max_epochs`` times its size; the level
    rises until the targets add up to the budget. The driver sees one row of sums for each
    rise.
    """
    sums = sizes.groupBy("unknown", "name").agg(F.sum("size").alias("source_size"))
    placed = with_position(scratch.save(sums, "sums"), ["unknown", "name"], "position")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighted = placed.select(
        "unknown",
        "name",
        "source_size",
        F.get(listed, (F.col("position") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("most"),
    )
    weighted = scratch.save(weighted, "weighted")
    budget = (weighted.agg(F.sum("source_size")).first()[0] or 0) * budget_percent / 100
    level, open_ones = 0.0, -1
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        n, used, weight = weighted.agg(
            F.count(F.when(~full, 1)), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == open_ones or not n:
            break
        level, open_ones = (budget - (used or 0.0)) / weight, n
    target = F.least(F.col("most"), F.lit(level) * F.col("weight"))
    return scratch.save(weighted.select("unknown", "name", "source_size", target.alias("target")), "targets"), budget


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = SEED,
    **options,
) -> DataFrame:
    """One row per document: its id, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    Each source's documents are queued in a shuffled order, whole epochs one after another.
    A document's virtual finish time is the words its source has queued up to and with it,
    divided by the source's target. All queues are sorted by that time across all tasks
    and cut off where the words reach the budget. ``copies`` is how often a document is
    taken, ``taken`` the words that makes.

    The order depends on ids and ``seed`` only, so reruns agree; rows with equal ids follow
    each other by size. Null and empty texts have size 0 and are taken with the words
    around them. A null source is a source of its own; a null id is allowed. No rows give
    no rows, and a corpus without words is taken as often as ``max_epochs`` allows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    max_epochs = options.get("max_epochs", MAX_EPOCHS)
    own = scratch.save(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).isNull().alias("unknown"),
            F.coalesce(F.col(source_column), F.lit("")).alias("name"),
            F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))), 1, 16).alias("draw"),
            count_words(text_column).alias("size"),
        ),
        "sizes",
    )
    targets, budget = source_targets(own, scratch, **options)
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    queued = with_running_total(own, ["unknown", "name", "draw", "id", "size"], "size", "queued", "all")
    # Words of the sources before are taken off: what is left counts within the source.
    before = own.groupBy("unknown", "name").agg(F.sum("size").alias("source_size"))
    before = with_running_total(before, ["unknown", "name"], "source_size", "until", "all")
    before = before.select("unknown", "name", (F.col("until") - F.col("source_size")).alias("before"))
    before = F.broadcast(before) if before.count() <= BROADCAST_SOURCES else before
    lines = queued.join(before, ["unknown", "name"]).join(targets, ["unknown", "name"])
    lines = lines.select(
        "id", "unknown", "name", "draw", "size", "source_size", "target",
        (F.col("queued") - F.col("before")).alias("queued"),
    )
    items = scratch.save(lines, "lines").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")
    )
    words = F.col("queued") + F.col("epoch") * F.col("source_size")
    finish = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    timed = items.select(
        "id", "unknown", "name", "draw", "size", "source_size", "target", "epoch", finish.alias("finish")
    )
    order = ["finish", "unknown", "name", "epoch", "draw", "id", "size"]
    emitted = with_running_total(timed, order, "size", "emitted", "all")
    inside = F.col("emitted") <= F.lit(float(budget))
    scratch.release()
    return emitted.groupBy("unknown", "name", "draw", "id", "size", "source_size", "target").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(inside.cast("int")).alias("all_copies"),
    ).select(
        "*", F.explode(F.sequence(F.lit(1), (F.col("rows") / max_epochs).cast("int"))).alias("nth")
    ).select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * _share(max_epochs)).alias("taken"),
        _share(max_epochs).alias("copies"),
    )


def _share(max_epochs: int):
    """Copies of the nth of equal rows: each is filled up to the epochs before the next."""
    rest = F.col("all_copies") - (F.col("nth") - 1) * max_epochs
    return F.greatest(F.least(rest, F.lit(max_epochs)), F.lit(0)).cast("bigint")


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, columns unchanged."""
    scratch = Scratch(docs.sparkSession, "mixed")
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, row_key(docs, id_column))
    return rows_of(keyed, key, mix(keyed, key, **options).select(key, "copies"), scratch)
