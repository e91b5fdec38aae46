"""Finding benchmark items in documents, up to an edit budget, by the pigeonhole principle."""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillwise.llm.common import Scratch, free_name, reach_package, slices, texts_of

# Edits an item may have per character, and the shortest piece looked up: a budget that
# would need shorter pieces is lowered.
EDIT_RATE = 0.08
MIN_PIECE = 12
# Normalised items below this length say too little for edits: they are found as they are
# written, but for case and white space.
MIN_ITEM = 20

# Bytes of item text in one automaton. More items are searched in blocks of that size.
BLOCK_BYTES = 16 << 20

_WORDS = re.compile(r"\w+")


def normalise(text: str) -> str:
    """Lower case, words separated by single spaces, no punctuation."""
    return " ".join(_WORDS.findall(text.lower()))


def squeeze(text: str) -> str:
    """Lower case, white space as single spaces, all signs kept."""
    return " ".join(text.lower().split())


def _joins(char: str) -> bool:
    """Whether a character makes a longer word of what stands beside it; scripts without blanks
    between words have no such borders."""
    return (char.isalnum() or char == "_") and ord(char) < 0x2E80


def _bordered(item: str, text: str, start: int, end: int) -> bool:
    """Whether item and text differ at both borders of a hit, so that it is no part of a word."""
    before = start > 0 and _joins(item[0]) and _joins(text[start - 1])
    after = end < len(text) and _joins(item[-1]) and _joins(text[end])
    return not before and not after


def _is_word(item: str) -> bool:
    """A single word of letters is in any text of its language and no benchmark item."""
    return item.isalpha() and all(map(_joins, item))


def _automaton(words: dict) -> ahocorasick.Automaton | None:
    if not words:
        return None
    automaton = ahocorasick.Automaton()
    for word, value in words.items():
        automaton.add_word(word, (len(word), value))
    automaton.make_automaton()
    return automaton


def budget_of(length: int, edit_rate: float = EDIT_RATE, min_piece: int = MIN_PIECE) -> int:
    return max(0, min(int(edit_rate * length), length // min_piece - 1))


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and where that ends.

    Myers' bit-parallel columns: one bit for each character of the pattern.
    """
    size = len(pattern)
    places: dict[str, int] = {}
    for i, char in enumerate(pattern):
        places[char] = places.get(char, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for at, char in enumerate(text, 1):
        equal = places.get(char, 0)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Items in automata: the pieces of long ones, short ones as they are written.

    ``items`` are (id, text); ids may be anything, also None.
    """

    def __init__(self, items: list[tuple], edit_rate: float = EDIT_RATE, min_piece: int = MIN_PIECE):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        short: dict[str, list] = {}
        for item_id, raw in items:
            text = normalise(raw)
            size = len(text)
            if size < MIN_ITEM:
                if squeeze(raw) and not _is_word(squeeze(raw)):
                    short.setdefault(squeeze(raw), []).append(item_id)
                continue
            budget = budget_of(size, edit_rate, min_piece)
            cuts = [round(j * size / (budget + 1)) for j in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[a:b], []).append((len(self.items), a))
            self.items.append((item_id, text, budget))
        self.pieces, self.short = _automaton(pieces), _automaton(short)

    def find(self, raw: str) -> list[tuple]:
        """(item id, distance, end), the best match of each item in a text. The end is a place in
        the normalised text, for short items in the squeezed one."""
        return [*self._find_long(normalise(raw)), *self._find_short(squeeze(raw) if self.short else "")]

    def _find_short(self, text: str) -> Iterator[tuple]:
        met: dict[str, int] = {}
        owners: dict[str, list] = {}
        for last, (length, ids) in self.short.iter(text) if text else ():
            item = text[last + 1 - length : last + 1]
            if item not in met and _bordered(item, text, last + 1 - length, last + 1):
                met[item], owners[item] = last + 1, ids
        for item, end in met.items():
            yield from ((item_id, 0, end) for item_id in owners[item])

    def _find_long(self, text: str) -> list[tuple]:
        if self.pieces is None:
            return []
        starts: dict[int, list[int]] = {}
        for last, (length, owners) in self.pieces.iter(text):
            for item, offset in owners:
                starts.setdefault(item, []).append(last - length + 1 - offset)
        found = []
        for item, near in sorted(starts.items()):
            item_id, pattern, budget = self.items[item]
            best = (budget + 1, 0)
            for low, high in self._windows(sorted(near), len(pattern), budget):
                low = max(low, 0)
                distance, end = best_match(pattern, text[low:high])
                best = min(best, (distance, low + end))
            if best[0] <= budget:
                found.append((item_id, *best))
        return found

    @staticmethod
    def _windows(starts: list[int], size: int, budget: int) -> Iterator[tuple[int, int]]:
        """Stretches of text in which the item may begin near the starts, overlaps merged."""
        low, high = starts[0] - budget, starts[0] + size + budget
        for start in starts[1:]:
            if start - budget > high:
                yield low, high
                low = start - budget
            high = start + size + budget
        yield low, high


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple]]:
    """The items, in lists of bounded size: all at once if they are small."""
    own = benchmark.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = size // BLOCK_BYTES + 1
    for block in range(n):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block)
        yield [(r.id, r.text) for r in part.collect()]


def mark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    name: str = "leaks",
    edit_rate: float = EDIT_RATE,
    min_piece: int = MIN_PIECE,
) -> DataFrame:
    """The documents with ``name``, an array of (item_id, distance, end): the leaked items.

    An item is leaked if a part of the normalised text is within its edit budget. Budget
    and pieces: an item with k allowed edits is cut into k + 1 pieces, one of which any
    such part contains unchanged; exact hits of pieces come from one pass of an
    Aho-Corasick automaton, and the text around them is compared by Myers' algorithm. Items of
    less than ``MIN_ITEM`` normalised characters, sums and signs among them, have no budget:
    they are leaked if they are there as written, not inside a longer word. A single word of
    letters is not searched.
    Nothing is shuffled. Items beyond ``BLOCK_BYTES`` are searched block by block, the marks of
    one written before the next.

    Null, empty and wordless texts leak at most items that are signs only; null and blank items
    are never found; an item without id is found as one of id null; repeated rows and repeated
    items are handled each on its own. Without items or without documents nothing is marked.
    Other columns stay.
    """
    spark = docs.sparkSession
    reach_package(spark)
    others = docs.columns
    id_kind = benchmark.schema[item_id].dataType
    kind = pa.list_(pa.struct([("item_id", to_arrow_type(id_kind)), ("distance", pa.int32()), ("end", pa.int64())]))
    array = f"array<struct<item_id:{id_kind.simpleString()},distance:int,end:bigint>>"
    marked = docs.withColumn(name, F.array().cast(array))
    schema, scratch = marked.schema, None
    for number, items in enumerate(_blocks(benchmark, item_id, item_text)):
        if number:  # else the workers of one stage would hold all blocks at once
            scratch = scratch or Scratch(spark, "leaks")
            marked = scratch.save(marked, f"marked{number}")
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, edit_rate, min_piece)
            for batch in batches:
                for piece in slices(batch, text_column):
                    leaks = []
                    before = piece.column(name).to_pylist()
                    for text, old in zip(texts_of(piece, text_column).to_pylist(), before, strict=True):
                        new = [dict(zip(("item_id", "distance", "end"), x, strict=True)) for x in matcher.find(text)]
                        leaks.append(old + new)
                    columns = [piece.column(c) for c in others] + [pa.array(leaks, kind)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*others, name])

        marked = marked.mapInArrow(run, schema)
    return marked


def leaked_documents(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """One row per contaminated document: its id, ``contaminated`` (true), ``item_ids``,
    ``n_items`` and ``distance``, the least of its matches. Clean documents have no row.

    Nulls, ties, repeated and missing rows are treated as in ``mark_leaks``; a missing item id is
    one of the ids. Other columns have no part in it.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marked = mark_leaks(own, benchmark, "text", **options).where(F.size("leaks") > 0)
    return marked.select(
        F.col("id").alias(id_column),
        F.lit(True).alias("contaminated"),
        F.array_sort(F.array_distinct("leaks.item_id")).alias("item_ids"),
        F.size(F.array_distinct("leaks.item_id")).alias("n_items"),
        F.array_min("leaks.distance").alias("distance"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, columns unchanged, as often as they are there;
    see ``mark_leaks``. Columns may have any names."""
    name = free_name(docs, "_leaks")
    return mark_leaks(docs, benchmark, name=name, **options).where(F.size(name) == 0).drop(name)
