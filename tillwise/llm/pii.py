"""Personal data: fixed patterns, and identifiers that share the words around them."""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import Scratch, coded_words, slices, texts_of

KINDS = ("email", "ip", "card", "phone")

# A pattern needs so many different seeds to be tried at all, and so much confidence to
# discover others; so does an instance to be reported.
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.6
# Longer words are no context, neither where patterns are made nor where they are searched.
LONGEST_CONTEXT = 64
# What is added to a pattern's judged uses before the share of its entities is taken.
DOUBT = 1.0

# Patterns held by one scan; more are searched in blocks of that many.
BLOCK_PATTERNS = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPACE = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Words, cut behind colons and equal signs; and where a blank cuts them so.
_PART = re.compile(r"[^:=\x20\x09-\x0D]*[:=]+|[^:=\x20\x09-\x0D]+")
_BORDER = r"([:=])([^:=\x20\x09-\x0D])"
# What may be an identifier: a token with a digit or an at sign, an address spelled out, or
# groups of digits.
_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}(?:\s{0,2}(?:[\[(]\s?(?:dot|DOT)\s?[\])]|\s(?:dot|DOT)\s)\s{0,2}[A-Za-z0-9._%+-]{1,64}){0,8}"
    r"\s{0,2}[\[(]?\s?(?:at|AT|@)\s?[\])]?\s{0,2}[A-Za-z0-9-]{1,64}"
    r"(?:(?:\s{0,2}[\[(]?\s?(?:dot|DOT)\s?[\])]?\s{0,2}|\.)[A-Za-z0-9-]{1,64})+"
)
_GROUPS = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){5,18}(?![0-9A-Za-z])")
# A first word that may begin one, and a second word of an address spelled out.
_MARKED = re.compile(r"[0-9@]|at|AT|[\[(](?:dot|DOT)")
_SECOND = re.compile(r"[\[(]?(?:$|at|AT|dot|DOT|@)")
# The next word, cut as _PART does, that is marked or has a second word behind it; the words
# before it are passed over without a step back, up to the end if there is none.
_ONE = r"(?:[^:=\x20\x09-\x0D]*+[:=]++|[^:=\x20\x09-\x0D]++)"
_BEGINNING = (
    r"(?=[^:=\x20\x09-\x0D]*?(?:[0-9@]|at|AT|[\[(](?:dot|DOT))"
    rf"|{_ONE}[\x20\x09-\x0D]*+(?:[\[(]?(?:at|AT|dot|DOT|@)|[\[(](?=[\x20\x09-\x0D]|\Z)))"
)
_BEGINS = re.compile(rf"(?:[\x20\x09-\x0D]*+(?!{_BEGINNING}){_ONE})*+[\x20\x09-\x0D]*+(?:({_ONE})|\Z)")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&="


def _luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = ord(char) - 48
        if i % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with what may stand before it, back to the last match, and a domain."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        at = text.find("@", max(at + 1, floor))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, sorted."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for found in _IP.finditer(text):
        if all(len(part) <= 4096 and int(part) <= 255 for part in found.group().split(".")):
            spans.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        digits = _digits(found.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((found.start(), 2, found.end()))
    for found in _PHONE.finditer(text):
        if 10 <= len(_digits(found.group())) <= 15:
            spans.append((found.start(), 3, found.end()))
    return sorted(spans)


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _context(word: str) -> str:
    """A word as part of a pattern: lower case, outer brackets and quotes gone; empty for words
    with digits and for very long ones."""
    word = word.strip("\"'`()[]{}<>").lower()
    return "" if len(word) > LONGEST_CONTEXT or any(c.isdigit() or c == "@" for c in word) else word


def _before(text: str, start: int) -> list[str]:
    """The patterns that end where a span starts: the word before it, and two words."""
    words: list[str] = []
    end = start
    while len(words) < 2:
        while end > 0 and text[end - 1] in _SPACE + "\"'`([{<":
            end -= 1
        low = end
        while low > 0 and text[low - 1] not in _SPACE and end - low <= 4 * LONGEST_CONTEXT:
            if low < end and text[low - 1] in ":=" and text[low] not in ":=":
                break
            low -= 1
        word = _context(text[low:end])
        if not word:
            break
        words.insert(0, word)
        end = low
    return [" ".join(words[-n:]) for n in range(1, len(words) + 1)]


def _candidate(text: str, start: int) -> tuple[int, int] | None:
    """What stands at a place and looks like an identifier."""
    while start < len(text) and text[start] in _EDGE + _SPACE:
        start += 1
    for shape in (_SPELLED, _GROUPS):
        found = shape.match(text, start)
        if found:
            return found.span()
    found = _WORD.match(text, start)
    if not found:
        return None
    end = found.end()
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    token = text[start:end]
    if len(token) >= 4 and any(c.isdigit() or c == "@" for c in token):
        return start, end
    return None


def _shapes(token: str) -> int:
    """The kinds that a candidate is well-formed enough for, one bit each."""
    digits = len(_digits(token))
    email = "@" in token or bool(_SPELLED.fullmatch(token))
    ip = digits > 0 and len(re.findall("[0-9A-Fa-f]+", token)) >= 4
    return email | ip << 1 | (digits >= 8) << 2 | (digits >= 5) << 3


def _mentions(text: str) -> set[tuple[str, str]]:
    """(pattern, candidate) wherever a candidate stands behind a word, entity or not."""
    out = set()
    first = _WORD.search(text)
    for word in _BEGINS.finditer(text, first.start()) if first else ():
        if word.start(1) > first.start():
            span = _candidate(text, word.start(1))
            if span:
                out.update((p, text[span[0] : span[1]]) for p in _before(text, span[0]))
    return out


def _find_base(docs: DataFrame) -> DataFrame:
    """Per row: counts, spans, the patterns before each entity with what it is, and those
    before each candidate."""
    mention = pa.struct([("pattern", pa.string()), ("entity", pa.string())])
    seed = pa.struct([("pattern", pa.string()), ("kind", pa.int32()), ("entity", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                spans, seeds, mentions = [], [], []
                for text in texts_of(piece, "text").to_pylist():
                    found = base_spans(text)
                    mentions.append([{"pattern": p, "entity": e} for p, e in sorted(_mentions(text))])
                    spans.append([f"{kind}:{start}:{end}" for start, kind, end in found])
                    seeds.append(
                        [
                            {"pattern": p, "kind": kind, "entity": text[start:end]}
                            for start, kind, end in found
                            for p in _before(text, start)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key"),
                        pa.array(spans, pa.list_(pa.string())),
                        pa.array(seeds, pa.list_(seed)),
                        pa.array(mentions, pa.list_(mention)),
                    ],
                    names=["key", "base", "seeds", "mentions"],
                )

    kind = dict(docs.dtypes)["key"]
    schema = (
        f"key {kind}, base array<string>, seeds array<struct<pattern:string,kind:int,entity:string>>, "
        "mentions array<struct<pattern:string,entity:string>>"
    )
    return docs.select("key", "text").mapInArrow(run, schema)


def _pattern_at(
    words: list[str], codes: np.ndarray, sizes: np.ndarray, known: list[str]
) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the texts the known pattern that it is, and that it ends; -1 for none.

    Words and patterns are numbered, so all places are compared at once.
    """
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    contexts = [_context(w) for w in words]
    local: dict[str, int] = {}
    ids = np.array([local.setdefault(c, len(local)) if c else -1 for c in contexts], np.int64)
    single = np.full(len(local) + 1, -1, np.int64)  # the last place stands for no context
    pairs = []
    for number, pattern in enumerate(known):
        first, _, second = pattern.rpartition(" ")
        if second in local:
            if not first:
                single[local[second]] = number
            elif first in local:
                pairs.append((local[first] * len(local) + local[second], number))
    here = ids[codes]
    before = np.full(len(here), -1, np.int64)
    before[1:] = here[:-1]
    starts = np.cumsum(sizes) - sizes
    before[starts[sizes > 0]] = -1
    double = np.full(len(here), -1, np.int64)
    if pairs:
        keys, numbers = (np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True))
        wanted = before * len(local) + here
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = (keys[at] == wanted) & (before >= 0) & (here >= 0)
        double[hit] = numbers[at[hit]]
    return single[here], double


def _maybe_followed(words: list[str], codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the word after a place, or the one behind that, may make an identifier.

    No place that ``_candidate`` would take is left out.
    """
    if not len(codes):
        return np.zeros(0, bool)
    own = np.array([bool(_MARKED.search(w)) for w in words])
    spelled = np.array([bool(_SECOND.match(w)) for w in words])
    last = np.cumsum(sizes) - 1
    last_of = np.repeat(last, sizes)
    place = np.arange(len(codes))
    out = np.zeros(len(codes), bool)
    out[:-1] = own[codes[1:]]
    out &= place < last_of
    two = np.zeros(len(codes), bool)
    two[:-2] = spelled[codes[2:]]
    return out | (two & (place + 1 < last_of))


def _find_uses(docs: DataFrame, patterns: list[str]) -> DataFrame:
    """Uses of the patterns: those followed by a candidate one by one, the others counted.

    Only places with a pattern before what may be an identifier are looked at one by one.
    """
    held = docs.sparkSession.sparkContext.broadcast(sorted(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = texts_of(piece, "text")
                words, codes, sizes = coded_words(pc.replace_substring_regex(texts, _BORDER, r"\1 \2"))
                single, double = _pattern_at(words.to_pylist(), codes, sizes, known)
                maybe = _maybe_followed(words.to_pylist(), codes, sizes)
                plain = np.zeros(len(known), np.int64)
                for at in (single, double):
                    plain += np.bincount(at[(at >= 0) & ~maybe], minlength=len(known))
                places = np.flatnonzero(maybe & ((single >= 0) | (double >= 0)))
                ends = np.cumsum(sizes)
                owners = np.searchsorted(ends, places, side="right")
                keys, found, starts, stops, entities = [], [], [], [], []
                own_keys = piece.column("key")
                for owner in np.unique(owners).tolist():
                    text = texts[owner].as_py()
                    bounds = [m.end() for m in _PART.finditer(text)]
                    first = int(ends[owner] - sizes[owner])
                    for place in places[owners == owner].tolist():
                        ids = [int(at[place]) for at in (single, double) if at[place] >= 0]
                        span = _candidate(text, bounds[place - first])
                        if span is None:
                            plain[ids] += 1
                            continue
                        for i in ids:
                            keys.append(own_keys[owner])
                            found.append(i)
                            starts.append(span[0])
                            stops.append(span[1])
                            entities.append(text[span[0] : span[1]])
                counted = np.flatnonzero(plain)
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k.as_py() for k in keys] + [None] * len(counted), own_keys.type),
                        pa.array([known[i] for i in found] + [known[i] for i in counted], pa.string()),
                        pa.array(entities + [None] * len(counted), pa.string()),
                        pa.array(starts + [None] * len(counted), pa.int32()),
                        pa.array(stops + [None] * len(counted), pa.int32()),
                        pa.array([1] * n + plain[counted].tolist(), pa.int64()),
                        pa.array([_shapes(e) for e in entities] + [0] * len(counted), pa.int32()),
                    ],
                    names=["key", "pattern", "entity", "start", "end", "uses", "shapes"],
                )

    kind = dict(docs.dtypes)["key"]
    schema = f"key {kind}, pattern string, entity string, start int, end int, uses bigint, shapes int"
    return docs.select("key", "text").mapInArrow(run, schema)


def _search(docs: DataFrame, tried: DataFrame, scratch: Scratch, name: str) -> DataFrame | None:
    """The uses of patterns, searched in blocks; None without a pattern."""
    blocks = tried.count() // BLOCK_PATTERNS + 1
    found = None
    for block in range(blocks):
        part = tried.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block)
        patterns = [r.pattern for r in part.collect()]
        if patterns:
            uses = scratch.save(_find_uses(docs, patterns), f"{name}_{block}")
            found = uses if found is None else found.unionByName(uses)
    return found


def _supported(pairs: DataFrame) -> DataFrame:
    """Patterns with enough different entities of one kind, from (pattern, kind, entity)."""
    support = pairs.groupBy("pattern", "kind").agg(F.count_distinct("entity").alias("n"))
    return support.where(F.col("n") >= LEAST_SEEDS).select("pattern").distinct()


def _discover(
    docs: DataFrame, seeds: DataFrame, mentions: DataFrame, scratch: Scratch
) -> tuple[DataFrame, DataFrame] | None:
    """(uses, (entity, kind)): instances that patterns of high confidence point to.

    Patterns and instances are the two sides of a graph. A seed's confidence is 1 for its
    kind. A pattern's confidence for a kind is the confidence of the instances it
    introduces, each counted once a use, out of these and what speaks against it, with some
    doubt added: uses before no candidate, before one that is not well-formed for the kind,
    or before an instance of another kind. Well-formed candidates that nothing is known of
    count neither way. An instance's confidence is the chance that one of its patterns is
    right. Both are computed in turn, from grouped tables; no group is collected. After each
    turn, the words before the instances accepted by then make new patterns, until a turn accepts
    no more instances.
    """
    known = seeds.select("entity", "kind").distinct().withColumn("confidence", F.lit(1.0))
    known = scratch.save(known, "known0")
    tried = scratch.save(_supported(seeds), "tried0")
    uses = _search(docs, tried, scratch, "uses0")
    if uses is None:
        return None
    fits = F.expr("(shiftright(shapes, kind) & 1) = 1")
    turn, n_accepted = 0, -1
    while True:
        turn += 1
        held = uses.where("entity IS NOT NULL").groupBy("pattern", "entity")
        edges = scratch.save(held.agg(F.sum("uses").alias("uses"), F.max("shapes").alias("shapes")), f"edges{turn}")
        misfits = [
            F.sum(F.when(F.expr(f"entity IS NULL OR (shiftright(shapes, {k}) & 1) = 0"), F.col("uses")).otherwise(0))
            for k in range(len(KINDS))
        ]
        totals = scratch.save(uses.groupBy("pattern").agg(F.array(*misfits).alias("against")), f"totals{turn}")
        sure = edges.join(known, "entity").select("pattern", "kind", "shapes", (F.col("uses") * F.col("confidence")).alias("sure"))
        per_kind = [F.sum(F.when(F.col("kind") == k, F.col("sure")).otherwise(0.0)) for k in range(len(KINDS))]
        others = [
            F.sum(F.when(F.expr(f"kind <> {k} AND (shiftright(shapes, {k}) & 1) = 1"), F.col("sure")).otherwise(0.0))
            for k in range(len(KINDS))
        ]
        judged = sure.groupBy("pattern").agg(F.array(*per_kind).alias("right"), F.array(*others).alias("other"))
        judged = judged.join(totals, "pattern").select(
            "pattern", F.posexplode(F.arrays_zip("right", "other", "against")).alias("kind", "n")
        )
        trust = F.col("n.right") / (F.col("n.right") + F.col("n.other") + F.col("n.against") + F.lit(DOUBT))
        patterns = judged.select("pattern", "kind", trust.alias("trust"))
        patterns = scratch.save(patterns.where(F.col("trust") >= LEAST_CONFIDENCE), f"patterns{turn}")
        miss = F.sum(F.log(F.lit(1.0) - F.least("trust", F.lit(0.999))))
        reached = edges.join(patterns, "pattern").where(fits).groupBy("entity", "kind").agg(miss.alias("miss"))
        reached = reached.select("entity", "kind", (F.lit(1.0) - F.exp("miss")).alias("confidence"))
        best = known.unionByName(reached).groupBy("entity", "kind").agg(F.max("confidence").alias("confidence"))
        known = scratch.save(best, f"known{turn}")
        accepted = known.where(F.col("confidence") >= LEAST_CONFIDENCE).select("entity", "kind")
        # Confidences only rise, so the accepted instances settle, and with them the patterns.
        before, n_accepted = n_accepted, accepted.count()
        if n_accepted == before:
            break
        pairs = seeds.select("pattern", "kind", "entity").unionByName(
            mentions.join(accepted, "entity").select("pattern", "kind", "entity")
        )
        fresh = scratch.save(_supported(pairs).join(tried, "pattern", "left_anti"), f"fresh{turn}")
        tried = tried.unionByName(fresh)
        more = _search(docs, fresh, scratch, f"uses{turn}")
        uses = uses if more is None else uses.unionByName(more)
    chosen = known.where(F.col("confidence") >= LEAST_CONFIDENCE).groupBy("entity")
    return uses, chosen.agg(F.min_by("kind", F.struct(-F.col("confidence"), F.col("kind"))).alias("kind"))


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256``, ``spans`` and ``n_discovered``.

    The fixed patterns give the counts, the hash and the seeds. The one or two words before
    at least ``LEAST_SEEDS`` different seeds, or instances accepted since, are patterns; all
    their uses in all documents are found, and identifiers they introduce with high confidence are added to
    the spans, under the pattern's kind, where they do not touch a span found before.

    Null and empty texts have no spans; repeated rows have equal results; rows are told apart
    inside by id and text, so a null or repeated id does no harm. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    own = docs.select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text")).alias("key"),
        F.col(text_column).alias("text"),
    )
    base = scratch.save(_find_base(own), "base")
    seeds = base.where(F.size("seeds") > 0).select(F.explode("seeds").alias("seed")).select("seed.*")
    seeds = scratch.save(seeds.groupBy("pattern", "kind", "entity").agg(F.count(F.lit(1)).alias("n")), "seeds")
    mentions = base.where(F.size("mentions") > 0).select(F.explode("mentions").alias("mention")).select("mention.*")
    mentions = scratch.save(mentions.distinct(), "mentions")
    added = None
    found = _discover(own, seeds, mentions, scratch)
    if found:
        uses, entities = found
        places = uses.where("entity IS NOT NULL").select("key", "entity", "start", "end").distinct()
        spans = places.join(entities, "entity").select("key", F.struct("start", "kind", "end").alias("span"))
        added = scratch.save(spans.groupBy("key").agg(F.collect_set("span").alias("added")), "added")
    scratch.release()
    joined = base.select("key", "base")
    if added is None:
        joined = joined.withColumn("added", F.lit(None).cast("array<struct<start:int,kind:int,end:int>>"))
    else:
        joined = joined.withColumnRenamed("key", "row").join(
            added, F.col("row").eqNullSafe(F.col("key")), "left"
        ).drop("key").withColumnRenamed("row", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_discovered")}
            for coded, extra in zip(batch.column("base").to_pylist(), batch.column("added").to_pylist(), strict=True):
                spans = [(start, kind, end) for kind, start, end in (map(int, x.split(":")) for x in coded)]
                for kind, name in enumerate(KINDS):
                    rows[f"n_{name}"].append(sum(s[1] == kind for s in spans))
                rows["base_sha256"].append(hashlib.sha256(as_text(spans).encode()).hexdigest())
                merged = merge(spans, [(x["start"], x["kind"], x["end"]) for x in extra or []])
                rows["spans"].append(as_text(merged))
                rows["n_discovered"].append(len(merged) - len(spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").field("id"),
                    *(pa.array(rows[f"n_{k}"], pa.int64()) for k in KINDS),
                    pa.array(rows["base_sha256"], pa.string()),
                    pa.array(rows["spans"], pa.string()),
                    pa.array(rows["n_discovered"], pa.int64()),
                ],
                names=["id", *rows],
            )

    kind = dict(docs.dtypes)[id_column]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    schema = f"id {kind}, {counts}, base_sha256 string, spans string, n_discovered bigint"
    return joined.select("key", "base", "added").mapInArrow(run, schema).withColumnRenamed("id", id_column)


def merge(base: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All base spans, and those added ones, from the left, that touch none taken before."""
    # Base spans of different kinds may overlap: what they cover together, from the left.
    covered: list[list[int]] = []
    for start, _, end in sorted(base):
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    taken, at, floor = list(base), 0, 0
    for start, kind, end in sorted(set(added)):
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if start >= floor and (at == len(covered) or end <= covered[at][0]):
            taken.append((start, kind, end))
            floor = end
    return sorted(taken)
