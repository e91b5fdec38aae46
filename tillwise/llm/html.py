"""Main text of web pages by line-block distribution."""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwise.llm.common import slices, texts_of

# Blocks in a sliding window, text in a window that a surge needs, and the share of a
# block's text inside links from which the block counts as navigation.
WINDOW = 3
SURGE = 80
LINK_SHARE = 0.5
# A run dives where a window has less than this share of the run's fullest, and a container
# holds no part of the article with less than that share of the text of the fullest one.
DIVE_SHARE = 0.1
# How many times text outside must outweigh that in article and main to be kept as well, and
# to be kept alone.
BESIDE_MARKED, INSTEAD_OF_MARKED = 2, 8

# Elements whose content is no text, elements that hold something other than the article,
# and elements without content.
_HIDDEN = frozenset(
    "script style noscript template svg math canvas iframe object audio video head title select datalist".split()
)
_RAW = frozenset("script style title textarea noscript iframe".split())
_ASIDE = frozenset("nav header footer aside form menu dialog button fieldset textarea".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
# Closed by the end of any element around them.
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Names of classes and ids, by word, of what is not the article.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar side widget widgets related recommended footer foot header masthead topbar "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login share sharing "
    "social comment comments commentlist reply replies respond disqus pagination pager tags toolbar skip".split()
)
# Those of them that name parts of an article as well: inside article and main, the text of such
# an element decides.
_DOUBTFUL = frozenset(
    "banner promotion side foot footer header masthead topbar notice notices widget widgets share sharing social tags "
    "toolbar skip overlay".split()
)
# How a sentence ends, and words that it needs; what no sentence of an article says.
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*\Z")
_SENTENCE_WORDS = 8
_LEGAL = re.compile(r"©|\(c\)|copyright|all rights|cookie|privacy|terms of|newsletter|subscribe", re.I)
_MAIN = frozenset("article main".split())
_CONTAINERS = frozenset("div section td th header footer aside body html".split())
_ROOTS = frozenset("body html".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_NAME_PARTS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


def _is_aside(tag: str, attributes: str, inside_main: bool) -> bool | None:
    """Whether an element holds something beside the article; None if its text has to decide."""
    if tag in _ASIDE and not (tag == "header" and inside_main):
        return True
    doubtful = False
    if not attributes or tag in ("body", "html"):
        return False
    for found in _ATTRIBUTE.finditer(attributes):
        name = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id") and tag not in _MAIN:
            words = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            met = _NAMES.intersection(w.lower() for w in _NAME_PARTS.findall(words))
            if met and not (inside_main and met <= _DOUBTFUL):
                return True
            doubtful = doubtful or bool(met)
    return None if doubtful else False


class _Open(NamedTuple):
    """An open element, with what holds inside it: of all elements around it, itself included."""

    tag: str
    hidden: bool = False
    aside: bool = False
    main: bool = False
    links: int = 0
    heading: bool = False
    doubtful: int = 0  # number of the outermost element whose text has to decide
    around: int = 0  # numbers of the innermost container and of the one around it
    outer: int = 0
    holds_text: bool = False  # no element that starts a line lies inside the innermost container

    def inside(self, tag: str, is_aside: bool | None, number: int) -> "_Open":
        inner = tag in _CONTAINERS and tag not in _ROOTS
        return _Open(
            tag,
            self.hidden or tag in _HIDDEN,
            self.aside or is_aside is True,
            self.main or tag in _MAIN,
            self.links + (tag == "a"),
            self.heading or tag in _HEADINGS,
            self.doubtful or (number if is_aside is None else 0),
            number if inner else self.around,
            self.around if inner else self.outer,
            inner or (self.holds_text and tag in _INLINE),
        )

    def container(self) -> int:
        """Elements that hold text directly are paragraphs of the container around them."""
        if self.main:
            return -1
        return self.outer if self.holds_text and self.outer else self.around


class _Block:
    __slots__ = ("parts", "linked", "at")

    def __init__(self, at: _Open):
        self.parts: list[str] = []
        self.linked = 0
        self.at = at


def blocks_of(page: str) -> list[tuple[str, int, bool, bool, int, bool]]:
    """The lines of a page without markup: (text, characters in links, in the article, beside it,
    number of the container, in a heading).

    Elements that hold text directly are paragraphs of the container around them, if there is
    one inside the body. All of article and main is one container.

    Block elements and their ends begin a new line, so do the ends of elements left open; a
    line break inside a block is white space.
    """
    done: list[_Block] = []
    bottom = _Open("")
    stack: list[_Open] = []
    open_tags: Counter[str] = Counter()
    at = bottom
    number = 0
    block = _Block(at)
    place = 0

    def cut() -> None:
        nonlocal block
        if block.parts:
            done.append(block)
        block = _Block(at)

    def close(count: int) -> None:
        """Close the innermost elements."""
        nonlocal at
        for _ in range(count):
            open_tags[stack.pop().tag] -= 1
        at = stack[-1] if stack else bottom

    def text(raw: str) -> None:
        if at.hidden or not raw:
            return
        clear = unescape(raw)
        block.parts.append(clear)
        if at.links:
            block.linked += len(_SPACE.sub("", clear))

    while place < len(page):
        found = _MARKUP.search(page, place)
        if not found:
            text(page[place:])
            break
        text(page[place : found.start()])
        place = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            if found.group().startswith("<![CDATA[") and not at.hidden:
                block.parts.append(found.group()[9:].removesuffix("]]>"))
            continue
        inline = tag in _INLINE
        if found[1]:
            if open_tags[tag]:
                count = 1
                while stack[-count].tag != tag:
                    count += 1
                close(count)
            if not inline or block.at.aside != at.aside:
                cut()
            continue
        attributes = found[3] or ""
        if tag == "br" or tag == "wbr":
            text(" " if tag == "br" else "")
            continue
        if tag in _VOID:
            if not inline:
                cut()
            continue
        # A new paragraph or list item ends an open one, and what is open inside it.
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") or (not inline and at.tag == "p"):
            if open_tags[tag] or open_tags["p"]:
                for count, element in enumerate(reversed(stack), 1):
                    if element.tag in (tag, "p"):
                        close(count)
                        break
                    if element.tag not in _INLINE:
                        break
        if tag in _RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, place)
            place = end.end() if end else len(page)
            if not inline:
                cut()
            continue
        number += 1
        was = at.aside
        at = at.inside(tag, _is_aside(tag, attributes, at.main), number)
        stack.append(at)
        open_tags[tag] += 1
        if not inline or at.aside != was:
            cut()
    if block.parts:
        done.append(block)
    out = []
    doubtful: dict[int, list[int]] = {}
    for b in done:
        line = _SPACE.sub(" ", "".join(b.parts)).strip()
        if line:
            out.append((line, b))
            if b.at.doubtful:
                sums = doubtful.setdefault(b.at.doubtful, [0, 0, 0])
                for i, n in enumerate((len(line.replace(" ", "")), b.linked, b.at.heading)):
                    sums[i] += n
    # Little text, or mostly links, and no heading: a bar beside the article, not a part of it.
    bars = {k for k, (size, linked, heads) in doubtful.items() if not heads and (size < SURGE or linked >= LINK_SHARE * size)}
    return [
        (line, b.linked, b.at.main, b.at.aside or b.at.doubtful in bars, b.at.container(), b.at.heading) for line, b in out
    ]


def stretches(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Runs [start, end) of lines between a surge and the dive after it.

    The text of each line and the window of lines around it is summed. A run begins where
    text surges, that is at a line with text whose sum reaches ``surge``, and goes back
    over lines with text; it dives at the first line without any, or whose window has less
    than ``DIVE_SHARE`` of the fullest one of the run.
    """
    half = window // 2
    sums = [sum(lengths[max(0, i - half) : i + half + 1]) for i in range(len(lengths))]
    runs, at, floor = [], 0, 0
    while at < len(lengths):
        if not lengths[at] or sums[at] < surge:
            at += 1
            continue
        start = end = at
        while start > floor and lengths[start - 1]:
            start -= 1
        most = 0
        while end < len(lengths) and lengths[end] and sums[end] >= DIVE_SHARE * most:
            most = max(most, sums[end])
            end += 1
        runs.append((start, end))
        at = floor = end
    return runs


def _weighed(lines: list[tuple[str, int, bool, bool, int, bool]]) -> list[int]:
    """The text of each line that may belong to the article, 0 for others.

    Article and main elements are weight for what is inside, against the fullest container
    outside: the markup is evidence as good as a window full of text.
    """
    sizes = [len(line[0].replace(" ", "")) for line in lines]
    inside, outside = 0, {}
    for size, (_, linked, main, aside, container, _) in zip(sizes, lines, strict=True):
        if main and not aside:
            inside += size
        elif not aside and linked < LINK_SHARE * size:
            outside[container] = outside.get(container, 0) + size
    most = max(outside.values(), default=0)
    lengths = []
    for size, (_, linked, main, aside, container, _) in zip(sizes, lines, strict=True):
        if aside:
            lengths.append(0)
        elif main:
            lengths.append(size + SURGE if most < INSTEAD_OF_MARKED * inside else 0)
        elif linked >= LINK_SHARE * size or outside[container] < BESIDE_MARKED * inside:
            lengths.append(0)
        else:
            lengths.append(size)
    return lengths


def _is_sentence(line: str) -> bool:
    return bool(_SENTENCE_END.search(line)) and line.count(" ") >= _SENTENCE_WORDS - 1 and not _LEGAL.search(line)


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty if there is none.

    Text between the surges and dives of the line lengths is the article, or, if no window
    has that much, the longest run. Lines beside the article, and those that are mostly links
    outside of article and main, count as empty. Of the containers that such runs touch, those with
    much text are kept, or with nothing but sentences, with their short lines, headings before them
    and what lies between. The time grows with the length of the page, however deep it nests.
    """
    lines = blocks_of(page or "")
    lengths = _weighed(lines)
    runs = stretches(lengths)
    if not runs and any(lengths):
        runs = stretches(lengths, surge=1)
        runs = [max(runs, key=lambda run: sum(lengths[run[0] : run[1]]))]
        return "\n".join(lines[i][0] for a, b in runs for i in range(a, b))
    held: dict[int, int] = {}
    for a, b in runs:
        for i in range(a, b):
            held[lines[i][4]] = held.get(lines[i][4], 0) + lengths[i]
    most = max(held.values(), default=0)
    texts: dict[int, list[str]] = {}
    for i, line in enumerate(lines):
        if lengths[i] and line[4] in held:
            texts.setdefault(line[4], []).append(line[0])
    article = {
        c for c, own in texts.items()
        if held[c] == most or c == -1 or (
            not all(map(_LEGAL.search, own)) and (held[c] >= DIVE_SHARE * most or all(map(_is_sentence, own)))
        )
    }
    kept = [i for i in range(len(lines)) if lengths[i] and lines[i][4] in article]
    if not kept:
        return ""
    first, last = kept[0], kept[-1]
    while first and lengths[first - 1] and lines[first - 1][5]:
        first -= 1
    return "\n".join(lines[i][0] for i in range(first, last + 1) if lengths[i])


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per page: its id and url, ``text`` and ``n_chars``.

    Null, empty and textless pages have an empty text. Each page is handled on its own,
    whole, however long; repeated rows give repeated results; a null id or url stays null; other columns
    are ignored. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "html"):
                found = [main_text(page) for page in texts_of(piece, "html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("url"), pa.array(found, pa.string())], names=["id", "url", "text"]
                )

    own = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    kind = dict(own.dtypes)["id"]
    found = own.mapInArrow(run, f"id {kind}, url string, text string")
    return found.select(
        F.col("id").alias(id_column),
        F.col("url").alias(url_column),
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )
