"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  A word scores positively and a tag negatively; the weights are
log-odds of standing in the content or around it, counted on pages that mark their content themselves (an
``article`` or ``main`` element).  One linear scan finds the contiguous run of tokens with the largest sum.  The
element that holds this run is the article; parts of it that are no article text by their element, role or class
(menus, adverts, forms, comments ...) are left out.

A name speaks against an element as a whole class: ``sidebar`` or ``cookie-banner``, all of whose words mean such a part or
say where it stands, but not ``no-sidebar`` or ``share-price``.  It never speaks against an element that holds nearly
all words of a page without an article beside it, and an id neither against headings nor, but for reader comments, against sections and paragraphs.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the weights are counted on, about.
LABELLED_PAGES = 20_000

# Names of HTML elements by what they mean to a reader.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dt dd table tbody thead tr td th figcaption".split())
BOILERPLATE = frozenset(
    "head nav footer aside form button select option script style textarea title noscript iframe noembed noframes "
    "template svg canvas audio video object dialog menu datalist input".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login sidebar sidebars "
    "menu navbar nav navigation breadcrumb breadcrumbs footer comment comments disqus discussion replies respond share "
    "sharing social related recommended widget widgets pagination pager toolbar masthead skip hidden".split()
)
#: Words that only say where a part stands or how it is built.
NEUTRAL_NAMES = frozenset(
    "site page main top bottom left right center centre box bar wrap wrapper container inner outer area block section list "
    "item items link links thread form slot unit panel header global primary secondary desktop mobile small large sticky "
    "fixed body content posts post articles stories btn button buttons text".split()
)
COMMENT_NAMES = frozenset("comment comments disqus respond replies".split())
TAGS = frozenset(INLINE | VOID | ENDS_PARAGRAPH | TEXT_BLOCKS | BOILERPLATE | {"body", "html", "caption"})

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


#: In the place of a block number: words that belong to no article, a tag.
DROPPED, TAG = -2, -1


@dataclass
class Element:
    tag: str
    parent: int
    dropped: bool
    by_name: bool = False
    words: int = 0


@dataclass
class Page:
    """Elements, blocks of text and the tokens in page order: (tag, block or DROPPED or TAG, words)."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)
    tokens: list[tuple[str, int, int]] = field(default_factory=list)


def _part_name(token: str, in_article: bool) -> bool:
    """Whether a class or id names a part that is no article text."""
    words = {w.lower() for w in _WORDS_OF_NAME.findall(token) if not w.isdigit()}
    if words & BOILERPLATE_NAMES:
        return words <= BOILERPLATE_NAMES | NEUTRAL_NAMES
    return "header" in words and not in_article and words <= NEUTRAL_NAMES and not words & {"post", "content"}


def _named(tag: str, attributes: str, in_article: bool) -> bool:
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in BOILERPLATE_ROLES:
            return True
        if name == "class" and any(_part_name(token, in_article) for token in value.split()):
            return True
        if name == "id" and tag not in ("h1", "h2", "h3", "h4", "h5", "h6") and _part_name(value, in_article):
            if tag not in ("section", "p", "article", "main") or {w.lower() for w in _WORDS_OF_NAME.findall(value)} & COMMENT_NAMES:
                return True
    return False


def _hidden(attributes: str) -> bool:
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _boilerplate(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no article text, and whether only its name says so."""
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return True, False
    if not attributes or tag in ("html", "body", "main"):
        return False, False
    if tag == "article":
        classes = [w.lower() for w in _WORDS_OF_NAME.findall(attributes)]
        return ("comment" in classes or "comments" in classes) and _named(tag, attributes, in_article), True
    if _hidden(attributes):
        return True, False
    return _named(tag, attributes, in_article), True


def parse(source: str) -> Page:
    """The page without its surroundings.  A name does not count on an element that holds nearly all words, unless an
    article or main element stands outside."""
    page = _parsed(source, frozenset())
    named = [i for i, e in enumerate(page.elements) if e.by_name]
    if not named:
        return page
    totals = [e.words for e in page.elements]
    for i in range(len(totals) - 1, -1, -1):
        if (parent := page.elements[i].parent) >= 0:
            totals[parent] += totals[i]
    whole = sum(e.words for e in page.elements)
    large = frozenset(i for i in named if 10 * (whole - totals[i]) < whole)
    if not large or any(
        totals[i] and e.tag in ("article", "main") and not e.by_name and not large & set(_ancestors(page, i))
        for i, e in enumerate(page.elements)
    ):
        return page
    return _parsed(source, large)


def _parsed(source: str, kept: frozenset[int]) -> Page:
    """One pass over the page; unclosed elements, stray end tags and cut-off pages are taken as browsers take them.

    ``kept`` are numbers of elements whose names do not count.  Words inside elements that are no text whatever their
    name are not counted in ``words``.
    """
    page, stack, run = Page(), [], []
    by_tag: list[bool] = []     # of each element: no text whatever the names
    block_of = -1
    at, end, quotes_end = 0, len(source), {'"': False, "'": False}

    def close() -> None:
        nonlocal run
        text = " ".join("".join(run).split())
        if text and block_of >= 0:
            page.tokens.append(("", len(page.blocks), text.count(" ") + 1))
            page.blocks.append((block_of, text))
        run = []

    def top() -> int:
        return stack[-1] if stack else -1

    def pop(to: int) -> None:
        while len(stack) > to:
            stack.pop()

    while at < end:
        start = source.find("<", at)
        stop = end if start < 0 else start
        if stop > at:
            if not stack or not page.elements[stack[-1]].dropped:
                if not run:
                    block_of = next((i for i in reversed(stack) if page.elements[i].tag not in INLINE), -1)
                    if block_of < 0:
                        page.elements.append(Element("body", -1, False))
                        by_tag.append(False)
                        stack.append(len(page.elements) - 1)
                        block_of = stack[-1]
                run.append(html.unescape(source[at:stop]))
                page.elements[stack[-1]].words += len(source[at:stop].split())
            elif words := len(source[at:stop].split()):
                page.tokens.append(("", DROPPED, words))
                if not by_tag[stack[-1]]:
                    page.elements[stack[-1]].words += words
            at = stop
            continue
        if source.startswith("<!--", start):
            stop = source.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        closing = source.startswith("</", start)
        name = _NAME.match(source, start + 1 + closing)
        if not name:
            if source.startswith(("<!", "<?", "</"), start):
                stop = source.find(">", start)
                at = end if stop < 0 else stop + 1
            else:  # a plain "<" in a text
                if run or (stack and not page.elements[stack[-1]].dropped):
                    if not run:
                        block_of = next((i for i in reversed(stack) if page.elements[i].tag not in INLINE), -1)
                    run.append("<")
                at = start + 1
            continue
        tag, stop = name.group().lower(), name.end()
        begin = stop
        while stop < end and source[stop] != ">":
            character = source[stop]
            if character in quotes_end and source[stop - 1] == "=" and not quotes_end[character]:
                found = source.find(character, stop + 1)
                quotes_end[character] = found < 0
                stop = found if found >= 0 else stop
            stop += 1
        attributes, at = source[begin:stop], min(stop + 1, end)
        if tag == "br":
            run.append(" ")
            continue
        if tag not in INLINE:
            close()
        page.tokens.append((tag if tag in TAGS else "other", TAG, 0))
        if closing:
            held = next((i for i in range(len(stack) - 1, -1, -1) if page.elements[stack[i]].tag == tag), None)
            if held is not None:
                pop(held)
            continue
        if tag in ENDS_PARAGRAPH:
            held = next((i for i in range(len(stack) - 1, -1, -1) if page.elements[stack[i]].tag not in INLINE), None)
            if held is not None and page.elements[stack[held]].tag == "p":
                pop(held)
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"li"} if tag == "li" else {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            for i in range(len(stack) - 1, -1, -1):
                held = page.elements[stack[i]].tag
                if held in same:
                    pop(i)
                    break
                if held in ("ul", "ol", "dl", "table", "tbody", "select", "div", "section", "article", "body"):
                    break
        if tag in VOID:
            continue
        parent = top()
        inside = any(page.elements[i].tag in ("article", "main") for i in stack)
        dropped, by_name = _boilerplate(tag, attributes, inside)
        sure = (dropped and not by_name) or (parent >= 0 and by_tag[parent])
        by_name &= dropped
        dropped = (dropped and not (by_name and len(page.elements) in kept)) or (parent >= 0 and page.elements[parent].dropped)
        if tag in RAW:
            ending = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            if ending is None:
                at = end
            else:
                shut = source.find(">", ending.end())
                at = end if shut < 0 else shut + 1
            page.tokens.append((tag, TAG, 0))
            continue
        page.elements.append(Element(tag, parent, dropped, by_name))
        by_tag.append(sure)
        stack.append(len(page.elements) - 1)
    close()
    return page


def _ancestors(page: Page, element: int) -> list[int]:
    found = []
    while element >= 0:
        found.append(element)
        element = page.elements[element].parent
    return found[::-1]


def _inside(page: Page, element: int, names: tuple[str, ...]) -> int:
    """The innermost element of those names around a place, -1 for none."""
    while element >= 0 and page.elements[element].tag not in names:
        element = page.elements[element].parent
    return element


def labelled_counts(source: str) -> Counter:
    """(token, in content) -> number, for a page that marks its content; empty for others."""
    page = parse(source)
    marked = {_inside(page, e, ("article", "main")) for e, _ in page.blocks} - {-1}
    if len(marked) != 1:
        return Counter()
    counts: Counter = Counter()
    content = [i for i, (kind, b, _) in enumerate(page.tokens) if b >= 0 and _inside(page, page.blocks[b][0], ("article", "main")) >= 0]
    first, last = content[0], content[-1]
    for i, (tag, b, words) in enumerate(page.tokens):
        counts[(tag or "word", first <= i <= last)] += 1 if b == TAG else words
    return counts


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """A positive weight for words and a negative one for each tag, log-odds of standing in the content."""
    inside = sum(n for (_, c), n in counts.items() if c)
    outside = sum(n for (_, c), n in counts.items() if not c)

    def odds(token: str) -> float:
        a, b = counts.get((token, True), 0), counts.get((token, False), 0)
        return math.log((a + 1) / (inside + 2)) - math.log((b + 1) / (outside + 2))

    weights = {tag: min(odds(tag), -0.5) if (tag, True) in counts or (tag, False) in counts else -2.0 for tag in TAGS | {"other"}}
    weights["word"] = max(odds("word"), 0.3)
    return weights


def best_run(page: Page, weights: dict[str, float]) -> tuple[int, int] | None:
    """First and last block of the run of tokens with the largest sum; the first of equal runs."""
    best, best_run_, total, start = 0.0, None, 0.0, None
    for tag, block, words in page.tokens:
        if block == DROPPED:
            continue
        total += words * weights["word"] if block >= 0 else weights[tag]
        if total <= 0:
            total, start = 0.0, None
        elif block >= 0:
            start = block if start is None else start
            if total > best:
                best, best_run_ = total, (start, block)
    return best_run_


def _outermost(page: Page, element: int, name: str) -> int:
    return next((a for a in _ancestors(page, element) if page.elements[a].tag == name), -1)


def _holder(page: Page, element: int) -> int:
    """The innermost element around a place that is more than a block of text, -1 for the page itself."""
    while element >= 0 and (page.elements[element].tag in TEXT_BLOCKS or page.elements[element].tag in INLINE):
        element = page.elements[element].parent
    return -1 if element < 0 or page.elements[element].tag in ("body", "html") else element


def _completed(page: Page, first: int, last: int, marked: list[int]) -> tuple[int, int]:
    """The run with the elements in which it begins and ends: marked ones, or the innermost that hold its blocks.

    Words of the page itself, in no element of their own, are left off where the run has them beyond all marked ones.
    """
    loose = lambda b: page.elements[page.blocks[b][0]].tag in ("body", "html")
    while marked[first] < 0 and loose(first):
        first += 1
    while marked[last] < 0 and loose(last):
        last -= 1
    text = lambda b: page.elements[page.blocks[b][0]].tag in TEXT_BLOCKS and marked[b] < 0
    ends = []
    for at, step in ((first, -1), (last, 1)):
        edge = marked[at] if marked[at] >= 0 else _holder(page, page.blocks[at][0])
        inside = (lambda b: edge in _ancestors(page, page.blocks[b][0])) if edge >= 0 else text  # noqa: B023
        while 0 <= at + step < len(page.blocks) and inside(at + step):
            at += step
        ends.append(at)
    return ends[0], ends[1]


def extract(source: str, weights: dict[str, float]) -> str:
    """Blocks of the article, two line ends between them.

    The run with the largest sum sets the bounds; elements complete it at both ends.
    """
    page = parse(source)
    run = best_run(page, weights)
    if run is None:
        return ""
    first, last = run
    for name in ("article", "main"):
        marked = [_outermost(page, e, name) for e, _ in page.blocks]
        if any(m >= 0 for m in marked[first : last + 1]):
            first, last = _completed(page, first, last, marked)
            return "\n\n".join(t for _, t in page.blocks[first : last + 1])
    paths = [_ancestors(page, page.blocks[b][0]) for b in range(first, last + 1)]
    common = [a for a, *others in zip(*paths) if all(o == a for o in others)]
    holder = _holder(page, common[-1] if common else -1)
    if holder >= 0:
        chosen = [t for e, t in page.blocks if holder in _ancestors(page, e)]
    else:
        text = lambda b: page.elements[page.blocks[b][0]].tag in TEXT_BLOCKS
        while first > 0 and text(first - 1):
            first -= 1
        while last + 1 < len(page.blocks) and text(last + 1):
            last += 1
        chosen = [t for _, t in page.blocks[first : last + 1]]
    return "\n\n".join(chosen)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for source in batch.column(0):
            counts += labelled_counts(source.as_py())
    yield pa.record_batch({
        "token": pa.array([k[0] for k in counts], pa.string()), "content": pa.array([k[1] for k in counts], pa.bool_()),
        "n": pa.array(list(counts.values()), pa.int64()),
    })


def fit(pages: DataFrame, html_column: str = "html", labelled_pages: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights of tokens from pages that mark their content, about ``labelled_pages`` of them, picked by a hash.

    There is one row for each element name of HTML, whatever the pages hold.
    """
    marked = pages.select(pages[html_column].cast("string").alias("html")).where(
        F.col("html").contains("<article") | F.col("html").contains("<main")
    )
    share = min(1.0, labelled_pages / max(marked.count(), 1))
    hashed = F.shiftrightunsigned(F.xxhash64("html"), 1)
    picked = marked if share >= 1 else marked.where(hashed < F.lit(int(share * float(1 << 63))))
    counted = picked.mapInArrow(_count, "token string, content boolean, n bigint").groupBy("token", "content").agg(F.sum("n"))
    return weights_of({(token, content): n for token, content, n in counted.collect()})


def _extracted(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(x.as_py(), weights) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["id", "url", "text", "n_chars"],
                )

    return run


def main_text(
    pages: DataFrame, weights: dict[str, float] | None = None,
    id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``.

    Character references are decoded, white space inside a block becomes one space.  A null, empty or wordless page
    gives an empty text.  Null ids and urls and repeated rows are kept; an empty table gives no rows.  Other
    columns are ignored.
    """
    weights = weights or fit(pages, html_column)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]
    rows = pages.select(
        pages[id_column].alias("id"), pages[url_column].alias("url"),
        F.coalesce(pages[html_column].cast("string"), F.lit("")).alias("html"),
    )
    done = rows.mapInArrow(_extracted(weights), f"id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
    return done.withColumnsRenamed({"id": id_column, "url": url_column})
