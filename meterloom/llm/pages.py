"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from the root to its
leaf. Text length, punctuation and link text are summed by path and divided by the path's blocks;
the ratios are smoothed along the page, fused into one score, and the paths whose score passes a
share of the page's deviation hold the content: their blocks are the text. Other blocks
stay if they have few links and lie between the first and the last of these, in the same <article> or
<main> as one of these, or are the heading above the first. Elements that name themselves as something
else (menus, forms, notices, reader comments and the like) and hold no <article> or <main>, and on a
page without these not most of what scores highly, are scored apart and lowered; they go unless they
still pass.

Pages are read one by one inside tasks; a page of any length is read in one pass. Paths are numbers,
and what an element takes from those around it is noted once per element, so the time goes with the
page's length and not with its depth.

Defined cases: a null or empty page, or one without text, has an empty text; unclosed elements end
with their parent or the page; a quote that does not follow "=" is an ordinary character, and a tag whose last
value is not closed ends at the next ">"; a tag with no ">" after it is dropped with the rest of the page; repeated
rows and ids are handled row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import statistics
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import mapped

#: Elements that begin and end blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript template xmp iframe".split())
#: Elements whose text a page does not show, or shows as a control.
UNSEEN = frozenset("button datalist head iframe input noscript option script select style svg template textarea title".split())
#: Elements that say they hold something else than the article.
ASIDE = frozenset("aside dialog footer form menu nav".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Names that say so as a whole id or class, alone or with each other ("ad", "cookie-notice", not "has-sidebar").
NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promotion reactions related replies respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Names that an article's own head may have.
HEADS = frozenset("header masthead banner".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the same kind, looked for up to the given parents.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: An attribute as HTML reads it: a quote opens a value only directly after "=".
ATTRIBUTE = re.compile(
    r"[ \t\n\f\r/]*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)"
    r"(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(\"[^\"]*+\"|'[^']*+'|[^ \t\n\f\r\"'>][^ \t\n\f\r>]*+))?+"
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)((?:" + re.sub(r"\((?!\?)", "(?:", ATTRIBUTE.pattern) + r")*+)[ \t\n\f\r/]*+>",
    re.S,
)
#: What is left of a tag that :data:`TOKEN` does not match: it ends at the next bracket.
BROKEN = re.compile(r"<(/?)([a-zA-Z][^ \t\n\f\r/>]*+)([^>]*+)>", re.S)
START = re.compile(r"<[a-zA-Z/!?]")
PUNCTUATION = re.compile(r"[.,;:!?。，！？]")

#: Weights of a block's neighbours in smoothing, by distance.
KERNEL = (1.0, 0.6, 0.15)
#: Share of the deviation of the scores that a content path passes.
PASS = 0.8
#: Share of link text up to which a block that does not pass stays between those that do.
LINKED = 0.5
#: Blocks that may stand between a heading and the first block that passes.
LEAD = 3
#: What is left of a path's score under an element that names itself as something else.
LOWERED = 0.05


@dataclass(eq=False)
class Element:
    name: str
    parent: Element | None
    #: Number of its path of block elements.
    path: int
    unseen: bool
    named: bool
    block: bool
    #: Whether an article or main element is inside.
    holds: bool = False
    strong: bool = False
    #: What :func:`settle` notes: an element around it (or itself) that names itself as something
    #: else and holds no article; whether all of these, and whether an article around it, are strong.
    aside: bool = False
    excused: bool = True
    covered: bool = False

    def __post_init__(self) -> None:
        parent = self.parent
        self.leaf: Element = self if self.block or parent is None else parent.leaf
        self.linked = not self.block and (self.name == "a" or (parent is not None and parent.linked))
        self.heading = self.name in HEADINGS or (parent is not None and parent.heading)
        on_path = self.block and self.name.startswith(("article", "main"))
        self.in_article = on_path or (parent is not None and parent.in_article)


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    links: int = 0
    text: str = ""

    @property
    def fits(self) -> bool:
        """Whether it may stand with strong blocks: few links, and no such name without strong text."""
        return self.links <= LINKED * len(self.text) and self.element.excused

    @property
    def path(self) -> tuple[int, bool]:
        """What its score goes by: text under such a name is apart from other text on the same path."""
        return self.element.path, self.element.aside


def _elements(page: list[Block]) -> list[Element]:
    """The elements around these blocks, each once, parents first."""
    seen: set[Element] = set()
    found: list[Element] = []
    for block in page:
        at, chain = block.element, []
        while at is not None and at not in seen:
            seen.add(at)
            chain.append(at)
            at = at.parent
        found += reversed(chain)
    return found


def settle(elements: list[Element]) -> None:
    """Note for each element what those around it say, as ``holds`` and ``strong`` are now."""
    for at in elements:
        up, other = at.parent, at.named and not at.holds
        at.aside = other or (up is not None and up.aside)
        at.excused = (not other or at.strong) and (up is None or up.excused)
        at.covered = (at.strong and at.name in ("article", "main")) or (up is not None and up.covered)


def _marks(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is not shown, and whether it names itself as something else than the article."""
    unseen, named = name in UNSEEN, name in ASIDE or (name == "header" and not in_article)
    if name in ("html", "body", "article", "main") or not attributes.strip():
        return unseen, named
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
            unseen = True
        if (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES):
            named = True
        if key in ("class", "id") and name in BLOCKS and name not in HEADINGS:
            for token in value.split():
                words = {word for word in re.split("[_-]", token) if word}
                named |= bool(words) and words <= NAMES and not (in_article and words <= HEADS)
    return unseen, named


def blocks(html: str) -> list[Block]:
    """The page's blocks with text, in page order."""
    root = Element("", None, 0, False, False, True)
    here, found = root, []
    paths: dict[tuple[int, str], int] = {}
    #: Open elements by name.
    opened: Counter[str] = Counter()
    block = Block(root)

    def flush() -> None:
        nonlocal block
        block.text = " ".join(entities.unescape("".join(block.parts)).split())
        if block.text:
            found.append(block)
        block = Block(here.leaf)

    def leave(last: Element) -> None:
        """End this element and those inside it."""
        nonlocal here
        while here is not last.parent:
            opened[here.name] -= 1
            here = here.parent

    def close(names: set[str], until: set[str]) -> None:
        at: Element | None = here if any(opened[name] for name in names) else None
        while at is not None and at.parent is not None and at.name not in until:
            if at.name in names:
                flush()
                leave(at)
            at = at.parent

    def text(part: str) -> None:
        if part:
            block.parts.append(part)
            if here.linked:
                block.links += len(part)

    place = 0
    while place < len(html):
        start = START.search(html, place)
        if start is None:
            text(html[place:])
            break
        text(html[place : start.start()])
        tag = TOKEN.match(html, start.start()) or BROKEN.match(html, start.start())
        if tag is None:
            if html.startswith("</", start.start()):
                # An end tag without a name is dropped up to its bracket.
                end = html.find(">", start.start())
                place = len(html) if end < 0 else end + 1
                continue
            break
        place = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            at: Element | None = here if opened[name] else None
            while at is not None and at.name != name:
                # An inline end tag does not reach over a block.
                at = None if at.block and name not in BLOCKS else at.parent
            if at is not None and at.parent is not None:
                if name in BLOCKS:
                    flush()
                leave(at)
                if name in BLOCKS:
                    block = Block(here.leaf)
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCKS:
            if name in CLOSES:
                close(*CLOSES[name])
            else:
                close({"p"}, {"td", "th", "button", "li", "div", "section", "article", "body"})
            flush()
        if name in VOID:
            continue
        unseen, named = _marks(name, tag[3], here.in_article)
        is_block = name in BLOCKS or (unseen and not here.unseen) or named
        if is_block and name not in BLOCKS:
            flush()
        path = paths.setdefault((here.path, name), len(paths) + 1) if is_block else here.path
        if name in ("article", "main"):
            around: Element | None = here
            while around is not None and not around.holds:
                around.holds = True
                around = around.parent
        opened[name] += 1
        here = Element(name, here, path, here.unseen or unseen, named, is_block)
        if is_block:
            block = Block(here)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, place)
            if end is None:
                place = len(html)
            else:
                if name not in UNSEEN:
                    text(html[place : end.start()])
                flush()
                leave(here)
                block = Block(here.leaf)
                place = end.end()
    flush()
    return found


def path_scores(page: list[Block], lowered: float = LOWERED) -> dict[tuple[int, bool], float]:
    """Per path the mean of its blocks' smoothed and fused ratios."""
    paths = [block.path for block in page]
    sums: dict[tuple[int, bool], list[float]] = {}
    for block, path in zip(page, paths, strict=True):
        total = sums.setdefault(path, [0, 0, 0, 0])
        total[0] += 1
        total[1] += len(block.text)
        total[2] += len(PUNCTUATION.findall(block.text))
        total[3] += min(block.links, len(block.text))
    lengths = [sums[path][1] / sums[path][0] for path in paths]
    points = [sums[path][2] / sums[path][0] for path in paths]

    def smoothed(values: list[float], i: int) -> float:
        total = weight = 0.0
        for j in range(max(0, i - 2), min(len(values), i + 3)):
            total += KERNEL[abs(i - j)] * values[j]
            weight += KERNEL[abs(i - j)]
        return total / weight

    scores: dict[tuple[int, bool], float] = {}
    for i, path in enumerate(paths):
        n, chars, _, links = sums[path]
        fused = smoothed(lengths, i) * (1 + smoothed(points, i)) * (1 - links / chars)
        scores[path] = scores.get(path, 0.0) + fused / n
    return {path: score * (lowered if path[1] else 1) for path, score in scores.items()}


def strong_blocks(page: list[Block], lowered: float = LOWERED) -> list[Block]:
    """The blocks whose path's score passes."""
    scores = path_scores(page, lowered)
    least = min(PASS * statistics.pstdev(scores.values()), max(scores.values()))
    return [block for block in page if scores[block.path] >= least]


def main_text(html: str | None) -> str:
    page = [block for block in blocks(html or "") if not block.element.unseen]
    if not page:
        return ""
    elements = _elements(page)
    if not any(at.name in ("article", "main") for at in elements):
        # A name is no reason against an element that holds most of what scores highly without it.
        settle(elements)
        high = strong_blocks(page, 1.0)
        sizes: Counter[Element] = Counter()
        for block in high:
            sizes[block.element] += len(block.text)
        most = sum(sizes.values())
        for at in reversed(elements):
            at.holds |= 2 * sizes[at] >= most
            if at.parent is not None:
                sizes[at.parent] += sizes[at]
    settle(elements)
    strong = {id(block) for block in strong_blocks(page)}
    places = [i for i, block in enumerate(page) if id(block) in strong]
    # The common ancestor of all strong blocks: only between its first and last one are weak blocks added.
    inside = [False] * len(page)
    for i in range(places[0], places[-1] + 1):
        inside[i] = True
    for i in places:
        at: Element | None = page[i].element
        while at is not None and not at.strong:
            at.strong = True
            at = at.parent
    settle(elements)
    # An article's own ends bound it as strong blocks do.
    for i, block in enumerate(page):
        inside[i] |= block.element.covered
    # A heading little before the first strong block belongs to it.
    first = lead = inside.index(True)
    while lead > 0 and first - lead < LEAD and page[lead - 1].fits and not page[lead - 1].element.heading:
        lead -= 1
    while lead > 0 and page[lead - 1].fits and page[lead - 1].element.heading:
        lead -= 1
        inside[lead:first] = [True] * (first - lead)
    return "\n".join(block.text for i, block in enumerate(page) if id(block) in strong or (inside[i] and block.fits))


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = ", ".join(f"{name} {chosen.schema[name].dataType.simpleString()}" for name in ("page_id", "url"))
    return mapped(chosen, read, f"{kinds}, text string, n_chars bigint")
