"""Main text of web pages by text-to-tag ratios.

The standard library's parser sends events; from them a page becomes lines, one per block, each with
its text, its tags and the elements it lies in. The ratio of text to tags of a line is high in an
article and low in menus. The ratios are smoothed along the page with a Gaussian, and lines above
the page's threshold form clusters. The elements that hold the clusters together are the content
regions, one or several; all their lines are kept, short ones too, but for those in elements that are
marked, by element or by name, as menu, advert, comment and the like. A name marks an element only as a
whole (``related-work`` is not ``related``), and names that parts of an article carry too need more than
the name inside one. All passes over a page are linear in its length.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import free_name, mapped

SIGMA = 2.0  # of the Gaussian, in lines
CHUNK = 1 << 16  # characters that the parser gets at a time

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never content.
SILENT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map "
    "nav aside footer form fieldset button select option datalist textarea menu dialog".split()
)
#: Elements that end a line. All others stand inside one.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option "
    "p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that can be a content region.
REGIONS = frozenset("html body main article section div td center figure blockquote".split())
#: An open one of these ends when a block of its kind begins.
IMPLIED = {"p": BLOCKS - {"br"}, "li": frozenset({"li"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
           "tr": frozenset({"tr", "tbody", "tfoot"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
           "option": frozenset({"option"})}
#: Words in class, id or role that name what is not content.
MARKS = frozenset(
    "ad adbanner ads adbox adslot adunit advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary consent contentinfo cookie cookies copyright cta disclaimer discussion disqus footer gdpr legal login menu menubar menus "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar sidebars signup skip social "
    "sponsor sponsored subnav subscribe subscription teaser toast toolbar topbar widget widgets masthead header".split()
)
#: Those that wrappers of whole pages don't carry: what they mark is left out, however long.
BOXES = frozenset(
    "ad adbanner ads adbox adslot adunit advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist "
    "discussion disqus menu menubar menus nav navbar navigation pager pagination recommended related replies reply respond sidebar "
    "sidebars sponsor sponsored subnav teaser".split()
)
#: Words that make a name speak of the page's state or layout (has-sidebar, comments-open), not of a box.
STATES = frozenset("has with no without open opened closed enabled disabled layout free".split())
PAGE_HEAD = frozenset({"header", "banner", "masthead"})  # of a page, not of an article
#: Marks that sections of an article carry too; inside one they count if the text is mostly links, or a thread is within.
WEAK = frozenset("alert discussion legal recommended related search share sharing social skip teaser disclaimer".split())
#: Words that say nothing about what a box is: a name is a mark if it holds nothing but marks and these.
NEUTRAL = frozenset(
    "a an and area article bar block blog body bottom box btn button center col column container content entry fixed footer form full "
    "global group id in inner item items js layer left list lower main message module my new of on outer page panel part post posts "
    "primary region right row secondary section shell site slot small sticky story tertiary text the thread to top unit upper user view wrap wrapper".split()
)
#: Elements of running text: weak names on them say nothing.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd figcaption caption blockquote pre".split())
ENTRIES = 3  # boxes side by side that are a thread
SHARE = 0.3  # of the first region's weight that another one must have
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
_CUT_TAG = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Lines(HTMLParser):
    """Collects the lines of a page, and the elements they lie in: blocks, silent elements and marked ones.

    Element 0 is the page. Marks: 0 none, 1 one that a wrapper of the page may carry, 2 one of a box; 3 and 4
    are weak ones of either kind.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.names, self.parents, self.marks = [""], [-1], [0]
        self.stack = [0]
        self.open: Counter = Counter()  # names on the stack
        self.silent = 0  # silent elements among them
        self.link = 0  # length of the stack at which a link was opened
        self.lines: list[list] = []  # text, tags, characters in links, innermost element
        self.text: list[str] = []
        self.tags = self.linked = 0

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append([text, self.tags, min(self.linked, len(text)), self.stack[-1]])
            self.tags = 0
        self.text, self.linked = [], 0

    def mark(self, tag: str, attrs: list) -> int:
        named = dict(attrs)
        if tag in ("html", "body"):
            return 0
        found = {"header"} if tag == "header" else set()
        for key in ("class", "id", "role"):
            for name in (named.get(key) or "").split():
                parts = {x for x in (y.lower() for y in _NAME.findall(name)) if len(x) > 1 and not x.isdigit()}
                if parts.isdisjoint(STATES) and parts <= MARKS | NEUTRAL:
                    found |= parts & MARKS
        hidden = "hidden" in named or named.get("aria-hidden") == "true" or bool(_HIDDEN.search(named.get("style") or ""))
        if tag in RUNNING:
            found -= WEAK
        if found <= PAGE_HEAD and (self.open["article"] or self.open["main"]):
            found = set()
        boxed = 1 if found.isdisjoint(BOXES) else 2
        return boxed if hidden or not found <= WEAK else boxed + 2 if found else 0

    def push(self, tag: str, mark: int) -> None:
        self.names.append(tag)
        self.parents.append(self.stack[-1])
        self.marks.append(mark)
        self.stack.append(len(self.names) - 1)
        self.open[tag] += 1
        self.silent += tag in SILENT

    def pop(self) -> str:
        tag = self.names[self.stack.pop()]
        self.open[tag] -= 1
        self.silent -= tag in SILENT
        if len(self.stack) < self.link:
            self.link = 0
        return tag

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            # A block ends what stands inside a line, and a block of its kind that ends by itself.
            while len(self.stack) > 1:
                top = self.names[self.stack[-1]]
                if top not in BLOCKS and top not in SILENT or tag in IMPLIED.get(top, ()):
                    self.pop()
                else:
                    break
        if tag == "body":
            while self.open["head"]:
                self.pop()
        if tag == "a":
            self.link = len(self.stack)
        if tag not in VOID:
            mark = self.mark(tag, attrs) if attrs or tag == "header" else 0
            if mark or tag in BLOCKS or tag in SILENT:
                self.push(tag, mark)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in REGIONS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if tag == "a":
            self.link = 0
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)
            if self.link:
                self.linked += len(data.strip())


def lines_of(html: str) -> Lines:
    parser = Lines()
    html = _CUT_TAG.sub("", html)  # a tag that the end of the page cuts off
    for at in range(0, len(html), CHUNK):
        parser.feed(html[at : at + CHUNK])
    parser.close()
    parser.end_line()
    return parser


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return padded / weight


class Tree:
    """Sums over the elements of a page. Elements are numbered from the outside in, so one pass from the
    last to the first adds up all that lies within each."""

    def __init__(self, page: Lines):
        self.page, self.n = page, len(page.names)
        self.inner = np.array([e for *_, e in page.lines])

    def within(self, values: np.ndarray) -> list[float]:
        """Per element the sum of a value of the lines in it."""
        out = np.bincount(self.inner, weights=values, minlength=self.n).tolist()
        for e in range(self.n - 1, 0, -1):
            out[self.page.parents[e]] += out[e]
        return out

    def below(self, own: list) -> list:
        """Per element its own value, or else that of the nearest element around it that has one."""
        out = list(own)
        for e in range(1, self.n):
            out[e] = out[e] or out[self.page.parents[e]]
        return out


def barred_elements(tree: Tree, size: np.ndarray, linked: np.ndarray) -> list[bool]:
    """Which elements lie in one whose mark counts.

    A mark on an element that holds most of the page says nothing about its text, unless it names a
    box: threads and menus can be longer than the article. The main element lies in no box. Weak marks
    inside an article or main element count if links are most of the text, or a thread or a form lies within;
    a section of running text that is called so is part of the article.
    """
    page = tree.page
    under, links = tree.within(size), tree.within(linked)
    around = [False] * tree.n
    for e in range(tree.n):
        if page.names[e] == "main" and under[e]:
            while e > 0 and not around[e]:
                around[e] = True
                e = page.parents[e]
    # Entries of a thread: boxes side by side, or in a list; one of a marked kind or a form tells as much.
    holds, entries = [False] * tree.n, [0] * tree.n
    for e in range(tree.n - 1, 0, -1):
        name, above = page.names[e], page.parents[e]
        holds[above] |= holds[e] or page.marks[e] == 2 or name == "form" or entries[e] >= ENTRIES
        entries[above] += entries[e] if name in ("ul", "ol") else name in ("div", "li", "article") and under[e] > 0
    inside = tree.below([name in ("article", "main") for name in page.names])
    own = []
    for e in range(tree.n):
        mark, most = page.marks[e], under[e] > 0.6 * under[0]
        if mark > 2 and not (inside[e] and not holds[e] and entries[e] < ENTRIES and 2 * links[e] <= under[e]):
            mark -= 2
        own.append(mark == 2 and not around[e] or mark == 1 and not most)
    return tree.below(own)


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article of a page, its blocks joined by single spaces; empty if there is none."""
    if not html:
        return ""
    page = lines_of(html)
    if not page.lines:
        return ""
    tree = Tree(page)
    size = np.array([len(text) for text, *_ in page.lines], float)
    linked = np.array([in_links for _, _, in_links, _ in page.lines], float)
    tags = np.array([n for _, n, _, _ in page.lines], float)
    bars = np.array(barred_elements(tree, size, linked))[tree.inner]
    ratio = np.where(bars, 0, (size - linked) / np.maximum(tags, 1))
    if not ratio.any():
        return ""
    even = smoothed(ratio, sigma) if sigma else ratio
    chosen = (even >= min(even.std(), even.max())) & ~bars  # clusters of content lines
    regions = content_regions(tree, np.where(chosen, ratio, 0))
    place = np.array(tree.below(regions))[tree.inner]
    kept = (place > 0) & ~bars
    for e, edge in link_lists(tree, size, linked, kept, np.flatnonzero(chosen & kept), regions).items():
        kept[edge] = False
    return " ".join(line[0] for line, keep in zip(page.lines, kept, strict=True) if keep)


def content_regions(tree: Tree, weight: np.ndarray) -> list[int]:
    """Per element 1 if it is a region: one of those that hold the clusters together.

    The first holds most of the weight. If an article or main element holds some of it, it is the one
    that holds most; an article rather than the main element, unless it has less than half of that.
    Otherwise it is the innermost element with 70% of the weight. Further ones, articles beside an
    article, other regions beside others, lie apart from those before and have ``SHARE`` of its weight.
    """
    names, held = tree.page.names, tree.within(weight)
    best: dict[str, int] = {}  # of nested ones that hold the same the inner one
    for e in range(tree.n):
        if names[e] in ("article", "main") and held[e] > 0 and held[e] >= held[best.get(names[e], e)]:
            best[names[e]] = e
    if best:
        article, main = best.get("article", 0), best.get("main", 0)
        first = article if article and held[article] >= 0.5 * (held[main] if main else 0) else main
    else:
        first = max((e for e in range(tree.n) if held[e] >= 0.7 * held[0] and names[e] in REGIONS), default=0)
    out = [0] * tree.n
    kinds = frozenset({"article"}) if names[first] == "article" else frozenset() if names[first] == "main" or not first else REGIONS
    out[first] = 1
    taken = [e for e in range(1, tree.n) if names[e] in kinds and held[e] >= SHARE * held[first]]
    apart = set()  # elements around a region
    e = first
    while e >= 0:
        apart.add(e)
        e = tree.page.parents[e]
    inside = tree.below(out)
    for e in sorted(taken, key=lambda e: (-held[e], -e)):
        if e in apart or inside[e]:
            continue
        out[e] = 1
        inside = tree.below(out)
        while e >= 0 and e not in apart:
            apart.add(e)
            e = tree.page.parents[e]
    return out


def link_lists(
    tree: Tree, size: np.ndarray, linked: np.ndarray, kept: np.ndarray, chosen: np.ndarray, regions: list[int]
) -> dict[int, np.ndarray]:
    """Unmarked menus: the lines of lists and boxes that are mostly links, of two lines or more, which lie before
    the first or after the last cluster of a page without an article. Lists between or in an article are text."""
    names = tree.page.names
    if not len(chosen) or any(r and name in ("article", "main") for r, name in zip(regions, names, strict=True)):
        return {}
    text, links, count = (tree.within(np.where(kept, x, 0)) for x in (size, linked, np.ones(len(size))))
    mostly = [
        e if names[e] in ("ul", "ol", "dl", "table", "div", "section") and count[e] > 1 and 2 * links[e] > text[e] else 0
        for e in range(tree.n)
    ]
    owner = np.array(tree.below(mostly))[tree.inner]
    at = np.arange(len(owner))
    edge = (owner > 0) & ((at < chosen[0]) | (at > chosen[-1]))
    return {0: edge} if edge.any() else {}


def extracted(pages: DataFrame) -> DataFrame:
    """pages with text (string) and n_chars (long, its code points), made from html.

    A null or empty page, or one without an article, has an empty text; every row, a repeated one too, is
    extracted for itself. Names that pages has already get underscores in front.
    """
    at = pages.columns.index("html")
    text = free_name(pages, "text")
    out = mapped(
        pages,
        f"`{text}` string",
        lambda batch: [pa.array([main_text(x.as_py()) for x in batch.column(at)], pa.string())],
    )
    return out.withColumn(free_name(out, "n_chars"), F.length(text).cast("long"))


def digest(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    return extracted(pages.select("page_id", "url", "html")).drop("html")
