"""Main text of web pages from streaming parser events.

``Page`` is a standard-library ``HTMLParser`` that turns a page into lines: one for each block
element, with its text, its number of tags and its containers. The text-to-tag ratios of the lines
are smoothed with a Gaussian; lines at or over the spread of the smoothed ratios form clusters of
content, and the container that holds them is the content region. Article and main elements are
hints for its edges: each outermost one with content clusters is a region, siblings too, unless most
of the clusters lie outside (``HELD``). Everything in the region is
kept, short lines too, except what its markup names as something else (menus, adverts, comments
and so on, ``ROLES``). A name with other words beside such a word, or the id of an article's section, is
doubtful, and the clusters decide on its element; headings never go by their names.

Defined cases: NULL html counts as empty; a page without content has empty text; malformed and
truncated markup is read as far as it goes, and an end tag without its start is ignored; a page
that is all menu has no content; repeated pages are each read. Input columns named like an output
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from traceframe.llm.common import column, visible, without

#: Fixed values of HTML: elements that break lines, have no end tag, or hold no readable text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title textarea select option button svg iframe object "
    "audio video canvas map datalist noframes applet".split()
)
#: Elements whose whole content is not the article.
OTHER = frozenset("nav aside footer form menu dialog search".split())
#: An open element of the left kind ends where one of the right kind starts.
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option"}),
}
SCOPES = frozenset("article main body html section div nav aside footer header form table ul ol".split())
#: Words in class, id and role that name something other than the article.
ROLES = frozenset(
    "ad ads adv advert advertisement advertisements advertising adsense adbox adslot sponsor sponsored "
    "promo promoted promotion banner sidebar sidebars aside menu menus nav navbar navigation navi "
    "breadcrumb breadcrumbs masthead topbar footer foot bottombar cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing related recommended recommendations comment comments commentlist "
    "disqus respond reply replies discussion reviews widget widgets toolbar pagination pager paging copyright "
    "contentinfo complementary search dialog".split()
)
#: Words beside those of ROLES in a name that still says no more than such a role.
FURNITURE = frozenset(
    "area bar block body bottom box button buttons col column container content element fixed form global group "
    "icon icons inner item items left link links list module outer page panel right row site slot sub "
    "title top unit user users view wrap wrapper".split()
)
#: These name the top of a page, or within an article its title.
TOPS = frozenset({"header", "head"})
READERS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
ROOTS = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIGMA, REACH = 1.0, 2
LINKED = 0.6
#: Article and main elements with a smaller share of the clusters' text are no edges.
HELD = 0.25
OUTPUTS = ("text",)


@dataclass(slots=True)
class Node:
    """An open element: its place in the tree, and why its content may not be the article."""

    tag: str
    number: int
    above: Node | None
    hard: bool = False  # surely something else
    soft: bool = False  # named so by its class; not if an article is inside
    doubtful: bool = False  # its name has such a word among others: the clusters decide
    root: bool = False
    has_root: bool = False
    inside: bool = False  # of a root, or one itself
    depth: int = 0


@dataclass(slots=True)
class Line:
    node: Node
    tags: int = 0
    linked: int = 0
    heading: bool = False
    pieces: list[str] = field(default_factory=list)
    text: str = ""


def names(attrs: list[tuple[str, str | None]], keys: tuple[str, ...] = ("class", "id", "role")) -> list[set[str]]:
    """The words of each class, id and role."""
    found = " ".join(v or "" for k, v in attrs if k in keys)
    spaced = re.sub(r"([a-z])([A-Z])", r"\1-\2", found)
    return [set(re.findall(r"[a-z]+", x)) for x in spaced.lower().split()]


def names_role(words: set[str]) -> bool:
    """Whether a name says nothing but a role other than the article."""
    return bool(words & ROLES) and words <= ROLES | FURNITURE


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    given = dict(attrs)
    style = re.sub(r"\s", "", given.get("style") or "").lower()
    return (
        "hidden" in given
        or (given.get("aria-hidden") or "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )


class Page(HTMLParser):
    """Lines of a page, in order, from parser events.

    Any text is read, in time that grows with its length: what begins like a tag but has no ``>`` behind
    it is no tag, a comment without an end goes on to the end of the page, and a declaration that is none is
    a comment. Open elements are found by tag, not by a walk.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        top = Node("", 0, None)
        self.nodes: list[Node] = [top]
        self.open: list[Node] = [top]
        self.places: dict[str, list[int]] = {}  # of open elements, by tag
        self.scopes: list[int] = []
        self.lines: list[Line] = []
        self.silent = 0
        self.anchors = 0
        self.sections = True
        self.begin()

    def begin(self) -> None:
        self.line = Line(self.open[-1])

    def end_line(self) -> None:
        line = self.line
        line.text = " ".join("".join(line.pieces).split())
        if line.text:
            line.pieces = []
            self.lines.append(line)
        self.begin()

    def push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        above = self.open[-1]
        node = Node(tag, len(self.nodes), above, above.hard, inside=above.inside, depth=above.depth + 1)
        in_root = above.inside
        if tag in OTHER or (tag == "header" and not in_root) or hidden(attrs):
            node.hard = True
        elif attrs and tag not in ("html", "body"):
            slugs = names(attrs)
            found = set().union(*slugs)
            # Ids of headings and of an article's sections are often made from its text.
            sure = names(attrs, ("class", "role")) if in_root and tag == "section" else slugs
            if tag in ROOTS:
                node.hard = node.hard or bool(found & READERS)
            elif tag in HEADINGS:
                pass
            elif any(map(names_role, sure)) or (found & TOPS and not in_root):
                node.soft = True
            elif found & ROLES:
                node.doubtful = True
        if tag in ROOTS and not node.hard:
            node.root = node.inside = True
            x: Node | None = above
            while x is not None and not x.has_root:
                x.has_root = True
                x = x.above
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in SCOPES:
            self.scopes.append(len(self.open))
        self.nodes.append(node)
        self.open.append(node)

    def last(self, tag: str) -> int:
        """The place of the innermost open element of a tag; 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def scope(self) -> int:
        """The place of the innermost open element that ends of elements do not pass."""
        return self.scopes[-1] if self.scopes else 0

    def pop_to(self, at: int) -> None:
        for node in reversed(self.open[at:]):
            self.silent -= node.tag in SILENT
            self.anchors -= node.tag == "a"
            self.places[node.tag].pop()
            if node.tag in SCOPES:
                self.scopes.pop()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            at = max((self.last(t) for t, ends in ENDED_BY.items() if tag in ends), default=0)
            if at > self.scope():
                self.pop_to(at)
        elif tag == "br":
            self.line.pieces.append(" ")
        self.line.tags += 1
        if tag in VOID:
            return
        if tag == "body" or tag not in SILENT and self.silent and self.open[-1].tag == "head":
            while len(self.open) > 1 and self.open[-1].tag == "head":
                self.pop_to(len(self.open) - 1)
        self.push(tag, attrs)
        self.silent += tag in SILENT
        self.anchors += tag == "a"
        if tag in BLOCKS:
            tags = self.line.tags
            self.begin()
            self.line.tags = tags
            self.line.heading = tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in BLOCKS:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        at = self.last(tag)
        if not at or (tag not in SCOPES and self.scope() > at):
            return
        if tag in BLOCKS:
            self.end_line()
        self.pop_to(at)
        if tag in BLOCKS:
            self.begin()

    def parse_comment(self, i: int, report: int = 1) -> int:
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end

    def parse_html_declaration(self, i: int) -> int:
        end = -1
        if self.rawdata.startswith("<![", i):
            if self.sections:
                try:
                    end = super().parse_html_declaration(i)
                except AssertionError:  # a kind of section that does not exist
                    end = self.parse_bogus_comment(i)
                else:
                    self.sections = end >= 0  # one without an end is not looked for again
        else:
            end = super().parse_html_declaration(i)
        if end < 0:
            end = self.parse_bogus_comment(i)
        return len(self.rawdata) if end < 0 else end

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.line.pieces.append(data)
            if self.anchors:
                self.line.linked += len(data.strip())

    def read(self, html: str) -> list[Line]:
        # Behind the last ">" no tag can end.
        rest = html.rfind(">") + 1
        unended = re.compile(r"<[A-Za-z/!?]").search(html, rest)
        self.feed(html[: unended.start()] if unended else html)
        self.close()
        self.end_line()
        return self.lines


def smooth(values: np.ndarray, sigma: float = SIGMA, reach: int = REACH) -> np.ndarray:
    """Gaussian mean over ``reach`` neighbours; at the ends over those that are there."""
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    spread = lambda x: np.convolve(np.pad(x, reach), weight, "valid")
    return spread(values) / spread(np.ones(len(values)))


def clusters(lines: list[Line]) -> np.ndarray:
    """Which lines are content by their smoothed text-to-tag ratio."""
    ratio = np.array([len(x.text) / max(1, x.tags) for x in lines], float)
    level = smooth(ratio)
    return level >= min(level.std(), level.max())


def inherited(nodes: list[Node], own: list[bool]) -> list[bool]:
    """For each element whether it or one around it has the property. Elements come after those around them."""
    for n in nodes[1:]:
        own[n.number] = own[n.number] or own[n.above.number]
    return own


def totals(nodes: list[Node], own: list[int]) -> list[int]:
    """For each element the sum over it and all within."""
    for n in reversed(nodes[1:]):
        own[n.above.number] += own[n.number]
    return own


def article_only(nodes: list[Node], lines: list[Line]) -> list[Line]:
    """The lines without those that are not the article: by the kind of an element around them, or by a name
    around them that has no article in it."""
    other = inherited(nodes, [n.soft and not n.has_root for n in nodes])
    return [x for x in lines if not x.node.hard and not other[x.node.number]]


def undoubted(nodes: list[Node], lines: list[Line]) -> list[Line]:
    """The lines without those in elements of doubtful names that hold mostly other text than clusters, or links."""
    good = [0] * len(nodes)
    for x, content in zip(lines, clusters(lines), strict=True):
        good[x.node.number] += len(x.text) if content and x.linked < LINKED * len(x.text) else -len(x.text)
    good = totals(nodes, good)
    bad = inherited(nodes, [n.doubtful and not n.has_root and good[n.number] < 0 for n in nodes])
    return [x for x in lines if not bad[x.node.number]]


def main_text(html: str | None) -> str:
    """Blocks of the content region joined by an empty line."""
    page = Page()
    lines = page.read(html or "")
    nodes = page.nodes
    lines = article_only(nodes, lines)
    if lines:
        lines = undoubted(nodes, lines)
    if not lines:
        return ""
    content = clusters(lines)
    plain = np.array([x.linked < LINKED * len(x.text) for x in lines])
    content &= plain
    # Text of the clusters in each outermost article or main element, and outside of them (0).
    region = [0] * len(nodes)
    for n in nodes[1:]:
        region[n.number] = region[n.above.number] or (n.number if n.root else 0)
    held: dict[int, int] = {}
    for x, good in zip(lines, content, strict=True):
        if good:
            at = region[x.node.number]
            held[at] = held.get(at, 0) + len(x.text)
    if HELD * sum(held.values()) < sum(held.values()) - held.get(0, 0):
        # The elements are the edges of what the clusters select. In main, around articles, links are no text.
        whole = inherited(nodes, [n.root and (n.tag == "article" or not n.has_root) for n in nodes])
        kept = [
            x for x, p in zip(lines, plain, strict=True)
            if region[x.node.number] in held and region[x.node.number] and (p or x.heading or whole[x.node.number])
        ]
        return "\n\n".join(x.text for x in kept)
    if not content.any():
        return ""
    sizes = [0] * len(nodes)
    for x, good in zip(lines, content, strict=True):
        sizes[x.node.number] += len(x.text) if good else 0
    sizes = totals(nodes, sizes)
    # The deepest container with most of what the clusters hold.
    best = max((n for n in nodes if sizes[n.number] >= 0.6 * sizes[0]), key=lambda n: (n.depth, sizes[n.number]))
    within = inherited(nodes, [n is best for n in nodes])
    inside = [i for i, x in enumerate(lines) if within[x.node.number]]
    at = [i for i in inside if content[i]]
    first, there = at[0], set(inside)
    while first - 1 in there and (lines[first - 1].heading or best.number):
        first -= 1
    last = inside[-1] if best.number and lines[at[0]].node is not best else at[-1]
    return "\n\n".join(lines[i].text for i in inside if first <= i <= last and plain[i])


def extract(pages: DataFrame, *, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each as column ``out``."""
    visible(pages.sparkSession)

    @F.arrow_udf(StringType())
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for htmls in batches:
            yield pa.array([main_text(h.as_py()) for h in htmls], pa.string())

    base = without(pages, [out])
    return base.withColumn(out, extracted.asNondeterministic()(column(pages, html_col).cast("string")))
