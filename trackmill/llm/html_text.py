r"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their tag path, the elements from the root down to them.
Each path has a text ratio (characters outside links per node) and a punctuation ratio (marks
per node); both are smoothed over neighbouring nodes in page order and fused, own and smoothed
values, into one score, and paths above ``THRESHOLD`` times the page's standard deviation hold content.  The article
is then the element that holds the content: the ``article`` or ``main`` element with most of
it, or else the smallest element around all of it that is more than a paragraph.  Its text is
taken whole, short paragraphs and headings too; without ``article`` or ``main``, all its blocks
but those that are mostly links.

What cannot be article is left out before anything is counted: scripts, styles, forms, menus,
headers, footers, sidebars, notices, adverts and comments, known by element, role or the names
in class and id.  A name that has other words too counts only where the text is mostly links.  Names
say nothing of an element that holds most of the page's text and its ``article`` or ``main``, or
nearly all of its text: it is a wrapper.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches

# Where markup begins; the name of a tag; what ends a tag or opens a quoted value in it.
MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
NAME_WORDS = re.compile(r"[a-z]+|[0-9]+", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟।]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements that are not shown and do not part the text around them.
UNSHOWN = frozenset("script style noscript template link meta".split())
# Elements that an opening tag of the key ends, within the nearest of the stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
# Elements, roles and words of class and id that mark what is not article.
BOILERPLATE = frozenset(
    "nav menu footer aside form script style noscript template textarea title iframe head button select svg canvas "
    "object dialog noframes noembed xmp".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "sidebar footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "commentlist disqus replies reply respond widget toolbar pagination pager copyright disclaimer".split()
)
# Of these, words that mean boilerplate whatever stands beside them.
CLEAR_WORDS = frozenset(
    "advert adverts advertisement advertising sponsored navbar sidebar footer masthead breadcrumb breadcrumbs cookie "
    "cookies consent gdpr newsletter comment comments commentlist disqus replies pagination".split()
)
# Words of layout that say nothing beside words of boilerplate.
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box col column container content global group header inner item items left link "
    "links list main middle outer page panel post primary right row secondary section site slot top unit wrap wrapper".split()
)
# Elements around one paragraph, heading or item.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre blockquote figcaption caption".split())
THRESHOLD = 0.5
# Shares of a page's text that make an element a wrapper: with the article in it, and without.
MOST_TEXT, NEARLY_ALL_TEXT = 0.5, 0.8
SMOOTHED = (0.25, 0.5, 1.0, 0.5, 0.25)
MOSTLY_LINKS = 0.5
# Share of an article's text that another must have to be as good.
ALIKE = 0.8


class Node(NamedTuple):
    """A run of text: its block, the number of its tag path and of the element it stands in, and
    whether it is part of a link."""

    text: str
    block: int
    path: int
    element: int
    linked: bool


class Elements:
    """The elements of a page by number, in page order: an element's descendants are the numbers up to
    its ``last``."""

    def __init__(self) -> None:
        self.kind: list[str] = []
        self.parent: list[int] = []
        self.last: list[int] = []

    def add(self, kind: str, parent: int) -> int:
        number = len(self.kind)
        self.kind.append(kind)
        self.parent.append(parent)
        self.last.append(number)
        return number

    def finish(self) -> None:
        for number in range(len(self.kind) - 1, -1, -1):
            if self.parent[number] >= 0:
                self.last[self.parent[number]] = max(self.last[self.parent[number]], self.last[number])

    def holds(self, number: int, inner: int) -> bool:
        return number <= inner <= self.last[number]

    def sums(self, values: list[tuple[int, float]]) -> list[float]:
        """For each element, the sum over it and all within it of values by element."""
        total = [0.0] * len(self.kind)
        for number, value in values:
            if number >= 0:
                total[number] += value
        for number in range(len(total) - 1, -1, -1):
            if self.parent[number] >= 0:
                total[self.parent[number]] += total[number]
        return total


def hints(attributes: str) -> tuple[bool, bool, bool, str]:
    """Whether attributes hide an element or give it a role of boilerplate; whether a name of class or
    id has a clear word of boilerplate, or is boilerplate but for words of layout; whether a word among others is; and the
    class words that the tag path shows."""
    words: list[str] = []
    whole = some = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False, False, ""
        if name == "role" and value.lower() in BOILERPLATE_ROLES:
            return True, False, False, ""
        if name in ("class", "id"):
            for part in value.split():
                own = [word.lower() for word in NAME_WORDS.findall(CAMEL.sub(" ", part))]
                words += own
                bad = [word for word in own if word in BOILERPLATE_WORDS]
                some = some or bool(bad)
                rest = [word for word in own if word not in BOILERPLATE_WORDS]
                whole = whole or bool(bad) and all(word in LAYOUT_WORDS or word.isdigit() for word in rest)
                whole = whole or any(word in CLEAR_WORDS for word in bad)
    return False, whole, some, "." + ".".join(words) if words else ""


def marked(attributes: str) -> tuple[bool, str]:
    """Whether attributes mark boilerplate by themselves, and the class words that the path shows."""
    sure, whole, _, step = hints(attributes)
    return sure or whole, step


def spared_elements(nodes: list[Node], elements: Elements, hinted: dict[int, bool]) -> set[int]:
    """Of elements whose class or id hints at boilerplate, those that are not: wrappers, which hold the
    page's text, and those of which only a word among others hints (False in ``hinted``) and whose text
    is not mostly links."""
    own = [(node.element, 0 if node.linked else len(node.text.strip())) for node in nodes]
    held = elements.sums(own)
    linked = elements.sums([(node.element, len(node.text.strip()) * node.linked) for node in nodes])
    total = sum(length for _, length in own)
    articles = [number for number, kind in enumerate(elements.kind) if kind in ("article", "main")]
    # Of articles inside one another with the same text the outermost.
    article = max(articles, key=lambda n: (held[n], -n), default=None)

    def wraps(number: int) -> bool:
        if article is None:
            return held[number] >= NEARLY_ALL_TEXT * total
        return elements.holds(number, article) and held[number] >= MOST_TEXT * total

    return {
        number for number, whole in hinted.items()
        if total and wraps(number) or not whole and linked[number] <= MOSTLY_LINKS * (linked[number] + held[number])
    }


def nodes_of(page: str) -> tuple[list[Node], Elements]:
    """Text nodes outside boilerplate in page order, and the page's elements."""
    # At first words of class and id are not heeded, so that it can be told what they say.
    nodes, elements, hinted = _parsed(page, None)
    if hinted:
        nodes, elements, _ = _parsed(page, spared_elements(nodes, elements, hinted))
    return nodes, elements


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """The markup of a page: where it begins and ends, whether it is a closing tag, its name in lower
    case (none for comments and declarations) and its attributes.

    A quote stands for itself unless it opens a value, and one that never closes opens none; what
    the page's end cuts off ends there.  The text of a raw element is passed over."""
    at, size = 0, len(page)
    last = {quote: page.rfind(quote) for quote in "\"'"}
    while found := MARKUP.search(page, at):
        start, end = found.start(), found.end()
        if not found[0][-1].isalpha():
            close = page.find("-->", end) if found[0] == "<!--" else page.find(">", end)
            at = size if close < 0 else close + (3 if found[0] == "<!--" else 1)
            yield start, at, False, "", ""
            continue
        name = TAG_NAME.match(page, end - 1)
        at = name.end()
        while True:
            stop = TAG_STOP.search(page, at)
            if stop is None:
                inner = at = size
                break
            at = stop.end()
            if stop[0] == ">":
                inner = stop.start()
                break
            quote = stop[0][-1]
            if at <= last[quote]:
                at = page.find(quote, at) + 1
        tag, closing = name[0].lower(), found[0][1] == "/"
        yield start, at, closing, tag, page[name.end():inner]
        if tag in RAW and not closing:
            ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = ended.start() if ended else size


def _parsed(page: str, spared: set[int] | None) -> tuple[list[Node], Elements, dict[int, bool]]:
    """Text nodes and elements, and the elements at which class or id alone hints, with whether a
    whole name does; those are boilerplate except the spared, or not at all if ``spared`` is absent.

    Every step takes time by what it opens or closes, not by how deep it stands."""
    hinted: dict[int, bool] = {}
    nodes: list[Node] = []
    elements = Elements()
    stack: list[tuple[str, int, int, bool]] = []  # tag, number, path, boilerplate
    open_: dict[str, int] = {}  # open elements of each tag
    paths: dict[tuple[int, str], int] = {}
    block, at, raw = 0, 0, False

    def text(piece: str) -> None:
        if raw or (stack and stack[-1][3]) or not piece or piece.isspace():
            if piece and piece.isspace() and nodes and nodes[-1].block == block and not raw:
                nodes.append(nodes[-1]._replace(text=" "))
            return
        path, number = (stack[-1][2], stack[-1][1]) if stack else (-1, -1)
        nodes.append(Node(html.unescape(piece), block, path, number, open_.get("a", 0) > 0))

    def close(tag: str, stops: frozenset[str] | set[str] = frozenset()) -> None:
        """End the innermost open ``tag`` and all within it, if no stop stands nearer."""
        nonlocal block
        if not open_.get(tag):
            return
        if stops:
            for own, _, _, _ in reversed(stack):
                if own in stops:
                    return
                if own == tag:
                    break
        while True:
            own = stack.pop()[0]
            open_[own] -= 1
            if own not in INLINE and own not in UNSHOWN:
                block += 1
            if own == tag:
                return

    for start, end, ending, tag, attributes in tags(page):
        text(page[at:start])
        at, raw = end, False
        if not tag:
            continue
        if ending:
            if open_.get(tag):
                close(tag)
            elif tag not in INLINE and tag not in UNSHOWN:
                block += 1
            continue
        if tag == "br":
            if nodes and nodes[-1].block == block:
                nodes.append(nodes[-1]._replace(text=" "))
            continue
        if tag in ENDS_PARAGRAPH:
            close("p")
        if tag in ENDS:
            ended, stops = ENDS[tag]
            for own in sorted(ended):
                close(own, stops)
        if tag not in INLINE and tag not in UNSHOWN:
            block += 1
        if tag in VOID or attributes.endswith("/") and tag not in RAW:
            continue
        sure, named, hint, step = hints(attributes)
        inside = bool(stack and stack[-1][3])
        # A header of the page is boilerplate, a header of the article is part of it.
        header = tag == "header" and not (open_.get("article") or open_.get("main"))
        whole = tag in ("html", "body")
        above, path = (stack[-1][1], stack[-1][2]) if stack else (-1, -1)
        number = elements.add(tag, above)
        if hint and not whole:
            hinted[number] = named
        heeded = hint and spared is not None and number not in spared
        out = tag in BOILERPLATE or header or sure or heeded
        path = paths.setdefault((path, tag + step), len(paths))
        stack.append((tag, number, path, inside or not whole and out))
        open_[tag] = open_.get(tag, 0) + 1
        raw = tag in RAW
    text(page[at:])
    elements.finish()
    return nodes, elements, hinted


def path_scores(nodes: list[Node]) -> dict[int, float]:
    """Fused ratio of each tag path: geometric mean of its own text ratio and of the smoothed
    text and punctuation ratios at its nodes."""
    chars: dict[int, float] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    for node in nodes:
        length = 0 if node.linked else len(node.text.strip())
        chars[node.path] = chars.get(node.path, 0) + length
        marks[node.path] = marks.get(node.path, 0) + (0 if node.linked else len(PUNCTUATION.findall(node.text)))
        count[node.path] = count.get(node.path, 0) + 1
    text = [chars[node.path] / count[node.path] for node in nodes]
    punctuation = [marks[node.path] / count[node.path] for node in nodes]

    def smooth(values: list[float]) -> list[float]:
        half, out = len(SMOOTHED) // 2, []
        for i in range(len(values)):
            near = [(SMOOTHED[j + half], values[i + j]) for j in range(-half, half + 1) if 0 <= i + j < len(values)]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    sums: dict[int, float] = {}
    for node, t, p in zip(nodes, smooth(text), smooth(punctuation), strict=True):
        sums[node.path] = sums.get(node.path, 0.0) + math.sqrt(t * (1.0 + p))
    return {path: math.sqrt(chars[path] / count[path] * total / count[path]) for path, total in sums.items()}


def article_nodes(nodes: list[Node], elements: Elements) -> list[Node]:
    """The nodes of the article, or of articles side by side that hold about as much."""
    scores, kinds = path_scores(nodes), elements.kind
    mean = sum(scores.values()) / len(scores)
    spread = math.sqrt(sum((s - mean) ** 2 for s in scores.values()) / len(scores))
    content = [node for node in nodes if scores[node.path] > 0 and scores[node.path] >= THRESHOLD * spread]
    if not content:
        return []
    sums = elements.sums([(node.element, len(node.text)) for node in content])
    held = {n: size for n, size in enumerate(sums) if size and kinds[n] in ("article", "main")}
    # Of articles inside one another the innermost that has nearly all of the outer's content.
    root = None
    if held:
        most = max(held.values())
        root = max(number for number, size in held.items() if size >= ALIKE * most)
        articles = {n for n, size in held.items() if kinds[n] == "article"}
        if articles and kinds[root] != "article" and max(held[n] for n in articles) >= 0.5 * most:
            root = max(articles, key=lambda n: held[n])
    if root is not None:
        roots = [root]
        for n in sorted(held):
            alike = kinds[n] == kinds[root] == "article" and held[n] >= ALIKE * held[root]
            if alike and not any(elements.holds(a, b) for r in roots for a, b in ((n, r), (r, n))):
                roots.append(n)
        return [node for node in nodes if any(elements.holds(r, node.element) for r in roots)]
    # The smallest element around all content that is more than a paragraph.
    low, high = min(node.element for node in content), max(node.element for node in content)
    root = low
    while root >= 0 and (elements.last[root] < high or kinds[root] in PARAGRAPHS or kinds[root] in INLINE):
        root = elements.parent[root]
    linked: dict[int, list[int]] = {}
    for node in nodes:
        own, length = linked.setdefault(node.block, [0, 0]), len(node.text.strip())
        own[0] += length * node.linked
        own[1] += length
    return [
        node for node in nodes
        if (root < 0 or elements.holds(root, node.element)) and linked[node.block][0] <= MOSTLY_LINKS * linked[node.block][1]
    ]


def main_text(page: str) -> str:
    """The article's blocks, one per line; empty if the page has none."""
    nodes, elements = nodes_of(page)
    if not nodes:
        return ""
    blocks: dict[int, list[str]] = {}
    for node in article_nodes(nodes, elements):
        blocks.setdefault(node.block, []).append(node.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
        lengths = pa.array([len(text) for text in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths],
            names=["id", "url", "text", "n_chars"],
        )


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: ``id``, ``url``, ``text`` and ``n_chars``, its code points.

    Absent and empty pages, and pages without an article, have an empty text; markup that
    the page's end cuts off ends there; repeated pages are repeated.
    """
    small_batches(pages.sparkSession)
    narrow = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return narrow.mapInArrow(_extract, "id long, url string, text string, n_chars long")
