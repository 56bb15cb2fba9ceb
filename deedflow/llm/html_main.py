"""Main text of web pages by tree scoring.

The page is parsed into a tree.  Scripts, styles, menus, readers' comments and what is hidden are cut off for good.  Other parts that seldom
are the article (forms, headers, footers, sidebars, notices, adverts; by tag, role, class or id) are cut from
what surrounds them, but are scored on their own: one that outscores all the rest by far, by ``ENOUGH`` at least, is the article after all.

Every text block gives points for its length and its commas to its parent, half to the grandparent and shares that shrink with
the distance to further ancestors, up to the next cut; a container's points are discounted by its link density, and again if it
is cut (``CUT``, for what never holds an article ``LAST``).  The container
with the most points is kept; if it lies in an article or main element, that element is (the nearest one), else
its siblings that score well or are long running text with few links are kept with it.  If
nothing scores, the whole body that is left is the text.

Blocks follow page order, joined by one line feed; white space inside a block becomes one space.

Every step takes time in proportion to the page: open elements are found by their tags' places, totals are added up once from the leaves.

Defined results: a null, empty or text-free page gives the empty text; tags left open are closed as browsers
do, and what is left of a tag at the page's end is no text; of containers with equal scores the first that was scored is kept; deep nesting is handled without recursion;
very long pages are read whole; repeated rows are extracted alike; an empty table stays empty;
other columns are kept, and a column named like a result column is replaced.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship

# Fixed values of the HTML standard: elements without content, raw text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a start tag closes if they are open, up to the nearest of the elements named after them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset("script style noscript template head title nav button select option textarea input iframe object embed svg canvas audio video map dialog menu label".split())
APART = frozenset("header footer aside form fieldset".split())
ROLES = frozenset("navigation search dialog alert alertdialog menu menubar toolbar".split())
ROLES_APART = frozenset("banner contentinfo complementary form".split())
#: Names that tell of a state, not of a part.
STATE = re.compile(r"(?<![\w-])(?:(?:has|no|with|without|allow)[_-][\w-]*|[\w-]*[_-](?:open|closed|enabled|disabled|allowed))(?![\w-])", re.I)
#: Factors of the score of what is cut, and of what hardly ever holds an article; and the score that makes either the article.
CUT, LAST, ENOUGH = 0.25, 0.02, 10.0
NOISE = re.compile(
    r"(?<![^\s_-])(?:ad|ads|adv|advert|advertisement|adsense|advertising|sponsor|sponsored|promo|promotion|banner|sidebar|side-bar|comment|comments|replies|disqus|respond|"
    r"cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|sign-up|social|share|sharing|"
    r"related|recommended|recommendations|breadcrumb|breadcrumbs|nav|navbar|navigation|menu|footer|header|masthead|skip|pager|pagination|toolbar|widget|login)"
    r"(?![^\s_-])",
    re.I,
)
#: Of these, what does not hold the article even if an article element is inside.
STRONG = re.compile(r"related|recommend|cookie|consent|newsletter|subscri|popup|modal|(?:^|[\s_-])ads?(?:$|[\s_-])", re.I)
ARTICLE = re.compile(r"article|post|entry|content|story|main|body|text", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*|=[^\s/>=]*)(\s*=\s*)?")
BARE = re.compile(r"[^\s>]*")
SPACE = re.compile(r"\s+")


#: What readers add, which is cut off for good.
READERS = re.compile(r"comments?|replies|disqus|respond", re.I)


class Node:
    __slots__ = ("tag", "parent", "kids", "kept", "cut", "points", "chars", "linked", "role")

    def __init__(self, tag: str, parent: Node | None, kept: bool) -> None:
        self.tag, self.parent, self.kids, self.kept = tag, parent, [], kept
        #: 0, or 1 if it is cut from what surrounds it, 2 if it does not hold the article
        self.cut = 0
        self.points, self.chars, self.linked, self.role = 0.0, 0, 0, 0


class Path:
    """The open elements, with the places of each tag and of the nearest boundaries."""

    BOUND = frozenset("td th table article section main body".split())
    BLOCK_BOUND = frozenset("td th table article section div li body".split())

    def __init__(self, root: Node) -> None:
        self.nodes, self.places = [root], {}
        self.bound, self.block_bound = [0], [0]
        self.open: list[Node] = []  # those that are cut

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        self.bound.append(at if node.tag in self.BOUND else self.bound[-1])
        self.block_bound.append(at if node.tag in self.BLOCK_BOUND else self.block_bound[-1])
        if node.cut:
            self.open.append(node)

    def leave(self, at: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            self.bound.pop()
            self.block_bound.pop()
            if self.open and self.open[-1] is node:
                self.open.pop()

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def before(self, tag: str) -> None:
        """Leave what the start of an element closes."""
        if tag in BLOCK:
            p = self.last("p")
            if p > self.block_bound[-1]:
                self.leave(p)
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            bound = max(map(self.last, bounds))
            found = [places[i] for places in map(self.places.get, ends) if places and (i := bisect_right(places, bound)) < len(places)]
            if found:
                self.leave(min(found))

    def end(self, tag: str) -> None:
        at = self.last(tag)
        if at and (tag in BLOCK or self.bound[-1] <= at):  # an inline end tag doesn't close a block
            self.leave(at)

    def found_article(self) -> None:
        """An article lies inside: parts that are cut by a name or as a form hold it, unless they never do."""
        if all(node.cut < 2 for node in self.open):
            for node in self.open:
                if node.tag not in ("header", "footer", "aside"):
                    node.cut = 0


def parse(page: str) -> Node:
    """The tree; text is a string among the children."""
    root = Node("html", None, True)
    path, at, end = Path(root), 0, len(page)
    unquoted: set[str] = set()  # quotes that don't come again
    while at < end:
        here = path.nodes[-1]
        lt = page.find("<", at)
        if lt != at:
            if here.kept:
                here.kids.append(entities.unescape(page[at : lt if lt >= 0 else end]))
            if lt < 0:
                break
        at = lt + 1
        if page.startswith(("!", "?"), at):
            mark = "-->" if page.startswith("!--", at) else "]]>" if page.startswith("![CDATA[", at) else ">"
            close = page.find(mark, at)
            at = close + len(mark) if close >= 0 else end
        elif name := NAME.match(page, at + 1 if page.startswith("/", at) else at):
            tag = name[0].lower()
            if page.startswith("/", at):
                close = page.find(">", name.end())
                at = close + 1 if close >= 0 else end
                path.end(tag)
                continue
            attributes, at, closed = _attributes(page, name.end(), unquoted)
            if tag in ("body", "html"):
                continue
            path.before(tag)
            here = path.nodes[-1]
            node = Node(tag, here, here.kept and tag not in DROPPED)
            if node.kept:
                _described(node, attributes)
                if tag == "header" and node.cut == 1 and here.tag == "article":
                    node.cut = 0  # the article's own
            here.kids.append(node)
            if tag in RAW:
                found = _raw_end(tag).search(page, at)
                at = found.end() if found else end
            elif tag not in VOID and (not closed or tag in BLOCK):
                path.push(node)
                if tag in ("article", "main") and node.kept and not node.cut:
                    path.found_article()
        elif here.kept:  # a lone "<" is text
            here.kids.append("<")
    return root


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


def _attributes(page: str, at: int, unquoted: set[str]) -> tuple[list[tuple[str, str]], int, bool]:
    """A start tag's attributes, where it ends, and whether it closes itself."""
    found: list[tuple[str, str]] = []
    while m := ATTRIBUTE.match(page, at):
        at, value = m.end(), ""
        if m[2]:
            quote = page[at : at + 1]
            close = page.find(quote, at + 1) if quote in ("'", '"') and quote not in unquoted else -1
            if close >= 0:
                value, at = page[at + 1 : close], close + 1
            else:
                if quote in ("'", '"'):
                    unquoted.add(quote)
                bare = BARE.match(page, at)
                value, at = bare[0], bare.end()
        found.append((m[1].lower(), value))
    close = page.find(">", at)  # only white space and slashes are left
    return found, close + 1 if close >= 0 else len(page), close > 0 and page[close - 1] == "/"


def _described(node: Node, attributes: list[tuple[str, str]]) -> None:
    if node.tag in APART:
        node.cut = 1
    for name, value in attributes:
        if name in ("class", "id"):
            value = STATE.sub(" ", value)
            if node.tag not in ("main", "p", "b", "i", "em", "strong", "span") and (noise := NOISE.findall(value)):
                if any(map(READERS.match, noise)):
                    node.kept = False
                node.cut = 2 if STRONG.search(value) else max(1, node.cut)
            elif ARTICLE.search(value):
                node.role = 1
        elif name == "role":
            value = value.lower()
            if value in ROLES:
                node.kept = False
            elif value in ROLES_APART:
                node.cut = max(1, node.cut)
            elif value in ("main", "article"):
                node.role = 2
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            node.kept = False


def _walk(root: Node) -> Iterator[tuple[object, bool, bool]]:
    """(node or text, whether it begins, whether it lies in a link), without what is cut off for good, in page order."""
    stack: list[tuple[object, bool, bool]] = [(root, True, False)]
    while stack:
        item, begins, link = stack.pop()
        yield item, begins, link
        if begins and isinstance(item, Node):
            inside = link or item.tag == "a"
            stack.append((item, False, link))
            stack.extend((k, True, inside) for k in reversed(item.kids) if isinstance(k, str) or k.kept)


def blocks(root: Node) -> list[tuple[str, Node, int]]:
    """(text, innermost block element or cut element, characters in links) of each block."""
    found: list[tuple[str, Node, int]] = []
    parts: list[str] = []
    linked, holder = 0, [root]

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            found.append((text, holder[-1], min(linked, len(text))))
        parts.clear()
        linked = 0

    for item, begins, link in _walk(root):
        if isinstance(item, str):
            parts.append(item)
            linked += len(item.strip()) if link else 0
        elif item.tag in BLOCK or item.cut:
            flush()
            if begins:
                holder.append(item)
            else:
                holder.pop()
        elif item.tag == "br" and begins:
            parts.append(" ")
    flush()
    return found


HELD = frozenset("p pre li td blockquote h1 h2 h3 h4 h5 h6 dd dt".split())
BASE = {"article": 10.0, "main": 8.0, "section": 2.0, "div": 3.0, "ul": -3.0, "ol": -3.0}


def _score(root: Node, found: list[tuple[str, Node, int]]) -> list[Node]:
    """The containers with points; every node has its characters then, without those of parts that are cut from it."""
    scored: dict[int, Node] = {}
    for text, holder, linked in found:
        holder.chars += len(text)
        holder.linked += linked
        points = 1.0 + text.count(",") + min(len(text) / 100.0, 3.0)
        node, up = holder, 0
        if holder.tag in HELD and holder.parent is not None and not holder.cut:
            node = holder.parent
        while node is not None and up < 6:
            if id(node) not in scored:
                scored[id(node)] = node
                node.points += BASE.get(node.tag, 0.0) + 5.0 * node.role
            node.points += points / (1, 2, 6, 9, 12, 15)[up]
            node, up = None if node.cut else node.parent, up + 1
    for item, begins, _ in _walk(root):
        if not begins and isinstance(item, Node) and item.parent is not None and not item.cut:
            item.parent.chars += item.chars
            item.parent.linked += item.linked
    return list(scored.values())


def _own(node: Node) -> float:
    """Points discounted by link density."""
    return node.points * (1.0 - _density(node))


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _factors(root: Node) -> dict[int, float]:
    """The factor of each element that lies in a cut part."""
    found: dict[int, float] = {}
    open_ = [1.0]
    for item, begins, _ in _walk(root):
        if isinstance(item, Node):
            if not begins:
                open_.pop()
                continue
            open_.append(min(open_[-1], (1.0, CUT, LAST)[item.cut]))
            if open_[-1] < 1.0:
                found[id(item)] = open_[-1]
    return found


def main_text(page: str | None) -> str:
    root = parse((page or "").replace("\r\n", "\n"))
    found = blocks(root)
    if not found:
        return ""
    scored, factors = _score(root, found), _factors(root)
    # a part that is cut is the article only if it reads like one
    scored = [n for n in scored if id(n) not in factors or _own(n) >= ENOUGH]
    if not scored:
        return ""
    best = max(scored, key=lambda n: _own(n) * factors.get(id(n), 1.0))
    score, node, article = _own(best), best, None
    while node is not None:  # what leads to the best container isn't cut after all
        node.cut = 0
        if article is None and node.tag in ("article", "main"):
            article = node
        node = node.parent
    best = article or best  # what lies beside the best container in its article belongs to it
    keep = {id(best)}
    if best.parent is not None and article is None:
        for kid in best.parent.kids:
            if isinstance(kid, Node) and kid is not best and kid.kept and not kid.cut and kid.chars:
                running = kid.tag in ("p", "h1", "h2", "h3") and _density(kid) < 0.25 and (kid.chars > 80 or kid.tag != "p")
                if running or _own(kid) >= max(10.0, 0.2 * score):
                    keep.add(id(kid))
    inside: set[int] = set()
    open_ = [False]
    for item, begins, _ in _walk(root):
        if isinstance(item, Node):
            if begins:
                open_.append(not item.cut and (open_[-1] or id(item) in keep))
                if open_[-1]:
                    inside.add(id(item))
            else:
                open_.pop()
    return "\n".join(text for text, holder, _ in found if id(holder) in inside)


def extract_main(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` without its html, with ``text`` and ``n_chars`` (code points)."""
    rest = [c for c in df.columns if c != html and c.lower() not in ("text", "n_chars")]
    schema = df.select(*rest, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"]
            )

    return df.select(*rest, html).mapInArrow(run, schema)


ship(__name__)
