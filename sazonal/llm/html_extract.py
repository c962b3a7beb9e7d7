"""Main text of web pages by scoring the element tree.

Paragraphs give points, for a base, their commas and their length, to the elements around
them, less with distance; an element's points are discounted by the share of its text that
stands in links. The best container is kept, with siblings that score well or read like
prose, and with what lies below their common parents if other containers score alike. Class
and id words cut an element that is small, full of links or named by such words alone, and
nothing if no text were left. Blocks of what is kept come out in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML, and words of class and id names that pages use for
# what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template head title iframe object embed svg math canvas nav footer aside "
    "button select textarea input label fieldset dialog menu option datalist audio video map".split()
)
BLOCKS = frozenset(
    "p div section article main header h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody "
    "tfoot tr td th caption figure figcaption address details summary hr body html".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A paragraph's end tag may be left out before these.
CLOSES_P = BLOCKS - frozenset("td th tr thead tbody tfoot caption body html".split())
SAME_LEVEL = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "thead", "tbody", "tfoot")), "td": ("td th", ("tr",)),
    "th": ("td th", ("tr",)), "option": ("option", ("select",)),
}
UNWANTED = re.compile(
    r"(?<![a-z])(ad|ads|adv|advert|advertisement|adverts|advertising|banner|breadcrumb|breadcrumbs|comment|"
    r"comments|commentlist|consent|cookie|cookies|disqus|discussion|footer|gdpr|menu|modal|masthead|"
    r"nav|navbar|navigation|newsletter|notice|notices|pager|pagination|popup|promo|promoted|recommended|"
    r"related|replies|respond|share|sharing|sidebar|skyscraper|social|sponsor|sponsored|subscribe|"
    r"toolbar|topbar|widget|widgets|alert|disclaimer|login|signup|search|(?:site|page|top|main|global)-?header)(?![a-z])|^header$"
)
#: Words of names that pages use for the article, for states of a page, and for its readers' part.
WANTED = re.compile(r"(?<![a-z])(article|body|content|entry|main|page|post|result|results|story|text|wrapper)(?![a-z])")
STATE = re.compile(r"(?<![a-z])(has|no|with|without|is|hide|show)-[a-z-]+")
READERS = re.compile(r"(?<![a-z])(comment|comments|commentlist|disqus|discussion|replies|respond)(?![a-z])")
UNWANTED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"\s+")
#: Text of a small element, share of links of one full of them, share of the best score that
#: is alike.
SMALL, LINKED, ALIKE = 200, 0.3, 0.2


class Node:
    __slots__ = ("tag", "parent", "children", "points", "unwanted", "named", "text", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, unwanted: bool = False, named: str = ""):
        self.tag, self.parent, self.unwanted, self.named = tag, parent, unwanted, named
        self.children: list[Node | str] = []
        self.points = 0.0
        self.text = self.linked = self.commas = 0


class TreeBuilder(HTMLParser):
    """Element tree of a page; end tags may be missing."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p", BLOCKS - {"p"})
        if tag in SAME_LEVEL:
            names, bounds = SAME_LEVEL[tag]
            for name in names.split():
                self._close(name, bounds)
        if tag in ("html", "body"):
            return
        node = Node(tag, self.at, _unwanted(tag, attrs), _named(tag, attrs))
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        self._close(tag, ())

    def handle_data(self, data):
        self.at.children.append(data)

    def _close(self, tag, bounds):
        node = self.at
        while node is not self.root:
            if node.tag == tag:
                self.at = node.parent
                return
            if node.tag in bounds:
                return
            node = node.parent


def _unwanted(tag: str, attrs) -> bool:
    if tag in SKIPPED:
        return True
    for name, value in attrs:
        value = value or ""
        if name == "role" and value.lower() in UNWANTED_ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and HIDDEN.search(value):
            return True
    return False


def _named(tag: str, attrs) -> str:
    """What class and id say against an element: "only" or "readers" if that is all they say,
    "also" if they call it an article as well or it is a form, else nothing."""
    # The article and its own header may be named anything.
    found = "also" if tag == "form" else ""
    for name, value in attrs if tag not in ("article", "main") else ():
        if name in ("class", "id") and value:
            words = STATE.sub("", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().replace("_", "-"))
            if READERS.search(words):
                return "readers"
            if UNWANTED.search(words):
                found = "also" if found != "only" and WANTED.search(words) else "only"
    return found


def _below(root: Node) -> Iterator[tuple[Node, bool]]:
    """Wanted elements without recursion: (node, entering)."""
    stack = [(root, True)]
    while stack:
        node, entering = stack.pop()
        yield node, entering
        if entering:
            stack.append((node, False))
            stack.extend(
                (child, True) for child in reversed(node.children)
                if isinstance(child, Node) and not child.unwanted
            )


def _page_header(node: Node) -> bool:
    """A header outside articles is the page's."""
    while node is not None:
        if node.tag in ("article", "main"):
            return False
        node = node.parent
    return True


def _weigh(root: Node) -> None:
    links = 0
    for node, entering in _below(root):
        if entering:
            links += node.tag == "a"
            node.points, node.text, node.linked, node.commas = 0.0, 0, 0, 0
            for child in node.children:
                if isinstance(child, str):
                    size = len(SPACE.sub(" ", child.strip()))
                    node.text += size
                    node.linked += size if links else 0
                    node.commas += child.count(",") + child.count("，") + child.count("、")
            continue
        links -= node.tag == "a"
        parent = node.parent
        if parent is not None:
            parent.text += node.text
            parent.linked += node.linked
            parent.commas += node.commas
        if node.tag in PARAGRAPHS and node.text:
            points = (1.0 + node.commas + min(node.text / 100.0, 3.0)) * (1.0 - node.linked / node.text)
            above, share = parent, 1.0
            while above is not None:
                above.points += points * share
                share = share / 2.0 if share == 1.0 else share / 1.5
                above = above.parent


def _score(node: Node) -> float:
    score = node.points * (1.0 - node.linked / node.text if node.text else 0.0)
    # The names say what a container is for.
    return score * {"article": 2.0, "main": 1.5}.get(node.tag, 1.0)


def main_blocks(html: str) -> list[str]:
    """The kept blocks of a page, white space within each made one space."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    root = builder.root
    named = []
    for node, entering in _below(root):
        for child in node.children if entering else ():
            if isinstance(child, Node) and child.tag == "header" and _page_header(child):
                child.unwanted = True
        if entering and node.named:
            named.append(node)
    _weigh(root)
    sized = {node: node.text < SMALL or node.linked > LINKED * node.text for node in named}
    first: list[str] = []
    # If next to nothing is left, names count for less, and at last for nothing.
    for kept in ((), ("only", "also"), ("only", "also", "readers")) if named else ((),):
        for node in named:
            node.unwanted = node.named not in kept and (node.named != "also" or sized[node])
        if named:
            _weigh(root)
        blocks = _chosen(root)
        size = sum(map(len, blocks))
        if not kept and size >= SMALL or kept and size >= (3 * SMALL if first else 1):
            return blocks
        first = first or blocks
        if kept and first:
            break
    return first


def _chosen(root: Node) -> list[str]:
    """Blocks of the best container and of what goes with it."""
    best, best_score = root, 0.0
    scores: list[tuple[float, Node]] = []
    for node, entering in _below(root):
        if entering and node.tag not in PARAGRAPHS and node.tag in BLOCKS:
            scores.append((score := _score(node), node))
            if score > best_score:
                best, best_score = node, score
    holders = {best}
    if best.parent is None:
        siblings = [best]
    elif best.tag in ("article", "main"):
        siblings = [s for s in best.parent.children if s is best or isinstance(s, Node) and s.tag == best.tag]
    else:
        best_above = _above(best)
        within = set(best_above)
        ways = {best}
        for score, node in scores:
            if score >= ALIKE * best_score and node not in within and node.linked <= LINKED * node.text:
                path = _above(node)
                if best not in path:
                    ways.add(node)
                    holders.update(path)
        top = best.parent
        if len(ways) > 1:
            # The lowest element that all of them are below.
            shared = set(best_above)
            for node in ways - {best}:
                shared &= set(_above(node)[1:])
            top = next(x for x in best_above[1:] if x in shared)
            holders.update(best_above)
            if top is not best.parent:
                for node, entering in _below(top):
                    if entering and node.tag in BLOCKS and node.text and node.linked > 0.5 * node.text and node not in holders:
                        node.unwanted = True
        siblings = top.children
    bar = max(10.0, 0.2 * best_score)
    chosen = [
        s in holders or isinstance(s, Node) and not s.unwanted and _joins(s, bar)
        for s in siblings
    ]
    first, last = chosen.index(True), len(chosen) - 1 - chosen[::-1].index(True)
    blocks: list[str] = []
    for at, sibling in enumerate(siblings):
        if chosen[at] or at < last and isinstance(sibling, Node) and not sibling.unwanted and (
            sibling.text and not sibling.linked and (
                sibling.tag in HEADINGS or at > first and sibling.tag in PARAGRAPHS
            )
        ):
            _collect(sibling, blocks)
    return blocks


def _above(node: Node) -> list[Node]:
    """The element and all above it."""
    found = []
    while node is not None:
        found.append(node)
        node = node.parent
    return found


def _joins(node: Node, bar: float) -> bool:
    if _score(node) >= bar:
        return True
    density = node.linked / node.text if node.text else 1.0
    if node.tag in PARAGRAPHS:
        return node.text > 80 and density < 0.25 or 0 < node.text <= 80 and density == 0 and node.commas > 0
    return False


def _collect(top: Node, blocks: list[str]) -> None:
    """Text of the wanted elements below ``top``, cut where a block starts or ends."""
    run: list[str] = []

    def cut() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            blocks.append(text)

    stack: list = [top]
    while stack:
        item = stack.pop()
        if item is None:
            cut()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        elif not item.unwanted:
            if item.tag in BLOCKS:
                cut()
                stack.append(None)
            stack.extend(reversed(item.children))
    cut()


def extract_text(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """Columns ``keep`` with (text, n_chars), one row per page.

    ``text`` is the article's blocks joined by two line feeds, empty if there is none; null
    and empty pages have none. Pages are read whole and independently: repeated pages give
    the same text, an empty table no rows.
    """
    row = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_blocks(html)) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                names=["kept", "text", "n_chars"],
            )

    kind = row.schema["kept"].dataType.simpleString()
    return row.mapInArrow(run, f"kept {kind}, text string, n_chars long").select("kept.*", "text", "n_chars")
