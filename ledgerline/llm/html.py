"""Main text of web pages by composite text density.

Every node of the page's tree gets a density: its characters per tag, reduced by the share that
links have in it, compared with the share they have in the page. The node whose children have the
largest sum of densities is the root of the text. The least density on the path from the body to
that root is the threshold by which nodes beside the path still belong to the text.

Parts that the markup itself names as navigation, advert, form, comment and the like are taken out
before. Names are not trusted alone: what holds the article, or most of the plain text of a page
without one, is not beside it, whatever it is called. Within an article names that are also those
of its sections take a part out only if it is mostly links. The rest of an article stays.

Every step is linear in the page, whatever its markup: tags are read forwards once, and open
elements are found by name.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks

# Element kinds of HTML, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text, not markup; only that of xmp is shown as part of an article.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
DROPPED = frozenset(
    "head nav footer aside form header button select option dialog menu svg canvas object audio video map datalist annotation annotation-xml".split()
) | RAW - {"xmp"}
#: What of these stands inside an article is what it shows without scripts and players.
FALLBACK = frozenset("object noscript".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption xmp".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Begin tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html body caption tbody td tfoot th thead tr".split())
#: Open elements that a begin tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Words in class, id or role that name something other than the article.
ASIDE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay toast sidebar side nav navbar navigation menu menubar topbar breadcrumb breadcrumbs footer "
    "header masthead comment comments commentlist disqus respond reply replies discussion related recommended recommendations "
    "share sharing social newsletter subscribe subscription signup login paywall search searchbox pagination pager widget widgets "
    "toolbar skip contentinfo complementary form hidden".split()
)
#: Those of them that may stand inside an article, around its title.
HEADS = frozenset("header masthead".split())
#: Those that may as well name a section of the article.
WEAK = HEADS | frozenset(
    "discussion related recommended recommendations notice notices alert search skip subscription side menu navigation promotion form".split()
)
#: Those that name what readers wrote, however long it is.
READERS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Words in class, id or role that name the article.
MAIN = frozenset("article main content post entry story body text".split())

#: What a "<" begins: a tag up to its attributes, or markup without a name.
TAG = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)")
#: What ends a tag or begins a quoted value in it.
QUOTE_OR_END = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HIDES = re.compile(r"display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z]+")


class Node:
    """`beside`: not of the article by its kind or because hidden (HARD), or by its name (NAMED)."""

    __slots__ = ("name", "parent", "children", "beside", "chars", "tags", "link_chars", "link_tags", "density", "main", "hint", "readers")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.beside, self.main, self.hint, self.readers = 0, False, False, False
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0

    @property
    def aside(self) -> bool:
        return self.beside > 0


HARD, NAMED = 2, 1


def _judge(node: Node, attributes: str, inside: bool) -> bool:
    """Marks a node by its kind and attributes; says whether it is the page's article.

    Names within an article are no more than a hint if they are also those of sections; on headings
    and paragraphs there and as generated ids of headings anywhere they are not even that.
    """
    name = node.name
    article = name in ("article", "main")
    if name == "form":
        node.beside = NAMED
    elif name in DROPPED and not (inside and (name == "header" or name in FALLBACK)):
        node.beside = HARD
        return False
    main = article
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and HIDES.search(value)):
            node.beside = HARD
            return False
        if (key == "role" and value.strip() in ("main", "article")) or (key == "itemprop" and value.strip() == "articlebody"):
            article = main = True
        if key not in ("class", "id", "role"):
            continue
        words = set(WORD.findall(value))
        main = main or bool(words & MAIN)
        named = words & ASIDE - (HEADS if inside else frozenset())
        if not named or name in ("article", "main") or (name in HEADING and key == "id"):
            continue
        if key == "class" and "hidden" in named:
            node.beside = HARD
            return False
        if inside and (name in HEADING or name == "p"):
            continue
        node.readers = node.readers or bool(named & READERS)
        if not inside or (named - WEAK and not (name == "section" and key == "id" and not named & READERS)):
            node.beside = NAMED
        else:
            node.hint = True
    if article:
        node.beside = 0
    node.hint = node.hint and not node.beside
    node.main = main and not node.beside and not node.hint
    return article


class _Open:
    """The open elements, with where each name and kind stands among them."""

    def __init__(self, root: Node) -> None:
        self.nodes, self.at = [root], {}
        self.blocks: list[int] = []
        self.articles: list[int] = []
        self.cleared = 1

    def push(self, node: Node, article: bool) -> None:
        i = len(self.nodes)
        self.nodes.append(node)
        self.at.setdefault(node.name, []).append(i)
        if node.name in BLOCK:
            self.blocks.append(i)
        if article:
            self.articles.append(i)

    def cut(self, i: int) -> None:
        """Ends the elements from the i-th on."""
        while len(self.nodes) > i:
            self.at[self.nodes.pop().name].pop()
        for places in (self.blocks, self.articles):
            while places and places[-1] >= i:
                places.pop()
        self.cleared = min(self.cleared, i)

    def last(self, names: Iterable[str]) -> int:
        """Where the innermost open element of these names stands, or 0."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)

    def clear(self) -> None:
        """What holds the article is not beside it, whatever its name."""
        for x in self.nodes[self.cleared :]:
            x.beside = 0 if x.beside == NAMED else x.beside
        self.cleared = len(self.nodes)


def _tag_end(page: str, at: int) -> int:
    """Where the tag ends whose attributes begin at `at`: a quote that is never closed ends it at the next ">"."""
    while True:
        m = QUOTE_OR_END.search(page, at)
        if m is None:
            return len(page)
        if m[0] == ">":
            return m.end()
        close = page.find(m[0][-1], m.end())
        if close < 0:
            end = page.find(">", m.end())
            return len(page) if end < 0 else end + 1
        at = close + 1


def _past(page: str, mark: str, at: int) -> int:
    end = page.find(mark, at)
    return len(page) if end < 0 else end + len(mark)


def parse(page: str) -> Node:
    """The tree of a page; missing end tags are supplied, markup that breaks off ends there."""
    root = Node("body", None)
    open_, at, n = _Open(root), 0, len(page)

    def text(s: str) -> None:
        if s:
            open_.nodes[-1].children.append(html.unescape(s))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        m = TAG.match(page, lt)
        if m is None:
            if page.startswith("<!--", lt):
                at = _past(page, "-->", lt + 4)
            elif page.startswith("<![CDATA[", lt):
                at = _past(page, "]]>", lt + 9)
            elif page.startswith(("<!", "<?"), lt):
                at = _past(page, ">", lt + 2)
            else:
                text("<")
                at = lt + 1
            continue
        at = _tag_end(page, m.end())
        attributes, name = page[m.end() : at].removesuffix(">"), m["name"].lower()
        if m["end"]:
            i = open_.last((name,))
            if i and (name in BLOCK or i >= open_.last(("table", "td", "th", "li"))):
                open_.cut(i)
            continue
        if name in ("html", "body"):
            continue
        if name in ENDS_P and open_.blocks and open_.nodes[open_.blocks[-1]].name == "p":
            open_.cut(open_.blocks[-1])
        if name in ENDS:
            same, beyond = ENDS[name]
            i = open_.last(same)
            if i > open_.last(beyond):
                open_.cut(i)
        node = open_.nodes[-1]
        if name == "br":
            node.children.append(" ")
            continue
        inside = bool(open_.articles)
        made = Node(name, node)
        article = _judge(made, attributes, inside)
        node.children.append(made)
        if article:
            open_.clear()
        if name in RAW and not (inside and name in FALLBACK):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if name == "xmp":
                made.children.append(page[at : end.start() if end else n])
            at = _past(page, ">", end.start()) if end else n
            continue
        if name not in VOID and not attributes.endswith("/"):
            open_.push(made, article)
    return root


def restore(root: Node) -> None:
    """A name takes out no more than half of the plain text of a page that marks no article.

    What readers wrote stays out all the same.
    """
    order, stack, found = [], [root], False
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(c for c in x.children if isinstance(c, Node) and c.beside != HARD)
    plain: dict[Node, int] = {}  # of a node without the parts beside it
    total = 0
    for x in reversed(order):
        own = sum(len("".join(c.split())) for c in x.children if isinstance(c, str)) if x.name != "a" else 0
        own += sum(plain[c] for c in x.children if isinstance(c, Node) and c in plain and not c.beside) if x.name != "a" else 0
        plain[x] = own
        if x.beside:
            total += own
        elif own and x.name in ("article", "main"):
            found = True
    total += plain[root]
    if found:
        return
    for x in order:
        if x.beside and not x.readers and 2 * plain[x] > total:
            up: Node | None = x
            while up is not None:
                up.beside = 0
                up = up.parent
            return  # no two parts hold more than half


def _visible(node: Node) -> Iterator[Node]:
    return (c for c in node.children if isinstance(c, Node) and not c.aside)


def _order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(_visible(x))
    order.reverse()
    return order


def measure(root: Node) -> list[Node]:
    """Characters, tags and the share of links of every node, children before parents.

    What a name inside the article hints at is beside it if it is mostly links as well.
    """
    order, hints = _order(root), False
    for x in order:
        for c in x.children:
            if isinstance(c, str):
                x.chars += len("".join(c.split()))
            elif not c.aside:
                x.chars += c.chars
                x.tags += c.tags + 1
                x.link_chars += c.link_chars
                x.link_tags += c.link_tags + (c.name == "a")
        if x.name == "a":
            x.link_chars = x.chars
        if x.hint and _link_heavy(x):
            x.beside, hints = NAMED, True
    if hints:
        order = _order(root)
    share = root.link_chars / root.chars if root.chars else 0.0
    for x in order:
        if x.chars:
            plain = x.chars - x.link_chars
            base = math.log(x.chars * x.link_chars / max(plain, 1) + share * x.chars + math.e)
            ratio = x.chars / max(x.link_chars, 1) * max(x.tags, 1) / max(x.link_tags, 1)
            x.density = x.chars / max(x.tags, 1) * math.log(max(ratio, 1.0)) / math.log(max(base, math.e))
    return order


def _link_heavy(x: Node) -> bool:
    return 2 * x.link_chars > x.chars


def content(root: Node) -> list[Node | str]:
    """The nodes that make up the text, in page order."""
    restore(root)
    order = measure(root)
    if not root.chars:
        return []
    best, most = root, -1.0
    for x in order:
        total = sum(c.density for c in _visible(x))
        if total >= most and x.chars:
            best, most = x, total
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    out: list[Node | str] = []
    after: list[list[Node | str]] = []
    article = False
    for x, below in zip(reversed(path), reversed([None, *path[:-1]])):
        if below is None:
            out.append(x)
            break
        article = article or x.name == "article"
        spot = next(i for i, c in enumerate(x.children) if c is below)
        kept = [(i, c) for i, c in enumerate(x.children) if i != spot and _belongs(c, article or x.main, threshold)]
        out += [c for i, c in kept if i < spot]
        after.append([c for i, c in kept if i > spot])
    return out + [c for level in reversed(after) for c in level]


def _belongs(c: Node | str, within: bool, threshold: float) -> bool:
    if isinstance(c, str):
        return within
    return not c.aside and (within or not _link_heavy(c) and (c.main or c.name in HEADING or c.density >= threshold))


def main_text(page: str | None) -> str:
    """Blocks of the main text joined by an empty line; empty if there is none."""
    if not page:
        return ""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        words = "".join(line).split()
        line.clear()
        if words:
            out.append(" ".join(words))

    stack: list[Node | str | None] = list(reversed(content(parse(page))))
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif not x.aside:
            if x.name in BLOCK:
                end()
                stack.append(None)
            stack.extend(reversed(x.children))
    end()
    return "\n\n".join(out)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All columns of `pages` but the html, with `text` and `n_chars` (its code points).

    A null or empty page, or one without text, gives an empty text. Repeated rows are extracted each.
    Columns named `text` or `n_chars` are replaced, all others pass through.
    """
    rest = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "_html"):
            texts = [main_text(x) for x in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("rest"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["rest", "text", "n_chars"])

    given = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{html_column}`").cast("string").alias("_html"))
    kind = given.schema["rest"].dataType.simpleString()
    done = given.mapInArrow(run, f"rest {kind}, text string, n_chars long")
    return done.select(*[F.col(f"rest.`{c}`").alias(c) for c in rest], "text", "n_chars")
