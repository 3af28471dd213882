"""Main text of web pages by tree scoring.

Text blocks give points for length and commas to the elements around them, the
nearer the more. An element's points are discounted by the share of its text
that is link text. The best container is kept with those of its siblings that
score well too; menus, adverts, notices, forms, comments and the like are left
out by what elements are and what they are called. A name, or being a form,
counts less than the text: what holds most of it stays in the running at a discount.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: A comment, a tag whose quoted values may hold anything, a declaration, or a tag with quotes that do not match. If a ``>``
#: follows, a ``<`` is settled within the next few marks; nothing is given back.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never main text.
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed footer frameset head header iframe input menu meter nav noembed noframes noscript object "
    "progress script search select style svg template textarea title video".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation note search toolbar".split())
#: Words in class or id of what is not main text.
NEGATIVE = re.compile(
    r"^(?:ad|ads|adbox|adslot|adsense|advert\w*|adv|banner\w*|breadcrumb\w*|byline|comment\w*|consent|cookie\w*|copyright|disclaimer|discuss\w*|disqus|foot|footer\w*|footnav|gdpr|"
    r"head|header\w*|hidden|login|masthead|menu\w*|modal|nav\w*|newsletter\w*|notice\w*|outbrain|overlay|pager|paginat\w*|popup\w*|promo\w*|recommend\w*|related\w*|remark\w*|repl(?:y|ies)|"
    r"respond|rail|share\w*|sharing|shoutbox|sidebar\w*|sidecol|signup|skyscraper|social\w*|sponsor\w*|subscri\w*|taboola|teaser\w*|toolbar|topbar|tracking|widget\w*)$")
POSITIVE = re.compile(r"^(?:article\w*|body|column|content\w*|entry\w*|hentry|main\w*|page|post\w*|story\w*|text|blog)$")
#: A class or id of these words only speaks for an element that another one speaks against.
NAMED_TEXT = re.compile(r"^(?:articles?|contents?|entry|entries|hentry|main|posts?|story|blog)$")
#: What is left of the points of text in elements that were spared in spite of their names.
DISCOUNT = 0.6
#: Never left out for their class: they hold the page or the article.
HOLDERS = frozenset("html body article main".split())
#: An opening tag ends an open element of these kinds, within the nearest of the borders.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BORDERS = frozenset("ul ol dl table article section div body main".split())


class Node:
    __slots__ = ("tag", "parent", "out", "good", "doubt", "named", "spared", "scope", "held", "own", "chars", "linked", "links", "score", "kept", "holds", "headed")

    def __init__(self, tag: str, parent: Node | None, out: bool, good: bool, doubt: bool = False, named: bool = False):
        self.tag, self.parent, self.out, self.good, self.doubt, self.named = tag, parent, out, good, doubt, named
        self.chars = self.linked = self.links = 0
        self.score = self.held = self.own = 0.0
        self.kept = self.holds = self.spared = self.headed = False
        self.scope = self


def _signs(tag: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """(left out, likely to be the article, called what is not main text, called main text as a whole) from an element's attributes."""
    out = good = doubt = named = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            for word in re.split(r"[^a-z0-9]+", value):
                doubt = doubt or bool(NEGATIVE.match(word))
                good = good or bool(POSITIVE.match(word))
            if doubt or good:
                named = named or any(all(NAMED_TEXT.match(w) for w in re.split(r"[-_]+", x)) for x in value.split())
        elif name == "role":
            out = out or value in LEFT_OUT_ROLES
            doubt = doubt or value == "form"
            good = good or value in ("main", "article")
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out = True
    return out and tag not in HOLDERS, good, doubt and tag not in HOLDERS, named


class _Open:
    """The open elements, with the places of each tag, of blocks and of borders, so that no search goes through the stack."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.places: dict[str, list[int]] = {root.tag: [0]}
        self.blocks, self.borders = [0], []

    def push(self, node: Node) -> None:
        at = len(self.stack)
        self.stack.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCK:
            self.blocks.append(at)
        if node.tag in BORDERS:
            self.borders.append(at)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            if tag in BORDERS:
                self.borders.pop()

    def count(self, tag: str) -> int:
        return len(self.places.get(tag, ()))

    def last(self, *tags: str) -> int:
        """Place of the innermost of these elements; 0 if there is none above the root."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """Elements in page order, and text blocks (element, text, characters of link text). Time is linear in the page."""
    root = Node("html", None, False, False)
    nodes, blocks, open_ = [root], [], _Open(root)
    stack = open_.stack
    run: list[str] = []
    link_run = 0

    def close_block() -> None:
        nonlocal link_run
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append((stack[open_.blocks[-1]], text, min(link_run, len(text))))
            run.clear()
        link_run = 0

    def text_at(text: str) -> None:
        nonlocal link_run
        run.append(text)
        if open_.count("a"):
            link_run += len(" ".join(html.unescape(text).split()))

    at, end = 0, page.rfind(">") + 1  # no tag ends behind this
    while True:
        m = TOKEN.search(page, at, end) if at < end else None
        if m is None:
            open_comment = page.find("<!--", max(at, end))
            text_at(page[at:open_comment if open_comment >= 0 else len(page)])
            break
        if m.start() > at:
            text_at(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                # it may yet end, or not, behind the last tag
                at = len(page)
            continue
        if tag in BLOCK:
            close_block()
        if m[1] or m[4]:
            depth = open_.last(tag)
            if depth:
                if tag in BLOCK or open_.blocks[-1] < depth:
                    open_.pop_to(depth)
            elif tag == "p":
                close_block()
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in ("html", "body") and open_.count(tag):
            continue
        if tag in BLOCK:
            # a paragraph ends where another block begins
            i = open_.blocks[-1]
            if i and (stack[i].tag == "p" or (stack[i].tag in HEADINGS and tag in HEADINGS)):
                open_.pop_to(i)
        if tag in ENDS:
            while (i := open_.last(*ENDS[tag])) and not (open_.borders and open_.borders[-1] > i):
                open_.pop_to(i)
                if tag != "tr" or stack[-1].tag not in ENDS[tag]:
                    break
        elif tag == "a" and open_.count("a"):
            i = open_.last("a")
            if open_.blocks[-1] < i:
                open_.pop_to(i)
        parent = stack[-1]
        attributes = m[3] or m[6] or ""
        out, good, doubt, named = _signs(tag, attributes) if attributes.strip(" /") else (False, False, False, False)
        if tag == "header" and (open_.count("article") or open_.count("main")):
            pass  # its headings are the article's
        elif tag == "form":
            doubt, named = True, False
        elif tag in LEFT_OUT:
            out = True
        node = Node(tag, parent, out, good, doubt, named)
        nodes.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif tag not in VOID and not attributes.endswith("/") or (tag in BLOCK and tag not in VOID):
            open_.push(node)
            if tag == "a":
                node.links = 1
    close_block()
    for n in reversed(nodes):
        if n.parent is not None:
            n.parent.links += n.links
    return nodes, blocks


def main_text(page: str | None) -> str:
    """The page's main text: blocks in page order, joined by two line ends; empty if there is none."""
    if not page:
        return ""
    nodes, blocks = parse(page)
    for n in reversed(nodes):
        if n.parent is not None and (n.holds or n.tag in ("article", "main")):
            n.parent.holds = True
    for n in nodes:  # what holds the article is not left out for its name; what is left out takes its content along
        n.out = n.out and not (n.holds and n.tag not in LEFT_OUT) or (n.parent is not None and n.parent.out)
        n.doubt = n.doubt and not n.holds
    points = [0.0 if node.out else _points(text, linked) for node, text, linked in blocks]
    _weigh(nodes, blocks, points)
    for n in nodes:  # within a header of an article, only headings and paragraphs count
        n.headed = n.tag not in ("article", "main") and (n.tag == "header" or (n.parent is not None and n.parent.headed))
    live = []
    for (node, text, linked), worth in zip(blocks, points, strict=True):
        if not node.out and not (node.tag != "p" and node.tag not in HEADINGS and node.headed):
            live.append((node, text, worth * DISCOUNT if node.spared else worth))
            node.chars += len(text)
            node.linked += linked
    for n in reversed(nodes):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked
    for node, _, worth in live:
        to = node if node.tag in ("div", "section", "article", "main", "body", "html", "td") else node.parent or node
        for level in range(1, 6):
            to.score += worth / level
            if to.parent is None:
                break
            to = to.parent
    best = None
    for n in nodes:
        if n.out or not n.chars:
            continue
        if (n.good and (n.named or not n.doubt)) or n.tag in ("article", "main"):
            n.score += 25
        n.score *= 1 - n.linked / n.chars
        if n.tag in BLOCK and n.tag != "p" and n.tag not in HEADINGS and (best is None or n.score > best.score):
            best = n
    if best is None:
        return ""
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    best = up or best
    _drop_beside(nodes, best)
    best.kept = True
    if best.parent is not None:
        for n in nodes:
            if n.parent is best.parent and n is not best and not n.out and n.chars:
                density = n.linked / n.chars
                doubt = 25 if n.doubt and not best.doubt else 0  # its text alone has to do
                if n.tag in HEADINGS or n.score >= max(10.0, 0.2 * best.score) + doubt or (n.tag == "p" and density < 0.25 and best.tag not in ("article", "main")):
                    n.kept = True
    for n in nodes:
        p = n.parent
        if p is not None and p.kept:
            n.kept = True
        # lists of links inside the article
        if n is not best and n.kept and n.links >= 2 and n.tag in ("ul", "ol", "dl", "div", "section", "table") and n.chars and n.linked > 0.6 * n.chars:
            n.out = True
        n.out = n.out or (p is not None and p.out)
    return "\n\n".join(text for node, text, _ in live if node.kept and not node.out or node is best)


def _points(text: str, linked: int) -> float:
    """Points of a block for length and commas, less its share of link text."""
    return ((len(text) >= 25) + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))


def _weigh(nodes: list[Node], blocks: list[tuple[Node, str, int]], points: list[float]) -> None:
    """Leave out the elements in doubt, save those that are also called main text or hold more text than is around them.

    Around them is the text that is in no doubt itself, of the page or of the
    element in doubt that they are in.
    """
    for n in nodes:
        n.scope = n if n.parent is None or (n.doubt and not n.named) else n.parent.scope
    for (node, _, _), worth in zip(blocks, points, strict=True):
        node.held += worth
        node.scope.own += worth
    for n in reversed(nodes):
        if n.parent is not None:
            n.parent.held += n.held
    for n in nodes:
        if n.doubt and not (n.named or n.held > n.parent.scope.own):
            n.out = True
        n.out = n.out or (n.parent is not None and n.parent.out)
        n.spared = not n.out and (n.doubt or (n.parent is not None and n.parent.spared))


def _drop_beside(nodes: list[Node], best: Node) -> None:
    """Leave out what was spared for the text that it holds, but is beside the best container."""
    around, n = set(), best
    while n is not None:
        around.add(id(n))
        n = n.parent
    inside = set()
    for n in nodes:
        if n is best or (n.parent is not None and id(n.parent) in inside):
            inside.add(id(n))
        elif n.doubt and not n.named and id(n) not in around:
            n.out = True


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row. Null html gives an empty text, an empty table no rows; repeated rows are
    extracted alike, and pages of any length whole, in time linear in their length. Other columns are not read."""
    prepare(pages.sparkSession)

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None).astype(object)

    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.pandas_udf(texts, "string")(F.coalesce(F.col(html_col), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
