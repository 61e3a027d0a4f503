"""Main text of web pages by composite text density.

For every DOM node: C code points of text, T tags, LC code points inside links and LT link tags below it. Its
density is C / T times the logarithm of (C / LC) * (T / LT) to a base that grows with the share of link text on
the page, so a menu scores low and running text high. The node with the largest sum of its children's densities
is selected (paragraphs and inline elements can't be the whole text; an article or main element around it is taken
with it); the smallest density on the path from it up to the body is the threshold, and other subtrees of at least
that density outside it, headed by the node of their largest sum, belong to the text as well, as do headings beside
the path and runs of bare text (with the inline elements in them) of the path's elements that have that density.

Elements that never hold article text (menus, forms, scripts, page headers and footers, asides, adverts,
notices and reader comments, by tag, role, or a whole class name or id) don't count and are left out; a class or id
drops no element around an article or main element nor, on pages without one and comments apart, one with most of the
page's text. Blocks are trimmed, their white space becomes one space, and they are joined in page order by one line feed.

A null or empty page, or one without text, gives an empty string; repeated rows are extracted each; extra
columns are dropped; an empty table gives an empty one. Markup that is not closed is closed by its parents.
"""

from __future__ import annotations

import html
import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import map_rows, struct

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("head script style noscript template nav footer aside form iframe object svg canvas button select "
                     "textarea input dialog menu title math audio video label".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul caption".split())
# Elements that a start tag closes when they are open: (tag, those it closes, where the search stops).
_CLOSES_P = _BLOCK - frozenset("td th tr tbody thead tfoot caption body html legend summary".split())
_SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
# Paragraphs and inline elements are parts of a text, never the whole of it.
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre a b i em strong span u s small big code font sub sup tt cite q mark time abbr "
                  "ins del figcaption caption summary".split())
_SCOPE = frozenset("table td th caption button object template html".split())
# Whole class names and ids of what isn't the text: every part between '-' and '_' is one of these words or says where and
# in what form it stands, so 'cookie-notice' and 'site-footer' are, 'has-sidebar' and 'related-work' are not.
_NOISE = re.compile(
    r"ads?|advert\w*|adbox|sponsor\w*|promo\w*|banner|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|pageheader|siteheader|masthead|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|"
    r"related|recommended|widget|pagination|pager|skip|copyright|legal|disclaimer|toolbar|tags")
_PLACE = frozenset("site page global primary secondary top bottom list area link links button buttons bar box".split())
_NOISE_NAMES = frozenset("side-bar page-header site-header".split())
_COMMENTS = re.compile(r"(?:(?:post|article|entry|page|site|user|reader)[-_]+)?(?:comments?(?:[-_]+(?:list|area|section|body|content|text|wrap|wrapper|"
                       r"thread|item|box|form|respond))?|commentlist|disqus(?:[-_]+thread)?|respond|replies)")
_PAGE_HEADER = frozenset("header top-bar topbar head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "named", "chars", "tags", "link_chars", "link_tags", "density", "density_sum")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children, self.drop, self.named = tag, parent, [], False, ""
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.density_sum = 0.0


def _is_dropped(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> bool:
    """Whether the tag, role or visibility says that the element never holds article text."""
    if tag in _DROPPED or tag == "header" and not inside_article:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in attrs:
        value = value or ""
        if name == "role" and value.lower() in _ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _is_noise_name(name: str) -> bool:
    parts = [part for part in re.split("[-_]+", name) if part]
    words = [part for part in parts if part not in _PLACE]
    return name in _NOISE_NAMES or bool(words) and all(_NOISE.fullmatch(word) for word in words)


def _named(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> str:
    """What a class or the id calls the element: reader comments, other noise, or neither ("")."""
    if tag in ("html", "body"):
        return ""
    names = [x for name, value in attrs if name in ("class", "id") for x in (value or "").lower().split()]
    if any(_COMMENTS.fullmatch(x) for x in names):
        return "comments"
    if tag in ("article", "main"):
        return ""
    return "noise" if any(_is_noise_name(x) or not inside_article and x in _PAGE_HEADER for x in names) else ""


class _Tree(HTMLParser):
    """Builds the tree; text outside dropped elements becomes a string child."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None)
        self.open = self.root

    def _pop_to(self, node: Node) -> None:
        self.open = node.parent or self.root

    def _close(self, tags, stops) -> None:
        """Close the nearest open element among ``tags``, with all inside it, unless a stop comes first."""
        n = self.open
        while n is not self.root and n.tag not in stops:
            if n.tag in tags:
                self._pop_to(n)
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag == "body":
            while self.open.tag == "head" or self.open.parent is not None and self.open.drop:
                self._pop_to(self.open)
        if tag in _CLOSES_P:
            self._close({"p"}, _SCOPE)
        if tag in _SAME:
            self._close(*_SAME[tag])
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open.tag):
            self._pop_to(self.open)
        node = Node(tag, self.open)
        inside, n = False, self.open
        while n is not None and not inside:
            inside, n = n.tag in ("article", "main"), n.parent
        node.drop = self.open.drop or _is_dropped(tag, attrs, inside)
        node.named = "" if node.drop else _named(tag, attrs, inside)
        self.open.children.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.open.tag == tag and tag in ("script", "style", "svg", "iframe"):
            self._pop_to(self.open)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        n = self.open
        while n is not self.root:
            if n.tag == tag:
                self._pop_to(n)
                return
            if tag not in _BLOCK and n.tag in _BLOCK:  # an inline end tag doesn't close blocks
                return
            n = n.parent

    def handle_data(self, data):
        if not self.open.drop and self.open.tag not in ("script", "style"):
            self.open.children.append(data)


def parse(page: str) -> Node:
    tree = _Tree()
    rest = ""
    try:
        tree.feed(page)
        if re.match(r"</?[A-Za-z]", tree.rawdata):  # a tag that the page's end cuts off
            rest, tree.rawdata = tree.rawdata, ""
        tree.close()
    except AssertionError:  # the parser gives up on a malformed declaration
        rest = tree.rawdata[1:]
    if rest:  # taken without its markup
        tree.handle_data(html.unescape(re.sub(r"<[^>]*>?", " ", rest)))
    _drop_named(tree.root)
    return tree.root


def _nodes(root: Node) -> list[Node]:
    """All nodes that count, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.drop:
            continue
        out.append(n)
        todo.extend(c for c in reversed(n.children) if not isinstance(c, str))
    return out


def _drop_named(root: Node) -> None:
    """Drops what its class or id calls noise, but for elements around an article or main element and, on pages without
    one, those with most of the page's text, unless they are reader comments."""
    nodes = _nodes(root)
    chars, holds = {}, set()
    for n in reversed(nodes):
        chars[id(n)] = sum(len(_SPACE.sub(" ", c).strip()) if isinstance(c, str) else chars.get(id(c), 0) for c in n.children)
        if n.tag in ("article", "main") and not n.named or any(id(c) in holds for c in n.children if not isinstance(c, str)):
            holds.add(id(n))
    for n in nodes:
        if n.named and id(n) not in holds and (n.named == "comments" or id(root) in holds or 2 * chars[id(n)] <= chars[id(root)]):
            n.drop = True


def _count(n: Node) -> None:
    """The counts of a node from those of its children."""
    for c in n.children:
        if isinstance(c, str):
            n.chars += len(_SPACE.sub(" ", c).strip())
        elif not c.drop:
            n.chars += c.chars
            n.tags += c.tags + 1
            n.link_chars += c.link_chars
            n.link_tags += c.link_tags + (c.tag == "a")
    if n.tag == "a":
        n.link_chars = n.chars


def _share(body: Node) -> float:
    """Share of link text on the page."""
    return body.link_chars / max(1, body.chars)


def _density(n: Node, share: float) -> float:
    c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
    if not c:
        return 0.0
    not_link = max(1, c - n.link_chars)
    base = math.log(c / not_link * n.link_chars + share * c + math.e)
    return c / t * max(0.0, math.log(max(1.0, c / lc * t / lt) + 1e-9) / math.log(base) if base > 1 + 1e-9 else math.log(c / lc * t / lt + 1e-9))


def _measure(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        _count(n)
    share = _share(nodes[0])
    for n in nodes:
        n.density = _density(n, share)
    for n in nodes:
        n.density_sum = sum(c.density for c in n.children if not isinstance(c, str) and not c.drop)


def _wrap_runs(p: Node, inline: set[int], share: float, threshold: float) -> list[Node]:
    """Puts each run of bare text in ``p``, with the inline elements in it, into a node of its own where its density reaches
    the threshold; these nodes."""
    made, children, run = [], [], []

    def close():
        node = Node("#text", p)
        node.children = run[:]
        _count(node)
        node.density = _density(node, share)
        if any(isinstance(c, str) and c.strip() for c in run) and node.density >= threshold and node.chars > node.link_chars:
            made.append(node)
            children.append(node)
        else:
            children.extend(run)
        run.clear()

    for c in p.children:
        if isinstance(c, str) or c.drop or id(c) in inline:
            run.append(c)
        else:
            close()
            children.append(c)
    close()
    p.children = children
    return made


def content_roots(root: Node) -> list[Node]:
    """The heads of the selected subtrees."""
    nodes = _nodes(root)
    _measure(nodes)
    best = max((n for n in nodes if n is root or n.tag not in _LEAF), key=lambda n: (n.density_sum, n.chars))
    if not best.density_sum:
        return [root]
    article = best
    while article is not None and article.tag not in ("article", "main"):
        article = article.parent
    best = article or best
    path, n = [], best
    while n is not None:
        path.append(n)
        n = n.parent
    threshold = min(x.density for x in path)
    on_path = set(map(id, path))
    heads = {id(best)}
    # elements without blocks inside, off the path
    inline: set[int] = set()
    for n in reversed(nodes):
        if n.tag not in _BLOCK and id(n) not in on_path and all(isinstance(c, str) or c.drop or id(c) in inline for c in n.children):
            inline.add(id(n))
    share = _share(root)
    runs = [x for p in path[1:] for x in _wrap_runs(p, inline, share, threshold)]
    heads.update(map(id, runs))
    on_path.update(heads)
    todo = [x for p in path[1:] for x in p.children if not isinstance(x, str) and not x.drop and id(x) not in on_path]
    for x in todo:
        if re.fullmatch("h[1-6]", x.tag):
            heads.add(id(x))
        elif x.density >= threshold and x.density > 0 and x.chars > x.link_chars:
            heads.add(id(max(_nodes(x), key=lambda y: (y.density_sum, y.chars))) if x.density_sum else id(x))
    return [n for n in (_nodes(root) if runs else nodes) if id(n) in heads]


def blocks(heads: list[Node]) -> list[str]:
    """Texts of the blocks of the subtrees, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    for head in heads:
        todo: list = [head]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                run.append(x)
            elif x.tag == "br":
                run.append(" ")
            elif not x.drop:
                block = x.tag in _BLOCK
                if block:
                    flush()
                    todo.append(None)
                todo.extend(reversed(x.children))
        flush()
    return out


def main_text(page: str) -> str:
    return "\n".join(blocks(content_roots(parse(page)))) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): the main text of every page."""

    def make():
        return lambda page_id, url, page: (page_id, url, main_text(page or ""))

    return map_rows(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")),
                    make, struct("page_id long, url string, text string"))
