"""One pass over each page's HTML: a repaired tree, a subset of CSS, and the facts that rules need.

Spark hands pages to :func:`page_facts` in Arrow batches; what comes out are slim rows
(texts, links, candidates), and every rule over them is a Column expression elsewhere.

Trees are repaired as browsers do: implied end tags, formatting elements that go on over
blocks (the adoption agency, with the list of those that are active), and content of tables
that is no cell's, which goes before the table.  html, head and body are not implied.  Elements
are numbered in page order, each with the number after its last descendant, so "inside" is a
comparison; texts are numbered likewise.  Script and style are no text.  CSS: ``tag``, ``*``,
``.c``, ``#i``, ``[a]``, ``[a='v']``, ``[a*='v']``, descendants and comma lists; any number of
selectors is matched in one walk, in time that grows with the page, however it is nested.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape
from html.entities import html5
from itertools import accumulate
from urllib.parse import urljoin, urlparse

from tallyfield.functions import markup

# Kinds of elements, from the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
SPECIAL = BLOCKS | frozenset(
    "applet area base body br button caption col colgroup dd dt embed head html iframe img input li link marquee meta noscript object option param script select source style tbody td template textarea tfoot th thead title tr track wbr".split()
)
SCOPE = frozenset("applet caption html marquee object table td template th #root".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE_PARTS = frozenset("table tbody thead tfoot tr".split())
#: What an item's start closes, and what keeps it from doing so.
ITEMS = {"li": (("li",), SCOPE | {"ul", "ol"}), "dt": (("dt", "dd"), SCOPE | {"dl"}), "dd": (("dt", "dd"), SCOPE | {"dl"}), "option": (("option",), SCOPE | {"select", "datalist"})}
# The places where shops keep content.
HEADINGS = frozenset(("h2", "h3", "h4", "h5", "strong", "b"))
CONTENT_SELECTORS = (
    "#tab-description", ".woocommerce-Tabs-panel--description", ".tab-content", ".product-content", ".product-description", ".rte", ".entry-content", ".product-summary",
)
IMAGE_ATTRIBUTES = ("data-large_image", "data-zoom-image", "data-src", "data-lazy-src", "data-original", "src")
MONEY = re.compile(r"\d[\d.,]{3,}\s*(?:₫|đ|VND)", re.I)
SPEC_SELECTORS = ("table tr", "td, th", "dl", "dt", "dd")
#: What the facts of every page look for.
FACT_SELECTORS = (*CONTENT_SELECTORS, *SPEC_SELECTORS, "meta[property='og:image']", "img", "iframe", "video source, video")
#: Longest value of a row that is read.
LONGEST = 600
#: Most formatting elements that go on at once: what a page opens and never closes doesn't multiply.
MOST_ACTIVE = 64


class Node:
    """An element: its place in page order (at), the place after its last descendant (end), and those of its texts (t0, t1)."""

    __slots__ = ("tag", "attrs", "parent", "children", "page", "at", "end", "t0", "t1", "open")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parent, self.children, self.open = tag, attrs, None, [], False

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def own_text(self) -> str:
        return " ".join(" ".join(c for c in self.children if isinstance(c, str)).split())

    def inside(self) -> list[Node]:
        """This element's descendants in page order."""
        return self.page.nodes[self.at + 1 : self.end]

    def pieces(self) -> list[str]:
        return [c for c in self.children if isinstance(c, str)] if self.tag in ("script", "style") else self.page.texts[self.t0 : self.t1]


class Page:
    """Elements and texts of a tree in page order."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.texts: list[str] = []
        todo: list = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                self.texts.append(x)
            elif isinstance(x, tuple):
                x[0].end, x[0].t1 = len(self.nodes), len(self.texts)
            else:
                x.page, x.at, x.t0 = self, len(self.nodes), len(self.texts)
                self.nodes.append(x)
                todo.append((x,))
                hide = x.tag in ("script", "style")
                todo += [c for c in reversed(x.children) if not (hide and isinstance(c, str))]
        self.sizes = [0, *accumulate(len(x.strip()) for x in self.texts)]
        self.solid = [0, *accumulate(sum(map(len, x.split())) for x in self.texts)]
        self.found: dict[str, list[Node]] = {}  # by selectors that were looked for over the whole page

    def places(self, css: str) -> list[int]:
        """Where the elements of a selector are, over the whole page."""
        return [n.at for n in select(self.nodes[0], css)]


def text_of(node: Node | None) -> str:
    return " ".join(" ".join(node.pieces()).split()) if node is not None else ""


def _place_of(children: list, x) -> int:
    k = len(children) - 1
    while children[k] is not x:
        k -= 1
    return k


class _Tree:
    """The tree under construction: open elements, where each tag's are among them, and active formatting elements."""

    def __init__(self):
        self.stack: list[Node] = []
        self.where: dict[str, list[int]] = {}
        self.special: list[int] = []
        self.active: list[Node | None] = []  # None: a cell or caption begins
        self.push(Node("#root", {}))

    # open elements

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in SPECIAL:
            self.special.append(len(self.stack))
        self.stack.append(node)
        node.open = True

    def pop_to(self, k: int) -> None:
        """Close the k-th open element and all in it."""
        while len(self.stack) > k:
            node = self.stack.pop()
            node.open = False
            self.where[node.tag].pop()
            if node.tag in SPECIAL:
                self.special.pop()
            if node.tag in ("td", "th", "caption"):
                while self.active and self.active.pop() is not None:
                    pass

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these tags; -1 if there is none."""
        return max((w[-1] for t in tags if (w := self.where.get(t))), default=-1)

    def within(self, bounds: Iterable[str], *tags: str) -> int:
        """Its place if none of bounds is open inside it, else -1."""
        k = self.last(*tags)
        return k if k >= 0 and k >= self.last(*bounds) else -1

    def close(self, bounds: Iterable[str], *tags: str) -> bool:
        if (k := self.within(bounds, *tags)) < 0:
            return False
        self.pop_to(k)
        return True

    # insertion

    def put(self, x: Node | str, foster: bool = True) -> None:
        """Into the innermost open element; before the table if that is a part of one and foster is set."""
        parent, k = self.stack[-1], None
        if foster and parent.tag in TABLE_PARTS:
            at = self.last("table")
            table, parent = self.stack[at], self.stack[at - 1]
            if table.parent is not None:
                parent, k = table.parent, _place_of(table.parent.children, table)
            if isinstance(x, str) and k and isinstance(parent.children[k - 1], str):
                parent.children[k - 1] += x
                return
        parent.children.insert(len(parent.children) if k is None else k, x)
        if isinstance(x, Node):
            x.parent = parent

    @staticmethod
    def take(node: Node) -> None:
        del node.parent.children[_place_of(node.parent.children, node)]

    # formatting

    def resume(self) -> None:
        """Open again the active elements that a block's end has closed."""
        k = len(self.active)
        while k and self.active[k - 1] is not None and not self.active[k - 1].open:
            k -= 1
        for k in range(k, len(self.active)):
            node = Node(self.active[k].tag, self.active[k].attrs)
            self.put(node)
            self.push(node)
            self.active[k] = node

    def activate(self, node: Node) -> None:
        alike, k = [], len(self.active) - 1
        while k >= 0 and (x := self.active[k]) is not None:
            if x.tag == node.tag and x.attrs == node.attrs:
                alike.append(k)
            k -= 1
        if len(alike) >= 3:
            del self.active[alike[-1]]
        elif len(self.active) - 1 - k >= MOST_ACTIVE:
            del self.active[k + 1]
        self.active.append(node)

    def adopt(self, tag: str) -> None:
        """The end of a formatting element: blocks that began in it take it along."""
        top = self.stack[-1]
        if top.tag == tag and not any(x is top for x in self.active):
            self.pop_to(len(self.stack) - 1)
            return
        for _ in range(8):
            at = len(self.active) - 1
            while at >= 0 and self.active[at] is not None and self.active[at].tag != tag:
                at -= 1
            if at < 0 or self.active[at] is None:
                self.end(tag)
                return
            old = self.active[at]
            if not old.open:
                del self.active[at]
                return
            k = next(k for k in reversed(self.where[tag]) if self.stack[k] is old)
            if self.last(*SCOPE) > k:
                return
            nth = bisect_right(self.special, k)
            if nth == len(self.special):
                self.pop_to(k)
                del self.active[at]
                return
            b = self.special[nth]
            block, between, rest = self.stack[b], self.stack[k + 1 : b], self.stack[b + 1 :]
            moved, kept, mark = block, [], at
            for n, node in enumerate(reversed(between), 1):
                i = next((i for i, x in enumerate(self.active) if x is node), -1)
                if i >= 0 and n > 3:
                    del self.active[i]
                    mark -= i < mark
                    i = -1
                if i < 0:
                    continue
                again = Node(node.tag, node.attrs)
                self.active[i] = again
                if moved is block:
                    mark = i + 1
                if moved is block:
                    self.take(moved)
                again.children.append(moved)
                moved.parent = again
                kept.append(again)
                moved = again
            active, self.active = self.active, []
            self.pop_to(k)
            self.active = active
            if moved is block:
                self.take(moved)
            self.put(moved)
            inner = Node(old.tag, old.attrs)
            inner.children, block.children, inner.parent = block.children, [inner], block
            for child in inner.children:
                if isinstance(child, Node):
                    child.parent = inner
            i = _place_of(self.active, old)
            del self.active[i]
            self.active.insert(mark - (i < mark), inner)
            for node in (*reversed(kept), block, inner, *rest):
                self.push(node)

    # tokens

    def text(self, text: str) -> None:
        blank = not text.strip(" \t\n\r\f")
        if not blank:
            self.resume()
        self.put(text, not blank)

    def raw(self, text: str) -> None:
        self.stack[-1].children.append(text)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        if tag in ("html", "head", "body"):
            if self.last(tag) >= 0 or tag == "head" and self.last("body") >= 0:
                return
            if tag == "body" and (k := self.last("head")) >= 0:
                self.pop_to(k)
            self.put(node)
            self.push(node)
            return
        table = self.last("table", "template")
        if tag in ("caption", "colgroup", "col", "tbody", "thead", "tfoot", "tr", "td", "th"):
            if table < 0 or self.stack[table].tag != "table":
                return
            self.table_context(tag, table)
            self.put(node, False)
            if tag != "col":
                self.push(node)
            if tag in ("td", "th", "caption"):
                self.active.append(None)
            return
        if tag in BLOCKS:
            self.close(SCOPE | {"button"}, "p")
            if tag in TITLES and self.stack[-1].tag in TITLES:
                self.pop_to(len(self.stack) - 1)
            if tag == "table" and self.stack[-1].tag in TABLE_PARTS:
                self.pop_to(self.last("table"))  # a table right in a table ends it
        elif tag in ITEMS:
            tags, bounds = ITEMS[tag]
            self.close(bounds, *tags)
            if tag != "option":
                self.close(SCOPE | {"button"}, "p")
        elif tag in ("script", "style", "link", "meta", "base", "title", "template"):
            self.put(node, False)
            if tag not in markup.VOID:
                self.push(node)
            return
        else:
            if tag in ("a", "nobr", "button"):
                if tag == "button":
                    self.close(SCOPE, tag)
                else:
                    marked = len(self.active) - next((k for k, x in enumerate(reversed(self.active)) if x is None), len(self.active))
                    if (old := next((x for x in reversed(self.active[marked:]) if x.tag == tag), None)) is not None:
                        self.adopt(tag)
                        self.active = [x for x in self.active if x is not old]
            self.resume()
        self.put(node)
        if tag not in markup.VOID:
            self.push(node)
            if tag in FORMATTING:
                self.activate(node)

    def table_context(self, tag: str, table: int) -> None:
        """Close what stands between the table and where its part belongs; open the parts that are missing."""

        def reach(outer: int, implied: str, *tags: str) -> int:
            k = self.last(*tags)
            self.pop_to((k if k > outer else outer) + 1)
            if k > outer:
                return k
            self.put(part := Node(implied, {}), False)
            self.push(part)
            return len(self.stack) - 1

        if tag == "col":
            reach(table, "colgroup", "colgroup")
        elif tag in ("tr", "td", "th"):
            section = self.last("tbody", "thead", "tfoot")
            section = section if section > table else reach(table, "tbody", "tbody")
            if tag == "tr":
                self.pop_to(section + 1)
            else:
                reach(section, "tr", "tr")
        else:
            self.pop_to(table + 1)

    def end(self, tag: str) -> None:
        """Any end tag but that of an active formatting element."""
        if tag in ("html", "body"):
            return
        if tag == "p":
            if not self.close(SCOPE | {"button"}, "p"):
                self.put(Node("p", {}))
        elif tag in TITLES:
            self.close(SCOPE, *TITLES)
        elif tag in ITEMS:
            self.close(SCOPE | ({"ul", "ol"} if tag == "li" else set()), tag)
        elif tag in ("table", "caption", "colgroup", "tbody", "thead", "tfoot", "tr", "td", "th"):
            self.close(("template", "#root") if tag == "table" else ("table", "template", "#root"), tag)
        elif tag in BLOCKS or tag in ("button", "object", "applet", "marquee", "select", "head", "template"):
            self.close(SCOPE, tag)
        else:
            k = self.last(tag)
            if k > 0 and k >= (self.special[-1] if self.special else 0):
                self.pop_to(k)


_ENDED = re.compile(r"&(?:#\d+|#[xX][\da-fA-F]+|[a-zA-Z][a-zA-Z\d]*);")


def unescape_ended(text: str) -> str:
    """Text with the character references read that end in ";"; others, as of a text cut short, stay as they stand."""
    return _ENDED.sub(lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


def parse(html: str | None, ended: bool = False) -> Node:
    """The tree of a page.  Character references are read as browsers do, or with `ended` those that end in ";" only."""
    tree = _Tree()
    read = unescape_ended if ended else unescape
    for kind, name, rest in markup.tokens(html or ""):
        if kind == markup.TEXT:
            tree.text(read(name))
        elif kind == markup.RAW_TEXT:
            tree.raw(name if rest in ("script", "style") else read(name))
        elif kind == markup.END:
            if name in FORMATTING:
                tree.adopt(name)
            else:
                tree.end(name)
        else:
            tree.start(name, {k: read(v) for k, v in markup.attributes(rest).items()})
    root = tree.stack[0]
    Page(root)
    return root


_PART = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[([\w-]+)(?:(\*?=)['"]?([^'"\]]*)['"]?)?\]""")


@lru_cache(maxsize=512)
def _compiled(css: str) -> tuple:
    """Alternatives, each a tuple of simple selectors, each a tuple of tests."""
    out = []
    for one in re.split(r",(?![^\[]*\])", css):
        steps = []
        for simple in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", one.strip()):
            tests, at = [], 0
            while at < len(simple):
                m = _PART.match(simple, at)
                if not m:
                    raise ValueError(f"selector not supported: {css}")
                tests.append(m.groups())
                at = m.end()
            steps.append(tuple(tests))
        if steps:
            out.append(tuple(steps))
    return tuple(out)


def _fits(node: Node, tests: tuple) -> bool:
    for tag, cls, ident, attr, op, value in tests:
        if tag is not None:
            if tag != "*" and node.tag != tag.lower():
                return False
        elif cls is not None:
            if cls not in node.classes():
                return False
        elif ident is not None:
            if node.attrs.get("id") != ident:
                return False
        else:
            have = node.attrs.get(attr.lower())
            if have is None or op == "=" and have != value or op == "*=" and (not value or value not in have):
                return False
    return True


@lru_cache(maxsize=256)
def _matcher(selectors: tuple[str, ...]) -> dict[str, list[tuple]]:
    """Steps of all selectors by what an element must have: its id, a class, its tag or nothing."""
    keyed: dict[str, list[tuple]] = {}
    for css in selectors:
        for nth, steps in enumerate(_compiled(css)):
            for k, tests in enumerate(steps):
                names = [(2, f"#{t[2]}") if t[2] else (1, f".{t[1]}") if t[1] else (0, t[0].lower()) for t in tests if t[2] or t[1] or t[0] not in (None, "*")]
                keyed.setdefault(max(names, default=(0, ""))[1], []).append((css, nth, k, k + 1 == len(steps), tests))
    return keyed


def hits(top: Node, selectors: Iterable[str]) -> dict[str, list[Node]]:
    """The elements of each selector inside top, in page order, by one walk over its descendants.

    An element is inside a match of the step before if that one's end lies behind it: of the matches so far only
    the farthest end counts, as elements that began earlier either enclose it or have ended."""
    selectors = tuple(dict.fromkeys(selectors))
    keyed = _matcher(selectors)
    reach: dict[tuple, int] = {}
    found: dict[str, list[Node]] = {css: [] for css in selectors}
    for node in top.page.nodes[top.at : top.end]:
        names = ["", node.tag, *(f".{c}" for c in dict.fromkeys(node.classes()))]
        if node.attrs.get("id"):
            names.append(f"#{node.attrs['id']}")
        new = []
        for name in names:
            for css, nth, k, is_last, tests in keyed.get(name, ()):
                if (k == 0 or reach.get((css, nth, k - 1), 0) > node.at) and _fits(node, tests):
                    new.append((css, nth, k))
                    if is_last and node is not top and not (found[css] and found[css][-1] is node):
                        found[css].append(node)
        for key in new:
            reach[key] = max(node.end, reach.get(key, 0))
    return found


def prepare(root: Node, selectors: Iterable[str | None]) -> None:
    """Look for all these selectors at once; `select` over the page then finds what this found."""
    if new := [css for css in selectors if css and css not in root.page.found]:
        root.page.found |= hits(root, new)


def select(top: Node, css: str) -> list[Node]:
    if top.at:
        return hits(top, (css,))[css]
    prepare(top, (css,))
    return top.page.found[css]


def first(root: Node, css: str | None) -> Node | None:
    if not css:
        return None
    return next(iter(select(root, css)), None)


def links(root: Node, base: str, css: str) -> list[str]:
    return list(addresses(select(root, css), base))


def addresses(nodes: Iterable[Node], base: str) -> dict[str, int]:
    """Distinct web addresses of the elements, in page order, with the place of the first of each among the elements that have a href."""
    seen: dict[str, int] = {}
    for at, href in enumerate(x for node in nodes if (x := node.attrs.get("href")) is not None):
        if not href or href.startswith(("#", "javascript:", "mailto:", "tel:")):
            continue
        try:
            url = urljoin(base, href.strip())
            parts = urlparse(url)
        except ValueError:
            continue
        if parts.scheme in ("http", "https") and parts.netloc:
            seen.setdefault(url, at)
    return seen


def content_block(root: Node, css: str | None) -> Node | None:
    """The declared block, else the candidate with the longest text (the first of equals)."""
    if css:
        return first(root, css)
    prepare(root, CONTENT_SELECTORS)
    some = [found[0] for c in CONTENT_SELECTORS if (found := select(root, c))]
    sizes = [root.page.sizes[n.t1] - root.page.sizes[n.t0] for n in some]
    return some[sizes.index(max(sizes))] if some and max(sizes) > 0 else None


def image_candidates(root: Node, base: str, gallery: str | None) -> list[str]:
    """og:image, then images of the gallery (of the page if none is declared), absolute."""
    og = first(root, "meta[property='og:image']")
    out = [og.attrs.get("content", "")] if og is not None else []
    places = root.page.places("img")
    if gallery:
        at = dict.fromkeys(k for n in select(root, gallery) for k in _between(places, n))
    else:
        at = places
    nodes = [root.page.nodes[k] for k in at]
    out += [next((v for a in IMAGE_ATTRIBUTES if (v := n.attrs.get(a))), "") for n in nodes]
    return [url for x in out if x and not x.startswith("data:") and (url := absolute(base, x))]


def _between(places: list[int], node: Node, most: int | None = None) -> list[int]:
    """Those of places (ascending) that are inside the element, the first `most` of them."""
    a = bisect_right(places, node.at)
    b = bisect_left(places, node.end, a)
    return places[a : b if most is None else min(b, a + most)]


def absolute(base: str, address: str) -> str | None:
    """The address as seen from base; None if it can't be read."""
    try:
        return urljoin(base, address.strip())
    except ValueError:
        return None


def video_frames(root: Node) -> list[str]:
    frames = [f.attrs.get("src") or f.attrs.get("data-src") or "" for f in select(root, "iframe")]
    out = [x for x in frames if "vimeo" in x or "facebook.com/plugins/video" in x]
    return out + [x for n in select(root, "video source, video") if (x := n.attrs.get("src") or "") and not x.startswith("data:")]


def spec_rows(root: Node) -> list[tuple[str, str]]:
    """(label, value) of two-cell table rows in page order, then of definition lists, paired by place.

    A row of a nested table counts once; values longer than LONGEST and empty texts are left out."""
    page, out = root.page, []
    prepare(root, SPEC_SELECTORS)
    at = {css: page.places(css) for css in SPEC_SELECTORS}

    def add(a: Node, b: Node) -> None:
        if page.solid[a.t1] > page.solid[a.t0] and 0 < page.solid[b.t1] - page.solid[b.t0] <= LONGEST:
            out.append((text_of(a), text_of(b)))

    for row in select(root, "table tr"):
        if len(cells := _between(at["td, th"], row, 3)) == 2:
            add(*(page.nodes[k] for k in cells))
    seen = set()
    for dl in select(root, "dl"):
        for pair in zip(_between(at["dt"], dl), _between(at["dd"], dl), strict=False):
            if pair not in seen:
                seen.add(pair)
                add(*(page.nodes[k] for k in pair))
    return out


def section_parts(block: Node | None) -> list[tuple[str, str]]:
    """(heading, text up to the next heading) in order.  A heading goes to the first end of an element of its tag; headings within it are text."""
    parts: list[list] = []
    heading = None
    todo: list = [block] if block is not None else []
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if parts:
                parts[-1][1 if heading is None else 0].append(x)
        elif isinstance(x, tuple):
            heading = None if heading == x[0] else heading
        elif x.tag not in ("script", "style"):
            if x.tag in HEADINGS and heading is None:
                heading = x.tag
                parts.append([[], []])
            todo.append((x.tag,))
            todo += reversed(x.children)
    return [tuple(" ".join(" ".join(x).split()) for x in p) for p in parts]


def _money(root: Node) -> Iterator[Node]:
    return (n for n in root.inside() if n.tag not in ("script", "style") and MONEY.search(n.own_text()))


def card_selectors(root: Node, climb: int = 6) -> list[tuple[str, str, str]]:
    """For each text that looks like money: (container, link class, selector) of the card around it."""
    out, places = [], root.page.places("a[href]")
    for node in _money(root):
        up = node
        for _ in range(climb):
            up = up.parent
            if up is None:
                break
            names = up.classes()
            inside = _between(places, up, 1) if names else []
            link = root.page.nodes[inside[0]] if inside else None
            href = link.attrs.get("href", "") if link is not None else ""
            if not href or href.startswith(("#", "javascript:")):
                continue
            own = link.classes()
            out.append(("." + ".".join(names[:2]), "a" + "".join(f".{c}" for c in own[:2]), f"a.{own[0]}" if own else f".{names[0]} a"))
            break
    return out


def money_paths(root: Node) -> list[str]:
    """Where money-like texts stand: the element and two ancestors, as tag#id.classes."""

    def named(n: Node) -> str:
        return n.tag + (f"#{n.attrs['id']}" if n.attrs.get("id") else "") + "".join(f".{c}" for c in n.classes()[:3])

    seen: dict[str, None] = {}
    for node in _money(root):
        path, up = [], node
        while up is not None and up.tag not in ("html", "#root") and len(path) < 3:
            path.append(named(up))
            up = up.parent
        seen[" < ".join(path)] = None
    return list(seen)


def image_holders(root: Node) -> list[str]:
    """For each image, the classes of the nearest of three ancestors that has any."""
    out = []
    for k in root.page.places("img"):
        up = root.page.nodes[k].parent
        for _ in range(3):
            if up is None:
                break
            if up.classes():
                out.append("." + ".".join(up.classes()[:2]))
                break
            up = up.parent
    return out
