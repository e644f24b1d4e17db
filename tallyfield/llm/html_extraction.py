"""HTML extraction by tag-path ratios (after Wu et al. 2013, "Web news extraction via tag path feature fusion").

A block is the text between two tags that part blocks; its path, the tags from the root to
it.  For each path of a page, text length and punctuation per block are aggregated (links
count for neither), smoothed over the page's order and fused into one score, which counts by
how much text the path has in all: menus, adverts and footers are paths of a few short blocks,
articles of many.  The paths that reach a share of the page's mean score select the content
blocks; on pages without any names, article or main elements this alone tells content.

Class words lower a score and delete nothing: an element named after a menu, header, footer,
sidebar, notice, advert, form or reader comment parts its path from others and costs all in
it a factor of COST (comments, adverts and cookie notices its square).  As the threshold is
relative, a page whose whole text stands in such an element keeps it.  An element that holds
half the page's text and its title or main article is a wrapper and costs nothing.  What
stands in an article or main element counts twice.  Tags that can't be an article's text
(nav, footer, aside, script, form controls; header outside articles) are left out by name.

Beside the selected blocks go out, in page order, if no more words of noise than the core's
are on their path (the core is the box around the deepest element that holds most of the
selected text):

- blocks of the core that have text outside links
- blocks between two selected ones (outside the core, if they have text outside links)
- headings right before the first selected block, and from the page's title, or a heading that
  is no site header, on to it

Defined cases: null or empty html, or a page without text, gives an empty text; unclosed and
stray tags are repaired as far as implied end tags go, a head ends at the first thing that
can't be in it; tags with broken quotes end at their first ">"; paths with equal scores go out
together; long and deeply nested pages take time and memory in proportion to their length;
white space is what Unicode calls so, no-break spaces included; ids and urls are passed
through, null or repeated; extra columns are ignored, whatever their names; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from html import unescape
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions import markup

from . import _shared as S

#: A path's score must reach this share of the page's mean score (weighted by the scores themselves), and FLOOR.
THRESHOLD = 0.4
FLOOR = 0.05
#: What a name that speaks of noise costs all in its element.
COST = 50.0
#: Share of the selected text that the core holds, and of the page's text that a wrapper holds, at least.
HELD = 0.8
WRAPS = 0.5
#: Weights for smoothing over neighbouring blocks.
SMOOTH = (0.25, 0.5, 0.25)
#: Power of a path's text, as a share of the longest path's, in its score.
SUPPORT = 0.5
#: What standing in an article is worth.
IN_ARTICLE = 2.0

# Tags by kind, and words of class and id.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
NOISE = frozenset("nav footer aside script style noscript template iframe svg button select textarea dialog menu head title object canvas audio video".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset(("script", "style", "template"))
CONTENT = frozenset(("article", "main"))
BOXES = frozenset(("article", "main", "div", "section", "td", "body", "html", "#root"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Words that cost COST twice, and once.
STRONG_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments disqus reply replies respond".split())
WEAK_WORDS = frozenset(
    "promo promotion banner notice notices newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "share sharing social related popup modal overlay widget widgets toolbar pagination pager login signup paywall alert".split()
)
COMMENTS = frozenset(("comment", "comments", "reply", "replies"))
OWN_WORDS = frozenset("article body content entry page post story text title".split())
#: A start tag ends the element of a group that is open, unless one of the bounds was opened in it.
CLOSES = {"li": ("li",), "dt": ("d",), "dd": ("d",), "tr": ("cell", "tr"), "td": ("cell",), "th": ("cell",), "option": ("option",)}
GROUPS = {
    "p": (frozenset(("p",)), frozenset(("button", "td", "th", "caption", "li", "article", "main"))),
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "d": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "cell": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}

_NAMED = re.compile(r"class|id|role|hidden", re.I)
_WORDS = re.compile(r"[^a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，]")


class _Page:
    """Elements in page order, a parent before its children, and the blocks of text outside NOISE."""

    def __init__(self):
        self.tag, self.parent = ["#root"], [0]
        self.noise, self.words = [False], [0]  # left out; how often its names cost COST
        self.holder, self.link, self.within = [0], [False], [False]  # innermost element that is no inline one; in a link; in an article
        self.blocks: list[tuple[int, list[str]]] = []
        self.free: list[list[str]] = []  # of each block, what is outside links

    def add(self, tag: str, parent: int, attributes: str) -> int:
        noise, words = _named(tag, attributes, self.within[parent])
        e = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.noise.append(self.noise[parent] or noise)
        self.words.append(words)
        self.holder.append(self.holder[parent] if tag in INLINE else e)
        self.link.append(self.link[parent] or tag == "a")
        self.within.append(self.within[parent] or tag in CONTENT)
        return e


def _named(tag: str, text: str, inside: bool) -> tuple[bool, int]:
    """(whether an element is noise by tag or role, how often its names cost COST)."""
    if tag in NOISE or tag == "header" and not inside:
        return True, 0
    words = 1 if tag in ("form", "label") else 0
    if tag in ("html", "body", "main") or not text or not _NAMED.search(text):
        return False, words
    names = markup.attributes(text)
    role = names.get("role", "").lower()
    if "hidden" in names or names.get("aria-hidden", "").lower() == "true" or role in ROLES:
        return True, 0
    if role == "form":
        words = 1
    own = False
    for name in f"{names.get('class', '')} {names.get('id', '')}".lower().split():
        parts = set(_WORDS.split(name))
        if inside or parts & OWN_WORDS:
            parts.discard("header")  # an article's own heading
        strong, weak = parts & STRONG_WORDS, parts & WEAK_WORDS
        if tag == "article":
            strong, weak = strong & COMMENTS, set()
        if strong or weak:
            words = max(words, 2 if strong else 1)
        else:
            own = own or bool(parts & OWN_WORDS)
    # "content related": one name speaks for the element, another against it
    return False, 0 if own and words == 1 and tag != "form" else words


def read(html: str) -> _Page:
    page = _Page()
    stack, open_tags = [0], {"#root": 1}
    nearest = [{}]  # of each open element: the innermost open element of each group in GROUPS
    fresh = True  # the next text starts a block

    def up_to(e: int) -> None:
        """Close the element e and all in it."""
        while stack[-1] != e:
            open_tags[page.tag[stack.pop()]] -= 1
            nearest.pop()
        open_tags[page.tag[stack.pop()]] -= 1
        nearest.pop()

    for kind, name, rest in markup.tokens(html, RAW):
        here = stack[-1]
        if kind == markup.TEXT:
            if page.tag[here] == "head" and not name.isspace():
                up_to(here)
                here = stack[-1]
            if page.noise[here]:
                continue
            text = unescape(name)
            if fresh:
                page.blocks.append((page.holder[here], []))
                page.free.append([])
                fresh = False
            page.blocks[-1][1].append(text)
            if not page.link[here]:
                page.free[-1].append(text)
            continue
        if kind == markup.RAW_TEXT:
            continue
        if name not in INLINE and name not in UNSEEN:
            fresh = True
        if kind == markup.END:
            if open_tags.get(name):
                while page.tag[stack[-1]] != name:
                    up_to(stack[-1])
                up_to(stack[-1])
            continue
        if page.tag[here] == "head" and name not in IN_HEAD:
            up_to(here)
        if name == "head" and page.tag[stack[-1]] not in ("#root", "html"):
            continue  # only a page has a head
        for group in (("p",) if name in PARAGRAPH_ENDS else ()) + CLOSES.get(name, ()):
            found = nearest[-1].get(group)
            if found:
                up_to(found)
        if name in markup.VOID or rest.endswith("/") and name in ("svg", "path"):
            continue
        e = page.add(name, stack[-1], rest)
        stack.append(e)
        open_tags[name] = open_tags.get(name, 0) + 1
        now = nearest[-1]
        for group, (tags, bounds) in GROUPS.items():
            if name in tags:
                now = {**now, group: e}
            elif name in bounds and now.get(group):
                now = {**now, group: 0}
        nearest.append(now)
    return page


def _sums(page: _Page, values: list[int]) -> list[int]:
    """What each element holds of the blocks' values."""
    out = [0] * len(page.tag)
    for (e, _), v in zip(page.blocks, values, strict=True):
        out[e] += v
    for e in range(len(out) - 1, 0, -1):
        out[page.parent[e]] += out[e]
    return out


def _levels(page: _Page) -> list[int]:
    """Of each element, how often names on its path cost COST."""
    out = [0] * len(page.tag)
    for e in range(1, len(out)):
        out[e] = out[page.parent[e]] + page.words[e]
    return out


def _unwrap(page: _Page, sizes: list[int]) -> int:
    """Clear the words of wrappers; returns the page's title (0: none)."""
    held, levels = _sums(page, sizes), _levels(page)
    titles = [e for e in range(1, len(held)) if page.tag[e] == "h1" and held[e]]
    articles = [e for e in range(1, len(held)) if page.tag[e] in CONTENT and not page.within[page.parent[e]] and held[e]]
    title = min(titles, key=levels.__getitem__, default=0)
    best = max(articles, key=lambda e: log(held[e], COST) - levels[e], default=0)
    up = title if title and (page.within[title] or not best) else best
    while up:
        if page.words[up] and held[up] >= WRAPS * held[0]:
            page.words[up] = 0
        up = page.parent[up]
    return title


def _paths(page: _Page) -> list[int]:
    """A number for the path of each element: tags, and how much an element's names cost, from the root."""
    known: dict[tuple, int] = {}
    out = [0] * len(page.tag)
    for e in range(1, len(out)):
        out[e] = known.setdefault((out[page.parent[e]], page.tag[e], page.words[e]), len(known) + 1)
    return out


def path_scores(paths: list[int], lengths: list[int], marks: list[int], weights: list[float], named: list[bool]) -> np.ndarray:
    """The fused score of each block's path; weights are equal for blocks of one path, and named tells those in an article or main.

    The others count by the text of their path, as a share of the page's longest path."""
    _, which, n = np.unique(np.array(paths), return_inverse=True, return_counts=True)
    ratios = []
    for value in (lengths, marks):
        ratio = (np.bincount(which, np.array(value, float)) / n)[which]
        padded = np.pad(ratio, 1, mode="edge")
        ratios.append(sum(w * padded[k : k + len(ratio)] for k, w in enumerate(SMOOTH)))
    fused = np.sqrt(ratios[0] * (1 + ratios[1]))
    held = np.bincount(which, np.array(lengths, float))
    support = np.where(np.array(named), 1.0, ((held / max(1.0, held.max())) ** SUPPORT)[which])
    return (np.bincount(which, fused) / n)[which] * support * np.array(weights)


def main_text(html: str | None) -> str:
    page = read(html or "")
    texts = [" ".join("".join(parts).split()) for _, parts in page.blocks]
    page.blocks, page.free, texts = ([x for x, t in zip(some, texts, strict=True) if t] for some in (page.blocks, page.free, texts))
    if not texts:
        return ""
    free = ["".join(x).strip() for x in page.free]
    title = _unwrap(page, [len(x) for x in texts])
    levels, paths, of = _levels(page), _paths(page), [e for e, _ in page.blocks]
    weights = [COST ** -levels[e] * (IN_ARTICLE if page.within[e] else 1.0) for e in of]
    scores = path_scores([paths[e] for e in of], [len(x) for x in free], [len(_PUNCTUATION.findall(x)) for x in free], weights, [page.within[e] for e in of])
    prose = np.array([page.tag[e] not in HEADINGS for e in of])
    if prose.any():  # headings follow the text they head
        scores = np.where(prose, scores, 0.0)
    mean = (scores**2).sum() / scores.sum() if scores.any() else 0.0
    chosen = np.flatnonzero((scores >= THRESHOLD * mean) & (scores >= FLOOR)).tolist()
    if not chosen:
        return ""
    marked = [0] * len(texts)
    for k in chosen:
        marked[k] = len(texts[k])
    held = _sums(page, marked)
    core = max(e for e in range(len(held)) if held[e] >= HELD * held[0])
    while page.tag[core] not in BOXES:
        core = page.parent[core]
    inside = [False] * len(page.tag)
    for e in range(core, len(inside)):
        inside[e] = e == core or inside[page.parent[e]]
    base = min(levels[core], *(levels[of[k]] for k in chosen))
    first, last = chosen[0], chosen[-1]
    lead = first
    while lead and page.tag[of[lead - 1]] in HEADINGS and levels[of[lead - 1]] <= base:
        lead -= 1
    if title:
        lead = min([lead, *(k for k in range(first) if of[k] == title and levels[title] <= base)])
    out = []
    for k, text in enumerate(texts):
        e = of[k]
        fits = levels[e] <= base
        if marked[k] or fits and (inside[e] and (free[k] or first < k < last) or lead <= k < last and (free[k] or k < first and page.tag[e] in HEADINGS)):
            out.append(text)
    return " ".join(out)


def _extract(batches, schema):
    for batch in batches:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], schema=schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return S.map_arrow(rows, _extract, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
