"""Tokens of HTML, in time and memory that grow with the page.

Broken markup stays markup: a tag whose quotes don't pair ends at its first ``>``, and a
``<`` that starts no tag is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

TEXT, START, END, RAW_TEXT = range(4)
#: Elements without an end tag, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())

# no "<" outside quotes, and what follows a closing quote parts attributes
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*)((?:[^<>"']++|"[^"]*+"(?=[\s/>])|'[^']*+'(?=[\s/>]))*+)>""")
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)


def tokens(html: str, raw: frozenset = RAW) -> Iterator[tuple[int, str, str]]:
    """(TEXT, text, ""), (START, tag, attributes), (END, tag, "") in page order, with (RAW_TEXT, text, tag)
    between the tags of an element in `raw`.  Texts still hold character references."""
    at, size, closed = 0, len(html), True  # closed: a ">" may still follow
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            yield TEXT, html[at:], ""
            return
        if mark > at:
            yield TEXT, html[at:mark], ""
        m = _TAG.match(html, mark) or _BROKEN_TAG.match(html, mark)
        if m is not None:
            at, tag = m.end(), m[2].lower()
            yield (END if m[1] else START), tag, m[3]
            if tag in raw and not m[1]:
                end = _end_of(tag).search(html, at)
                stop = end.start() if end else size
                if stop > at:
                    yield RAW_TEXT, html[at:stop], tag
                yield END, tag, ""
                close = html.find(">", stop) if end else -1
                at = close + 1 if close >= 0 else size
            continue
        at = mark + 1
        if html.startswith("!--", at):
            end = html.find("-->", at + 1)
            at = end + 3 if end >= 0 else size
            continue
        if closed and html[at : at + 1] in ("!", "?", "/"):
            end = html.find(">", at)
            closed = end >= 0
            if closed:
                at = end + 1
                continue
        yield TEXT, "<", ""


def attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name, the first of a name, with character references as they stand."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), next((v for v in values if v), ""))
    return out
