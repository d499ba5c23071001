"""A tolerant reader of HTML: blocks of text with the path of their elements."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

# Element and name lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
OUTSIDE = frozenset("head nav footer aside form button select option template dialog menu svg object audio video canvas noscript".split())
NAMES = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer header legal login menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar topbar widget".split())
#: Words before a name that make it a state of the page, and words after it that name its place or part.
STATES = frozenset("has have no not with without hide show is".split())
PLACES = frozenset("area bar block bottom box container inner item items left link links list outer right section slot top unit wrap wrapper".split())
#: Share of a page's text that no element outside by its name holds.
MOST = 0.9
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Elements that a new block ends.
_CLOSED_BY_BLOCK = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Levels of elements that a path names; what lies deeper has the path of the last of them.
LEVELS = 200

_NOTE = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>", re.S)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
_SPECIAL = re.compile(r"""["'>]""")
_NAME_END = re.compile(r"[\s/>]")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: str
    text: str
    outside: bool
    cause: int = 0


class Element(NamedTuple):
    tag: str
    path: str
    outside: bool
    cause: int = 0


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(text)}


def _named_outside(value: str) -> bool:
    """Whether a class or id is a name of NAMES or ends with one, as ``page-sidebar`` and ``ad-slot-2`` but not ``has-sidebar``."""
    parts = _NAME.findall(value)
    while len(parts) > 1 and parts[-1] in PLACES:
        parts.pop()
    return bool(parts) and parts[-1] in NAMES and STATES.isdisjoint(parts[:-1])


def _element(parent: Element, tag: str, attributes: str, number: int, spared: frozenset[int]) -> Element:
    """An element; ``cause`` is the outermost one around it that only its name or being a form puts outside."""
    given = _attributes(attributes) if attributes.strip() else {}
    values = f"{given.get('class', '')} {given.get('id', '')}".lower()
    names = _NAME.findall(values)
    role = given.get("role", "").lower()
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
    # A header of an article holds its title; that of a page does not.
    header = tag == "header" and not re.search(r"/(?:article|main)\b", parent.path)
    outside, cause = parent.outside or tag in OUTSIDE and tag != "form" or header or hidden or role in ROLES, parent.cause
    if not outside and tag not in ("html", "body", "article", "main") and number not in spared and (tag == "form" or any(map(_named_outside, values.split()))):
        outside, cause = True, number
    kind = tag + "".join(f".{n}" for n in sorted(set(names)))
    return Element(tag, f"{parent.path}/{kind}", outside, cause)


def read(html: str) -> list[Element | Block]:
    """Elements where they start and blocks where they end, in page order; white space in a block is one blank.

    A name or a form does not put outside what holds every article and main of
    the page or, if it has none, MOST of its text.
    """
    spared: frozenset[int] = frozenset()
    while True:
        items = list(_read(html, spared))
        if not any(i.cause for i in items):
            return items
        held, bodies, free, total = Counter(), set(), False, 0
        for i in items:
            if isinstance(i, Block):
                total += len(i.text)
                held[i.cause] += len(i.text)
            elif i.tag in ("article", "main"):
                bodies.add(i.cause)
                free = free or not i.outside
        held[0] = 0
        most = max(held, key=held.__getitem__)
        around = max(bodies - {0}, key=held.__getitem__, default=0) or (most if total and held[most] >= MOST * total else 0)
        if free or not around:
            return items
        spared |= {around}


class _Marks:
    """Tags, comments and declarations of a page, in time linear in its length whatever is left open in it."""

    def __init__(self, html: str):
        self.html, self.last, self.ends = html, html.rfind(">"), None

    def next(self, at: int) -> re.Match | None:
        """The first mark from ``at`` on; a ``<`` that begins none is text."""
        while (at := self.html.find("<", at)) >= 0:
            head = self.html[at + 1 : at + 4]
            if head[:1] in ("!", "?"):
                if head == "!--" or at < self.last:
                    return _NOTE.match(self.html, at)
            elif at < self.last and head.removeprefix("/")[:1].isalpha() and self._closed(at):
                mark = _TAG.match(self.html, at)
                if mark:
                    return mark
                self.ends = self.ends or self._closings()
            at += 1
        return None

    def _closed(self, at: int) -> bool:
        """Whether a tag at ``at`` has its ``>`` outside of quotes; taken for granted until one had not."""
        if self.ends is None:
            return True
        names, places, closed = self.ends
        n = bisect_left(names, at + 2)
        k = bisect_left(places, names[n]) if n < len(names) else len(places)
        return k < len(places) and closed[k]

    def _closings(self) -> tuple[list[int], list[int], list[bool]]:
        """Where names may end; quotes and ``>`` of the page, and for each whether a tag that reaches it ends."""
        places = [m.start() for m in _SPECIAL.finditer(self.html)]
        closed, following = [False] * (len(places) + 1), {}
        for k in range(len(places) - 1, -1, -1):
            sign = self.html[places[k]]
            closed[k] = sign == ">" or sign in following and closed[following[sign] + 1]
            following[sign] = k
        return [m.start() for m in _NAME_END.finditer(self.html)], places, closed


def _read(html: str, spared: frozenset[int]) -> Iterator[Element | Block]:
    stack, parts, at, number, marks, running = [Element("", "", False)], [], 0, 0, _Marks(html), Counter()
    while at <= len(html):
        mark = marks.next(at)
        text = html[at : mark.start() if mark else len(html)]
        if text:
            parts.append(unescape(text))
        if mark is None:
            break
        at = mark.end()
        tag = mark[2].lower() if mark.re is _TAG else ""
        if not tag:
            continue
        if tag in INLINE or tag in RAW and mark[1]:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            at = end.start() if end else len(html) + 1
            close = html.find(">", at) if end else -1
            at = close + 1 if close >= 0 else len(html) + 1
            continue
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        block = " ".join("".join(parts).split())
        parts = []
        if block:
            yield Block(stack[-1].path, block, stack[-1].outside, stack[-1].cause)
        if mark[1]:
            while running[tag] and (closed := stack.pop()):
                running[closed.tag] -= 1
                if closed.tag == tag:
                    break
            continue
        ends = _SELF_CLOSING.get(tag)
        if ends and stack[-1].tag in (*ends, *_CLOSED_BY_BLOCK):
            while stack[-1].tag in _CLOSED_BY_BLOCK:
                running[stack.pop().tag] -= 1
            while stack[-1].tag in ends:
                running[stack.pop().tag] -= 1
        while stack[-1].tag in _CLOSED_BY_BLOCK:
            running[stack.pop().tag] -= 1
        number += 1
        element = _element(stack[-1], tag, mark[3], number, spared)
        if len(stack) > LEVELS:
            element = element._replace(path=stack[-1].path)
        if tag in VOID or mark[3].endswith("/") and tag not in ("p", "div", "article", "main", "section", "body", "html"):
            continue
        yield element
        stack.append(element)
        running[tag] += 1
    block = " ".join("".join(parts).split())
    if block:
        yield Block(stack[-1].path, block, stack[-1].outside, stack[-1].cause)
