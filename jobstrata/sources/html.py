"""A small element finder on the standard library's HTML parser, run inside tasks.

Covers what the site settings use: tag, ``.class``, ``[attr]``, ``[attr=value]``,
``[attr*=value]`` and nesting by a blank.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style"}
# an element that ends where one of these starts, unless the container comes in between
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
_PART = re.compile(r"""\.([\w-]+)|\[\s*([\w-]+)\s*(?:(\*?=)\s*"([^"]*)"\s*)?\]|([\w-]+)""")
_STEP = re.compile(r"""(?:[^\s\[]|\[[^\]]*\])+""")


@dataclass
class Element:
    tag: str
    attrs: dict
    parent: Element | None
    children: list = field(default_factory=list)  # elements and text, in page order

    def hits(self, selectors: Sequence[str]):
        """``(place, element, which)`` for every element below this one, in page order: its place among them and the numbers of
        the selectors it fits; ``which`` is None where the element of that place ends.

        One pass for all selectors. A state per selector, the number of its leading steps that the open elements have
        taken, goes down with them, so no element looks up at its ancestors again.
        """
        plans = [_parse(s) for s in selectors]
        above, e = [], self
        while e is not None:
            above.append(e)
            e = e.parent
        states = [0] * len(plans)
        for e in reversed(above if any(len(p) > 1 for p in plans) else []):
            states = _further(e, states, plans)
        place, stack = 0, [(c, states, -1) for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e, states, begun = stack.pop()
            if begun >= 0:
                yield begun, e, None
                continue
            yield place, e, [k for k, (n, p) in enumerate(zip(states, plans)) if n == len(p) - 1 and _fits_step(e, p[-1])]
            stack.append((e, states, place))
            place += 1
            if e.children:
                below = _further(e, states, plans)
                stack += [(c, below, -1) for c in reversed(e.children) if isinstance(c, Element)]

    def text(self) -> str:
        """Stripped text pieces of the element and everything in it, joined without a separator.

        What scripts and style sheets hold is no text.
        """
        pieces, stack = [], self.children[::-1]
        while stack:
            child = stack.pop()
            if not isinstance(child, Element):
                pieces.append(child.strip())
            elif child.tag not in SILENT:
                stack += child.children[::-1]
        return "".join(pieces)

    def find_all(self, selector: str):
        return [e for _, e, which in self.hits([selector]) if which]

    def find(self, selector: str):
        return next((e for _, e, which in self.hits([selector]) if which), None)

    def cards(self, container: str, fields: Mapping[str, str]) -> list[tuple[Element, dict[str, Element]]]:
        """Every element that fits ``container``, with the first element below it for each field that has one.

        The page is walked once for all selectors; the first fitting element after a card's begin and before its end is
        looked up in the sorted places of the field's elements.
        """
        names = list(fields)
        found, places, elements = [], [[] for _ in names], [[] for _ in names]
        ends: dict[int, int] = {}
        last = 0
        for place, e, which in self.hits([container, *fields.values()]):
            if which is None:
                ends[place] = last
                continue
            last = place
            for k in which:
                if k:
                    places[k - 1].append(place)
                    elements[k - 1].append(e)
                else:
                    found.append((place, e))
        out = []
        for place, card in found:
            inside = {}
            for name, at, of in zip(names, places, elements):
                k = bisect_right(at, place)
                if k < len(at) and at[k] <= ends[place]:
                    inside[name] = of[k]
            out.append((card, inside))
        return out


@lru_cache(maxsize=256)
def _parse(selector: str) -> list:
    return [[m.groups() for m in _PART.finditer(step)] for step in _STEP.findall(selector)]


def _fits_step(e: Element, step) -> bool:
    for cls, attr, op, value, tag in step:
        if tag and e.tag != tag:
            return False
        if cls and cls not in (e.attrs.get("class") or "").split():
            return False
        if attr:
            have = e.attrs.get(attr) or ""
            if attr not in e.attrs or (op == "=" and have != value) or (op == "*=" and value not in have):
                return False
    return True


def _further(e: Element, states: list[int], plans: list) -> list[int]:
    """States of the selectors below ``e``; a step taken as early as possible leaves most for the others."""
    new = None
    for k, (n, p) in enumerate(zip(states, plans)):
        if n < len(p) - 1 and _fits_step(e, p[n]):
            new = new or list(states)
            new[k] = n + 1
    return new or states


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)
        self.open: dict[str, int] = {}  # open elements by tag, so that a stray end tag costs nothing

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.at.tag == "p":  # a paragraph ends where the next one starts
            self._leave(self.at)
        elif tag in ENDS:
            self._end_open(*ENDS[tag])
        e = Element(tag, dict(attrs), self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e
            self.open[tag] = self.open.get(tag, 0) + 1

    def _end_open(self, ended, containers):
        """Close the nearest of ``ended`` inside the nearest container, and with it what is open in it."""
        if not any(self.open.get(t) for t in ended):
            return
        e = self.at
        while e.parent is not None and e.tag not in ended and e.tag not in containers:
            e = e.parent
        if e.tag in ended:
            self._leave(e)

    def _leave(self, e):
        while self.at is not e.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        e = self.at
        while e.tag != tag:
            e = e.parent
        self._leave(e)

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str) -> Element:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.root
