"""A page as a tree of block elements whose leaves are runs of inline text."""

from __future__ import annotations

import html as entities
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math object xmp".split())  # their content is never text
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead title tr ul".split())
# an opening tag ends an open element of these names, as long as none of the second set is nested in between
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])), "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_P = (frozenset(["p"]), frozenset(["td", "th", "button", "caption", "object"]))
_KEEPS_P = frozenset(["option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "head", "body"])
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


class Node:
    """``name`` is ``#text`` for a leaf; ``linked`` counts the characters of it that are inside links."""

    __slots__ = ("name", "about", "parent", "text", "linked")

    def __init__(self, name: str, about: str, parent: int, text: str = "", linked: int = 0):
        self.name, self.about, self.parent, self.text, self.linked = name, about, parent, text, linked


_STOP = re.compile(r">|=\s*([\"'])")


def _tag_end(html: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, behind all quoted attribute values however long; -1 if there is none. A quote opens
    a value only behind ``=``, and one that never closes opens none."""
    while found := _STOP.search(html, at):
        if not found[1]:
            return found.start()
        close = html.find(found[1], found.end())
        if close < 0:
            return html.find(">", found.end())
        at = close + 1
    return -1


def parse(html: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 is the page. Work is linear and nothing recurses, so unclosed and deeply
    nested elements do no harm. Elements still open at the end of the page end there."""
    nodes = [Node("#page", "", -1)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements; inline ones carry the node of their block
    open_names: dict[str, int] = {}
    run: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                nodes.append(Node("#text", "", stack[-1][1], text, linked))
            run.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        run.append(text)
        if links > 0:
            linked += len(text)

    def pop() -> None:
        nonlocal links
        name, _ = stack[-1]
        if name in BLOCK:
            flush()
        stack.pop()
        open_names[name] -= 1
        if name == "a":
            links -= 1

    def close_before(names: frozenset, stops: frozenset) -> None:
        if not any(open_names.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in stops:
                return

    at, size = 0, len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            say(html[at:])
            break
        if begin > at:
            say(html[at:begin])
        mark = html[begin + 1:begin + 2]
        if html.startswith("<!--", begin):
            end = html.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if mark in ("!", "?"):
            end = html.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        closing = mark == "/"
        found = _NAME.match(html, begin + 1 + closing)
        if not found:
            if closing and (end := html.find(">", begin)) >= 0:  # a comment in all but name
                at = end + 1
            else:
                say("<")
                at = begin + 1
            continue
        end = _tag_end(html, found.end())
        if end < 0:  # cut off inside a tag
            break
        name, attributes, at = found[0].lower(), html[found.end():end], end + 1
        if closing:
            if name == "br":
                run.append(" ")
            elif open_names.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
                at = over.end() if over else size
            continue
        if name in VOID:
            if name == "br":
                run.append(" ")
            elif name == "hr":
                flush()
                close_before(*_P)
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES:
                close_before(*CLOSES[name])
            if name not in _KEEPS_P:
                close_before(*_P)
            about = " ".join(v.strip("\"'") for _, v in _ATTRIBUTE.findall(attributes)) if attributes else ""
            nodes.append(Node(name, about, stack[-1][1]))
            stack.append((name, len(nodes) - 1))
        else:
            stack.append((name, stack[-1][1]))
            if name == "a":
                links += 1
        open_names[name] = open_names.get(name, 0) + 1
    flush()
    if all(n.name == "#text" for n in nodes[1:]):
        nodes[0].about = "unmarked"
    return nodes
