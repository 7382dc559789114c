"""Leaf blocks of a page: runs of text between the borders of block elements, with the elements above them."""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

#: Fixed values of HTML: elements that part text into blocks, elements whose content is not markup, and elements without content.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html iframe label legend li main menu nav noscript object ol optgroup option p pre search section select summary table tbody "
    "td template tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag ends these elements of its own kind, if they are the innermost ones.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}}

# Every alternative moves on without giving back, so a broken page is read in one pass; what is not closed ends with the page.
_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)
|<(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+|["'])*+)(?:>|\Z)""", re.S | re.X)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CLOSE = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in RAW}


class Block(NamedTuple):
    text: str
    parent: int  # number of the element that holds the text
    tag: str
    names: tuple[str, ...]  # words of that element's class, id and role
    above: frozenset[str]  # features of it and of all elements above it
    linked: int  # characters inside links


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Blocks in page order; text in them has its character references decoded and white space turned into one space.

    Comments, scripts, styles, titles and form values are no text. Elements that are not closed end where HTML lets
    them end, or with the page. ``known`` limits which features of elements are gathered.
    """
    out: list[Block] = []
    stack = [("", (), frozenset(), 0)]
    opened: dict[str, int] = {}
    pieces: list[str] = []
    linked, link, number, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join("".join(pieces).split()):
                tag, names, above, me = stack[-1]
                out.append(Block(text, me, tag, names, above, linked))
            pieces.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            if link:
                linked += len(text)

    def pop() -> None:
        nonlocal link
        opened[stack.pop()[0]] -= 1
        link = 0 if link >= len(stack) else link

    while m := _TOKEN.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        if tag := m["end"]:
            tag = tag.lower()
            if tag == "a":
                link = 0
            elif tag in BLOCK:
                flush()
                if opened.get(tag) and tag not in ("body", "html"):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
        elif tag := m["tag"]:
            tag = tag.lower()
            if tag == "a":
                link = len(stack)
            elif tag == "br":
                pieces.append(" ")
            elif tag in BLOCK:
                flush()
                if stack[-1][0] == "p" and tag not in ("button", "label", "select", "option", "optgroup", "noscript", "object", "iframe"):
                    pop()
                while stack[-1][0] in ENDS.get(tag, ()):
                    pop()
                if tag not in VOID and tag not in RAW:
                    number += 1
                    names = _names(m["attrs"])
                    new = {f"in:{tag}", *(f"of:{n}" for n in names)}
                    above = stack[-1][2]
                    if known is not None:
                        new &= known
                    stack.append((tag, names, above if new <= above else above | new, number))
                    opened[tag] = opened.get(tag, 0) + 1
            if tag in RAW:
                end = _CLOSE[tag].search(page, at)
                at = end.start() if end else len(page)
    say(page[at:])
    flush()
    return out


def _names(attrs: str) -> tuple[str, ...]:
    """Words of class, id, role and itemprop, lower-cased; ``hidden`` for what is not shown."""
    if not attrs or attrs.isspace():
        return ()
    out = []
    for m in _NAMED.finditer(attrs):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or kind == "style" and re.search(r"display\s*:\s*none", value):
            out.append("hidden")
        elif kind != "style":
            out += [p.lower() for p in _PART.findall(value)]
    return tuple(dict.fromkeys(out))
