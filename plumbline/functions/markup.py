"""A small element tree over html.parser, used per row inside Spark tasks."""

from __future__ import annotations

import re
from html.entities import html5
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "kids", "up", "begin", "inner", "close", "end")

    def __init__(self, tag, attrs, up, begin, inner):
        self.tag, self.attrs, self.up = tag, attrs, up
        self.begin, self.inner, self.close, self.end = begin, inner, None, None
        self.kids: list = []

    def walk(self):
        stack = list(reversed(self.kids))
        while stack:
            k = stack.pop()
            if isinstance(k, Node):
                yield k
                stack.extend(reversed(k.kids))

    def all(self, *tags):
        return (n for n in self.walk() if n.tag in tags)

    def first(self, *tags):
        return next(self.all(*tags), None)

    def strings(self, drop=None):
        """All texts below in order, without those of nodes that ``drop`` accepts."""
        stack = list(reversed(self.kids))
        while stack:
            k = stack.pop()
            if isinstance(k, Node):
                if drop is None or not drop(k):
                    stack.extend(reversed(k.kids))
            else:
                yield k

    def text(self, sep="", trim=False):
        parts = (s.strip() for s in self.strings()) if trim else self.strings()
        return sep.join(p for p in parts if p) if trim else sep.join(parts)

    def get(self, name, default=""):
        v = self.attrs.get(name)
        return default if v is None else v

    def classes(self):
        return self.get("class").split()


#: A character reference, its semicolon included where there is one.
REFERENCE = re.compile("&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)?(;?)")


def _held_open(source: str) -> tuple[str, str]:
    """``source`` with every & that begins no closed reference replaced by one character that it doesn't hold; that character."""
    mark = next(c for c in map(chr, range(0xFDD0, 0x110000)) if c not in source)

    def one(m):
        name, end = m.groups()
        known = name and end and (name[0] == "#" or name + ";" in html5)
        return m[0] if known else mark + m[0][1:]

    return REFERENCE.sub(one, source), mark


class _Tree(HTMLParser):
    def __init__(self, source, closed_only=False):
        super().__init__(convert_charrefs=True)
        self.source = source
        held, self.mark = _held_open(source) if closed_only and "&" in source else (source, None)  # of the same length
        self.lines = [0]
        for i, ch in enumerate(source):
            if ch == "\n":
                self.lines.append(i + 1)
        self.root = self.at = Node("", {}, None, 0, 0)
        self.feed(held)
        self.close()
        self._shut(self.root, len(source), len(source))

    def _here(self):
        line, off = self.getpos()
        return self.lines[line - 1] + off

    def _shut(self, node, close, end):
        while self.at is not node:
            self.at.close = self.at.end = close
            self.at = self.at.up
        node.close, node.end = close, end
        self.at = node.up or node

    def handle_starttag(self, tag, attrs):
        begin = self._here()
        if self.mark:
            attrs = [(k.replace(self.mark, "&"), v and v.replace(self.mark, "&")) for k, v in attrs]
        node = Node(tag, dict(reversed(attrs)), self.at, begin, begin + len(self.get_starttag_text()))
        self.at.kids.append(node)
        if tag in VOID:
            node.close = node.end = node.inner
        else:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._shut(self.at, self.at.inner, self.at.inner)

    def handle_endtag(self, tag):
        node = self.at
        while node.up is not None and node.tag != tag:
            node = node.up
        if node.up is not None:
            here = self._here()
            gt = self.source.find(">", here)
            self._shut(node, here, gt + 1 if gt >= 0 else len(self.source))

    def handle_data(self, data):
        self.at.kids.append(data.replace(self.mark, "&") if self.mark else data)


def parse(source: str) -> Node:
    return _Tree(source or "").root


def parse_closed(source: str) -> Node:
    """``parse``, but references without their semicolon, as a cut text ends in, stay as they stand."""
    return _Tree(source or "", closed_only=True).root


def without(source: str, node: Node, drop) -> str:
    """Inner source of ``node`` with the source of every node ``drop`` accepts cut out."""
    out, at = [], node.inner
    for n in node.walk():
        if n.begin >= at and drop(n):
            out.append(source[at:n.begin])
            at = max(at, n.end)
    return "".join(out) + source[at:node.close]
