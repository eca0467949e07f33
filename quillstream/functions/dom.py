"""A page's elements as a tree, and a small selector language over it; used inside tasks only.

A selector is a list, by commas, of chains of compounds: tag, .class, [attr], [attr='value'], [attr*='part']; a space
means anywhere inside.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html.parser import HTMLParser

from quillstream.functions.html import VOID

_COMPOUND = re.compile(r"""(?P<tag>[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w:-]+)(?:(?P<op>\*?=)['"]?(?P<value>[^'"\]]*)['"]?)?\]""")


class Node:
    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[Node | str] = []

    def nodes(self) -> Iterator[Node]:
        """All elements inside, in document order."""
        todo = [p for p in reversed(self.parts) if isinstance(p, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def strings(self) -> Iterator[tuple[str, Node]]:
        """Stripped pieces of text inside and the element that each stands in; code and styles have none."""
        todo: list[tuple] = [(p, self) for p in reversed(self.parts)]
        while todo:
            part, owner = todo.pop()
            if isinstance(part, Node):
                if part.tag not in ("script", "style", "template"):
                    todo += [(p, part) for p in reversed(part.parts)]
            elif part.strip():
                yield part.strip(), owner

    def text(self, between: str = "") -> str:
        return between.join(s for s, _ in self.strings())

    def matches(self, compound: tuple) -> bool:
        tag, classes, attrs = compound
        if tag and self.tag != tag:
            return False
        own = (self.attrs.get("class") or "").split()
        if not all(c in own for c in classes):
            return False
        return all(a in self.attrs and (not op or (value in (self.attrs[a] or "") if op == "*=" else value == self.attrs[a])) for a, op, value in attrs)

    def select(self, selector: str) -> list[Node]:
        chains = compiled(selector)
        return [n for n in self.nodes() if any(n._ends(chain) for chain in chains)]

    def first(self, selector: str) -> Node | None:
        chains = compiled(selector)
        return next((n for n in self.nodes() if any(n._ends(chain) for chain in chains)), None)

    def _ends(self, chain: tuple) -> bool:
        if not self.matches(chain[-1]):
            return False
        node, left = self.parent, len(chain) - 1
        while left and node is not None:
            left -= node.matches(chain[left - 1])
            node = node.parent
        return not left

    def remove(self, selector: str) -> None:
        for node in self.select(selector):
            if node.parent is not None and node in node.parent.parts:
                node.parent.parts.remove(node)


@functools.lru_cache(1024)
def compiled(selector: str) -> tuple:
    out = []
    for chain in selector.split(","):
        compounds = []
        for part in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", chain.strip()):
            found = list(_COMPOUND.finditer(part))
            tag = next((m["tag"].lower() for m in found if m["tag"]), None)
            compounds.append((tag, tuple(m["cls"] for m in found if m["cls"]), tuple((m["attr"], m["op"], m["value"]) for m in found if m["attr"])))
        out.append(tuple(compounds))
    return tuple(out)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.parts.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def parse(page: str | None) -> Node:
    tree = _Tree()
    tree.feed(page or "")
    tree.close()
    return tree.root
