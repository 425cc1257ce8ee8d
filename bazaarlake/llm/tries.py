"""Compressed tries of whole texts."""

from __future__ import annotations


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the longest prefix of ``a`` that ``b`` has at ``at``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


class Terminal:
    """A text's place in a trie: what was inserted under it, and its smallest id."""

    __slots__ = ("least", "rows", "value")

    def __init__(self):
        self.least, self.rows, self.value = None, [], None

    def add(self, ident, row) -> None:
        """NULL ids are never the smallest."""
        if ident is not None and (self.least is None or ident < self.least):
            self.least = ident
        self.rows.append((ident, row))


class Node:
    __slots__ = ("children", "label", "terminal")

    def __init__(self, label: bytes):
        self.label, self.children, self.terminal = label, {}, None


class Trie:
    """Texts share their prefixes; an edge is labelled by all bytes up to the next fork."""

    def __init__(self):
        self.root, self.bytes, self.rows = Node(b""), 0, 0

    def insert(self, text: bytes) -> Terminal:
        """The terminal of ``text``, made where it is new."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += len(child.label)
            elif not text.startswith(child.label, at):
                cut = _common(child.label, text, at)
                fork = node.children[text[at]] = Node(child.label[:cut])
                child.label = child.label[cut:]
                fork.children[child.label[0]] = child
                child = fork
            at += len(child.label)
            node = child
        if node.terminal is None:
            node.terminal = Terminal()
        self.rows += 1
        return node.terminal

    def terminals(self):
        """(text, terminal) of all texts; a stack of its own, as a trie may be deep."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node.label
            if node.terminal is not None:
                yield text, node.terminal
            stack += [(text, child) for child in node.children.values()]
