"""A prefix tree of ordered token sets that finds similar pairs in a bounded block."""

from __future__ import annotations

import numpy as np


class _Node:
    __slots__ = ("tokens", "children", "longest", "ends", "only")

    def __init__(self, tokens: np.ndarray):
        self.tokens = tokens  # the path from the parent, one or more tokens
        self.children: dict[int, _Node] = {}
        self.longest = 0  # tokens of the longest set below
        self.ends: list[int] = []  # sets that end here
        self.only = -1  # a class that all sets below belong to, or None


class SetTrie:
    """Sets share their common beginnings, so a probe counts the overlap with a beginning once.

    A probe descends with the overlap and the tokens missed so far on both
    sides. A subtree is left out if even its longest set, matching all that is
    left, could not reach the threshold, or if all its sets are already in the
    probe's class.
    """

    def __init__(self, percent: int = 85):
        self.percent = percent
        self.root = _Node(np.zeros(0, np.int64))
        self.root.only = None
        self.size: list[int] = []
        self.parent: list[int] = []  # union-find over the sets

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def similar(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def add(self, tokens: np.ndarray) -> list[int]:
        """Insert a set in order; earlier sets it is similar to, one per class met."""
        me = len(self.size)
        self.size.append(len(tokens))
        self.parent.append(me)
        return self._finish(me, tokens, self._probe(me, tokens))

    def _finish(self, me: int, tokens: np.ndarray, met: list[int]) -> list[int]:
        for other in met:
            self.union(me, other)
        self._insert(me, tokens)
        return met

    def _probe(self, me: int, tokens: np.ndarray) -> list[int]:
        order = np.argsort(tokens)
        values, n, met = tokens[order], len(tokens), []
        stack = [(self.root, 0, 0, -1)]  # node, tokens above, of them in the probe, last place met there
        while stack:
            node, depth, common, last = stack.pop()
            if node.only is not None and node.only >= 0 and self.find(node.only) == self.find(me):
                continue
            if len(node.tokens):
                at = np.minimum(np.searchsorted(values, node.tokens), n - 1)
                places = order[at][values[at] == node.tokens]
                depth += len(node.tokens)
                common += len(places)
                if len(places):
                    last = max(last, int(places.max()))
            # The best set below: all that follows matches, up to the probe's end.
            size = min(node.longest, depth + n - 1 - last)
            if not self.similar(common + size - depth, n, size):
                continue
            for other in node.ends:
                if self.similar(common, n, self.size[other]) and self.find(other) != self.find(me):
                    met.append(other)
                    self.union(me, other)
            for child in node.children.values():
                stack.append((child, depth, common, last))
        return met

    def _insert(self, me: int, tokens: np.ndarray) -> None:
        node, at = self.root, 0
        self._note(node, me, len(tokens))
        while at < len(tokens):
            child = node.children.get(int(tokens[at]))
            if child is None:
                child = _Node(tokens[at:])
                node.children[int(tokens[at])] = child
                self._note(child, me, len(tokens))
                child.ends.append(me)
                return
            rest = tokens[at : at + len(child.tokens)]
            differ = np.flatnonzero(rest != child.tokens[: len(rest)])
            shared = int(differ[0]) if len(differ) else len(rest)
            if shared < len(child.tokens):
                upper = _Node(child.tokens[:shared])
                upper.longest, upper.only = child.longest, child.only
                child.tokens = child.tokens[shared:]
                upper.children[int(child.tokens[0])] = child
                node.children[int(tokens[at])] = upper
                child = upper
            self._note(child, me, len(tokens))
            node, at = child, at + shared
        node.ends.append(me)

    def _note(self, node: _Node, me: int, n: int) -> None:
        node.longest = max(node.longest, n)
        if node.only == -1:
            node.only = me
        elif node.only is not None and self.find(node.only) != self.find(me):
            node.only = None
