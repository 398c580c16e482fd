"""A z-fast trie over strings that are known by the hashes of their prefixes.

A compacted node stands for the depths (low, deep] of its strings. It is found by its handle: the prefix whose length is
the two-fattest number of (low, deep], that with the most factors of two. A string finds its exit node by fat binary
search, in steps that grow with the logarithm of its length, and needs no node in between.
"""

from __future__ import annotations

import numpy as np


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] with the most factors of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Strings are lists of prefix hashes: entry d belongs to the first d symbols, entry 0 to none.

    Equal hashes count as equal prefixes; a hash must depend on its depth too.
    """

    def __init__(self) -> None:
        self.low, self.deep, self.up = [-1], [0], [-1]  # the root is the empty prefix
        self.string: list[int] = [-1]  # a string below the node: its hashes are those of the node's depths
        self.strings: list[list[int]] = []
        self.handles: dict[int, int] = {}
        self.starts: dict[int, int] = {}  # hash at the node's first depth -> node
        self.ends: list[int] = []  # node where each string ends

    def locate(self, hashes: list[int], node: int = 0) -> int:
        """The deepest node below ``node`` all of whose depths the string has (its exit node or the one above)."""
        known, most = self.deep[node], len(hashes) - 1
        while known < most:
            at = two_fattest(known, most)
            found = self.handles.get(hashes[at])
            if found is None:
                most = at - 1
            elif self.deep[found] < len(hashes) and self.strings[self.string[found]][self.deep[found]] == hashes[self.deep[found]]:
                node, known = found, self.deep[found]
            else:  # the string leaves inside this node
                return self.up[found]
        return node

    def insert(self, batch: list[list[int]]) -> None:
        """Locate all strings of a batch in the trie as it is, then hang them one by one.

        A string goes on from the node that was found: strings before it in the batch may have made nodes below.
        """
        found = [self.locate(hashes) for hashes in batch]
        for node, hashes in zip(found, batch, strict=True):
            self._hang(hashes, self.locate(hashes, node))

    def _hang(self, hashes: list[int], node: int) -> None:
        self.strings.append(hashes)
        me, length = len(self.strings) - 1, len(hashes) - 1
        if self.deep[node] < length:
            child = self.starts.get(hashes[self.deep[node] + 1])
            if child is not None:  # the string leaves inside the child: cut it there
                other, low, high = self.strings[self.string[child]], self.low[child] + 1, min(length, self.deep[child])
                while low < high:  # the last depth at which both agree
                    middle = (low + high + 1) // 2
                    if other[middle] == hashes[middle]:
                        low = middle
                    else:
                        high = middle - 1
                node = self._cut(child, low)
            if self.deep[node] < length:
                node = self._add(self.deep[node], length, node, me)
        self.ends.append(node)

    def _add(self, low: int, deep: int, up: int, string: int) -> int:
        self.low.append(low)
        self.deep.append(deep)
        self.up.append(up)
        self.string.append(string)
        node = len(self.low) - 1
        self._name(node)
        return node

    def _name(self, node: int) -> None:
        hashes = self.strings[self.string[node]]
        self.handles[hashes[two_fattest(self.low[node], self.deep[node])]] = node
        self.starts[hashes[self.low[node] + 1]] = node

    def _cut(self, node: int, depth: int) -> int:
        """Give the depths up to ``depth`` to a new node above; both get their handles anew."""
        if depth == self.deep[node]:
            return node
        above = self._add(self.low[node], depth, self.up[node], self.string[node])
        self.low[node], self.up[node] = depth, above
        self._name(node)
        return above

    def order(self) -> np.ndarray:
        """Nodes so that each comes after the one above it."""
        return np.argsort(np.array(self.deep), kind="stable")
