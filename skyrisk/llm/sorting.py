"""Deep-shallow sorting of byte strings in groups.

The shallow part is a multikey quicksort: all groups of a batch are split by the next eight
bytes at once, level by level, and strings that stand alone drop out. What still shares its
first `SHALLOW` bytes is put into a blind trie: a trie that keeps only the bytes where strings
branch, so that a string goes down without comparisons, is compared once with the leaf it
meets, and is put in where they differ.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64  # bytes that the multikey quicksort looks at


class BlindTrie:
    """Strings of a group by their branching bytes; equal strings share a leaf."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        # A node is [depth, {byte or -1 at the end: child}]; a leaf is a list of indexes in a tuple.
        self.root: list | tuple | None = None

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = ([i],)
            return
        node = self.root
        while isinstance(node, list):
            c = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(c) or next(iter(node[1].values()))
        other = self.strings[node[0][0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node[0].append(i)
            return
        parent, byte, node = None, -1, self.root
        while isinstance(node, list) and node[0] < depth:
            parent, byte = node, s[node[0]]
            node = node[1][byte]
        mine = s[depth] if depth < len(s) else -1
        if isinstance(node, list) and node[0] == depth:
            node[1][mine] = ([i],)
            return
        theirs = other[depth] if depth < len(other) else -1
        fork = [depth, {mine: ([i],), theirs: node}]
        if parent is None:
            self.root = fork
        else:
            parent[1][byte] = fork

    def order(self) -> list[int]:
        """Indexes in the order of their strings."""
        out: list[int] = []
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out += node[0]
        return out


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (x.bit_length() + 7) // 8


def sort_groups(strings: list[bytes], group: np.ndarray) -> np.ndarray:
    """A permutation that sorts the strings within each group; groups must be adjacent."""
    n = len(strings)
    width = SHALLOW // 8
    head = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(n, width)
    order = np.arange(n)
    segment = np.r_[0, np.cumsum(group[1:] != group[:-1])] if n else np.zeros(0, np.int64)
    for level in range(width):
        size = np.bincount(segment)
        open_ = np.flatnonzero(size[segment] > 1)
        if not len(open_):
            break
        rows = order[open_]
        by = np.lexsort((head[rows, level], segment[open_]))
        order[open_] = rows[by]
        word = head[order[open_], level]
        split = np.r_[False, (word[1:] != word[:-1]) & (segment[open_][1:] == segment[open_][:-1])]
        # New segments keep their order among all others.
        first = np.zeros(n, bool)
        first[open_] = split
        first |= np.r_[True, segment[1:] != segment[:-1]]
        segment = np.cumsum(first) - 1
    edges = np.r_[np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]), n] if n else np.zeros(1, np.int64)
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        if b - a > 1:
            rows = order[a:b]
            trie = BlindTrie([strings[i] for i in rows])
            for i in range(b - a):
                trie.add(i)
            order[a:b] = rows[trie.order()]
    return order
