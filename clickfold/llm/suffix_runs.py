"""All maximal repetitions of a sequence through suffix trees.

``Extensions`` answers longest-common-extension queries of one sequence: an
Ukkonen suffix tree, an Euler tour of it, and a sparse table of minima over
the tour, so that a query is the string depth of a lowest common ancestor in
constant time (many queries at once, as arrays).  The tree's depth-first
orders also rank the suffixes under an order of the symbols and under its
reversal.
"""

from __future__ import annotations

import numpy as np

#: The symbol behind the last one, smaller than all (symbols count from 1).
END = 0


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict | None]]:
    """Ukkonen's construction for ``s``, whose last symbol occurs once: the
    first and last (exclusive) position of the edge above each node, and the
    children by their first symbol (None for a leaf).  Node 0 is the root."""
    n = len(s)
    first, last, link, kids = [0], [0], [0], [{}]
    node = edge = length = left = 0
    for i, c in enumerate(s):
        left += 1
        pending = 0
        while left:
            if not length:
                edge = i
            below = kids[node]
            symbol = s[edge]
            child = below.get(symbol)
            if child is None:
                below[symbol] = len(first)
                first.append(i)
                last.append(n)
                link.append(0)
                kids.append(None)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                at = first[child]
                size = (last[child] if kids[child] is not None else i + 1) - at
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                on = s[at + length]
                if on == c:
                    length += 1
                    if pending:
                        link[pending] = node
                    break
                split = len(first)
                below[symbol] = split
                first += (at, i)
                last += (at + length, n)
                link += (0, 0)
                kids += ({on: child, c: split + 1}, None)
                first[child] = at + length
                if pending:
                    link[pending] = split
                pending = split
            left -= 1
            if node == 0 and length:
                length -= 1
                edge = i - left + 1
            else:
                node = link[node]
    return first, last, kids


class Extensions:
    """Constant-time longest common extensions of ``s`` (symbols from 1)."""

    def __init__(self, s: list[int], ranked: bool = False):
        self.n = len(s)
        s = [*s, END]
        first, last, kids = suffix_tree(s)
        size = len(first)
        depth, above, enter = [0] * size, [0] * size, [0] * size
        tour: list[int] = []
        stack, down = [0], []
        while stack:
            v = stack.pop()
            enter[v] = len(tour)
            tour.append(above[v])
            k = kids[v]
            if k is None:
                down.append(v)
                continue
            d = depth[v]
            for symbol in sorted(k, reverse=True) if ranked else k:
                c = k[symbol]
                above[c] = d
                depth[c] = d + last[c] - first[c]
                stack.append(c)
        leaf = np.array(down)
        suffix = self.n + 1 - np.array(depth)[leaf]
        self._enter = np.empty(self.n + 1, np.int64)
        self._enter[suffix] = np.array(enter)[leaf]
        rows = [np.array(tour, np.int32)]
        step = 1
        while 2 * step <= size:
            low = rows[-1].copy()
            np.minimum(low[:-step], rows[-1][step:], out=low[:-step])
            rows.append(low)
            step *= 2
        self._least = np.stack(rows)
        if ranked:
            self.ranks = [self._ranks(suffix), self._ranks(self._reversed(kids, depth))]

    def _ranks(self, order) -> list[int]:
        rank = np.empty(self.n + 1, np.int64)
        rank[order] = np.arange(self.n + 1)
        return rank.tolist()

    def _reversed(self, kids, depth) -> np.ndarray:
        """Suffixes in the order of reversed symbols, the end still first."""
        stack, down = [0], []
        while stack:
            v = stack.pop()
            k = kids[v]
            if k is None:
                down.append(self.n + 1 - depth[v])
                continue
            symbols = sorted(k)
            if symbols[0] == END:
                symbols = [*symbols[1:], END]
            stack += [k[x] for x in symbols]
        return np.array(down)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on agree (``i`` != ``j``)."""
        a, b = self._enter[i], self._enter[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self._least[k, low], self._least[k, high - (1 << k) + 1]).astype(np.int64)


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each suffix the next one behind it that ranks lower: the end of the
    longest Lyndon word that starts there."""
    n = len(rank) - 1
    out, stack = [n] * n, [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out)


def runs(s: list[int], least: int = 2, times: int = 2) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every maximal repetition of ``s`` with a
    length of at least ``max(least, times * period)``, ordered.

    Each has a Lyndon root (under one of two opposite orders) that is the
    longest Lyndon word at its place; these are the candidates, extended to
    the right in the tree of ``s`` and to the left in that of its reversal.
    """
    n = len(s)
    if n < max(least, times):
        return []
    right = Extensions(s, ranked=True)
    at, period = [], []
    for rank in right.ranks:
        p = _next_smaller(rank) - np.arange(n)
        i = np.flatnonzero(p * times <= n)
        at.append(i)
        period.append(p[i])
    found = np.unique(np.stack([np.concatenate(at), np.concatenate(period)], 1), axis=0)
    i, p = found[:, 0], found[:, 1]
    more = right.common(i, i + p)
    long_ = more > 0 if times > 1 else np.ones(len(i), bool)
    i, p, more = i[long_], p[long_], more[long_]
    if not len(i):
        return []
    back = Extensions(s[::-1]).common(n - i, n - i - p)
    length = back + p + more
    keep = length >= np.maximum(least, times * p)
    out = np.unique(np.stack([(i - back)[keep], length[keep], p[keep]], 1), axis=0)
    return sorted(map(tuple, out.tolist()), key=lambda r: (r[0], r[2]))
