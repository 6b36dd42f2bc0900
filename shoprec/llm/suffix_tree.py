"""Suffix trees of integer sequences, common extensions in constant time, and runs.

A run is a maximal stretch with a smallest period of at most half its length. For one of the two
orders of the symbols its period is the length of the longest Lyndon word that begins at some place
inside it, so each place gives one candidate for each order, and the longest common extensions of
the candidate to both sides, read from the trees of the sequence and of its reversal, decide.
"""

from __future__ import annotations

from array import array

import numpy as np

#: Symbols from which the lists of a tree are packed arrays, slower and a quarter as large.
LONG = 200_000
_WIDTH = 16


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers from 1 up, closed by an end mark 0.

    Nodes are numbered as they are made, 0 is the root. `depth` is the length of the string from the
    root to a node, `suffix` the start of a leaf's suffix and -1 elsewhere; `parent` and `first` tell
    above which node a node hangs and with which symbol the edge to it begins.
    """

    def __init__(self, symbols: list[int]) -> None:
        s = [*symbols, 0]
        n = len(s)
        width = max(s) + 1
        new = (lambda: array("q", [0])) if n > LONG else (lambda: [0])
        start, end, link, depth, suffix = new(), new(), new(), new(), new()
        suffix[0] = -1
        child: dict[int, int] = {}
        find = child.get
        node = edge = length = left = 0
        for i in range(n):
            c = s[i]
            left += 1
            split = 0
            while left:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = find(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    depth.append(n - i + left - 1)
                    suffix.append(i - left + 1)
                    if split:
                        link[split] = node
                        split = 0
                else:
                    at = start[below]
                    size = end[below] - at
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[at + length] == c:
                        length += 1
                        if split:
                            link[split] = node
                        break
                    inner = len(start)
                    child[key] = inner
                    start.append(at)
                    end.append(at + length)
                    link.append(0)
                    depth.append(left - 1)
                    suffix.append(-1)
                    child[inner * width + c] = inner + 1
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    depth.append(n - i + left - 1)
                    suffix.append(i - left + 1)
                    start[below] = at + length
                    child[inner * width + s[at + length]] = below
                    if split:
                        link[split] = inner
                    split = inner
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        del start, end, link
        self.size, self.width = n, width
        keys = np.fromiter(child.keys(), np.int64, len(child))
        kids = np.fromiter(child.values(), np.int64, len(child))
        del child, find
        self.depth, self.suffix = np.array(depth, np.int32), np.array(suffix, np.int32)
        self.parent, self.first = np.zeros(len(self.depth), np.int64), np.zeros(len(self.depth), np.int64)
        self.parent[kids], self.first[kids] = np.divmod(keys, width)

    def _walk(self, order: np.ndarray, returns: bool) -> np.ndarray:
        """Leaves in the order that `order`, a number for each node's first symbol, gives to children;
        with `returns` also ~node each time the walk comes back to a node between two children."""
        kids = np.lexsort((-order, self.parent))
        kids = kids[kids > 0]  # last child first, as a stack wants them
        parent = self.parent[kids]
        if returns:
            last = np.append(parent[1:] != parent[:-1], True)  # the first child has no return before it
            flat = np.empty(2 * len(kids), np.int64)
            flat[0::2], flat[1::2] = kids, ~parent
            keep = np.ones(len(flat), bool)
            keep[1::2] = ~last
            flat, parent = flat[keep], np.repeat(parent, 2)[keep]
        else:
            flat = kids
        edges = np.searchsorted(parent, np.arange(len(self.depth) + 1))
        inner = (self.suffix < 0).tolist() if self.size <= LONG else array("b", (self.suffix < 0).astype(np.int8).tobytes())
        big = self.size > LONG
        begin = array("q", edges.tobytes()) if big else edges.tolist()
        flat = array("q", flat.tobytes()) if big else flat.tolist()
        out = array("q")
        stack = [0]
        take, put, see = stack.pop, out.append, stack.extend
        while stack:
            x = take()
            if x < 0 or not inner[x]:
                put(x)
            else:
                see(flat[begin[x] : begin[x + 1]])
        return np.frombuffer(out, np.int64) if len(out) else np.empty(0, np.int64)

    def euler(self) -> Extensions:
        """Common extensions from the Euler tour, and the leaves in rising order of their suffixes."""
        tour = self._walk(self.first, True)
        leaf = tour >= 0
        place = np.empty(self.size, np.int64)
        leaves = self.suffix[tour[leaf]]
        place[leaves] = np.flatnonzero(leaf)
        return Extensions(self.depth[np.where(leaf, tour, ~tour)], place, leaves)

    def falling(self) -> np.ndarray:
        """Suffixes in rising order when the order of the symbols is turned around, the end mark still first."""
        order = np.where(self.first == 0, 0, self.width - self.first)
        return self.suffix[self._walk(order, False)]


class Extensions:
    """Lengths of longest common prefixes of suffixes: the least depth on the tour between two leaves
    is the depth of their lowest common ancestor. Minima over blocks of the tour are kept for all
    powers of two, minima inside a block from its ends."""

    def __init__(self, depth: np.ndarray, place: np.ndarray, leaves: np.ndarray) -> None:
        self.place, self.leaves = place, leaves
        most = np.iinfo(np.int32).max
        rows = -(-len(depth) // _WIDTH)
        self.depth = np.full(rows * _WIDTH, most, np.int32)
        self.depth[: len(depth)] = depth
        blocks = self.depth.reshape(rows, _WIDTH)
        self.ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        self.behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while 2 << (len(self.table) - 1) <= rows:
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at i and j, i and j not equal."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        x, y = a // _WIDTH, b // _WIDTH
        out = np.minimum(self.behind[a], self.ahead[b])
        far = np.flatnonzero(y - x > 1)
        if len(far):
            low, span = x[far] + 1, y[far] - x[far] - 1
            level = np.frexp(span.astype(np.float64))[1] - 1
            least = np.empty(len(far), np.int32)
            for k in np.unique(level).tolist():
                at = np.flatnonzero(level == k)
                row = self.table[k]
                least[at] = np.minimum(row[low[at]], row[low[at] + span[at] - (1 << k)])
            out[far] = np.minimum(out[far], least)
        near = np.flatnonzero(x == y)
        if len(near):
            p, q = a[near], b[near]
            least = self.depth[p]
            for k in range(1, _WIDTH):
                least = np.minimum(least, self.depth[np.minimum(p + k, q)])
            out[near] = least
        return out


def next_smaller(suffixes: np.ndarray) -> np.ndarray:
    """For each place the next one whose suffix comes earlier in the order, or the length."""
    n = len(suffixes)
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.arange(n)
    rank = rank.tolist() if n <= LONG else array("q", rank.tobytes())
    out = array("q", bytes(8 * n))
    stack: list[int] = []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else n
        stack.append(i)
    return np.frombuffer(out, np.int64)


def runs(symbols: list[int], least: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` symbols, by start, then period.

    Symbols are numbers from 1 up. The end mark is smaller than all in both orders.
    """
    n = len(symbols)
    if n < 2:
        return []
    tree = SuffixTree(symbols)
    ahead = tree.euler()
    ends = [next_smaller(ahead.leaves)[:n], next_smaller(tree.falling())[:n]]
    del tree
    behind = SuffixTree(symbols[::-1]).euler()
    i = np.tile(np.arange(n), 2)
    j = np.concatenate(ends)
    keep = (i > 0) | (j < n)
    i, j = i[keep], j[keep]
    stop = j + ahead.between(i, j)
    start = i.copy()
    inner = np.flatnonzero(i > 0)
    start[inner] -= behind.between(n - i[inner], n - j[inner])
    period = j - i
    found = (stop - start >= 2 * period) & (stop - start >= least)
    rows = np.unique(np.stack([start[found], period[found], stop[found] - start[found]], axis=1), axis=0)
    return [(a, length, p) for a, p, length in rows.tolist()]
