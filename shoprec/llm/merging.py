"""Merging sorted runs with a loser tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

_DONE = object()


def merge_runs(runs: Iterable[Iterable[tuple]]) -> Iterator[tuple]:
    """All items of the sorted runs in order; equal items in the order of the runs.

    Inner nodes keep the loser of their match, so a new head is compared along one path only.
    """
    feeds = [iter(r) for r in runs]
    heads: list[Any] = [next(f, _DONE) for f in feeds]
    k = len(feeds)
    if k == 0:
        return

    def beats(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if y is _DONE:
            return x is not _DONE or a < b
        return x is not _DONE and (x < y or (a < b and not y < x))

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        won, lost = (a, b) if beats(a, b) else (b, a)
        winners[node], losers[node] = won, lost
    best = winners[1] if k > 1 else 0
    while heads[best] is not _DONE:
        yield heads[best]
        heads[best] = next(feeds[best], _DONE)
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


def merge_front_coded(runs: list[Iterator[tuple[int, bytes, Any]]]) -> Iterator[tuple[int, bytes, Any]]:
    """Merge runs of front-coded strings; yields (prefix shared with the string before, string, value).

    A run yields for each of its strings, in order, the length of the prefix shared with the one
    before in the run, the rest, and a value. Each head carries the length of the prefix it shares
    with the last string put out. Of two heads the one that shares more comes first, without a look
    at their bytes; if they share the same, comparison starts behind that prefix, and the loser
    keeps what the comparison found. No byte known to be equal is compared again.
    """
    k = len(runs)
    text: list[bytes | None] = [None] * k
    value: list[Any] = [None] * k
    shared = [0] * k  # of the head with the last winner on its path

    def advance(i: int) -> None:
        item = next(runs[i], None)
        if item is None:
            text[i] = None
        else:
            n, rest, value[i] = item
            before = text[i]
            text[i] = rest if before is None or n == 0 else before[:n] + rest
            shared[i] = n if before is not None else 0

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads; their `shared` refer to the same string before."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        m, n = shared[a], shared[b]
        if m != n:
            return (a, b) if m > n else (b, a)
        p, q = x[m:], y[m:]
        if p == q:
            won, lost, same = (a, b, len(x)) if a < b else (b, a, len(x))
        else:
            least = min(len(p), len(q))
            differ = int.from_bytes(p[:least], "big") ^ int.from_bytes(q[:least], "big")
            same = m + least - (differ.bit_length() + 7) // 8
            won, lost = (a, b) if p < q else (b, a)
        shared[lost] = same
        return won, lost

    if k == 0:
        return
    for i in range(k):
        advance(i)
    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = match(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if k > 1 else 0
    while text[best] is not None:
        yield shared[best], text[best], value[best]
        advance(best)
        node = (best + k) // 2
        while node:
            best, losers[node] = match(best, losers[node])
            node //= 2
