"""Sorted runs of byte strings with front coding, and their merge by a loser tree that knows common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of a and b, of which ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared, own, tails) of sorted strings: bytes shared with the string before, length of the rest, all rests."""
    shared, own, tails = np.zeros(len(strings), np.uint16), np.zeros(len(strings), np.uint16), []
    last = b""
    for i, s in enumerate(strings):
        n = common_prefix(last, s)
        shared[i], own[i] = n, len(s) - n
        tails.append(s[n:])
        last = s
    return shared, own, b"".join(tails)


def decode(shared: np.ndarray, own: np.ndarray, tails: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a run, each with the number of bytes that it shares with the one before."""
    last, at = b"", 0
    for n, m in zip(shared.tolist(), own.tolist()):
        last = last[:n] + tails[at:at + m]
        at += m
        yield last, n


def merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(string, bytes shared with the string before, number of its run) of all runs in order.

    Every candidate in the tree carries the length h of its common prefix with the last string put out. Of two
    candidates the one with the longer h is smaller, without a look at the strings; with equal h they are compared
    from byte h on, and the loser's h becomes its common prefix with the winner. A run's next string has its front
    code as h, as the string before it has just been put out. No byte of a known prefix is compared again.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    head: list[bytes | None] = [None] * k
    h = [0] * k
    for i, run in enumerate(runs):
        first = next(run, None)
        if first is not None:
            head[i] = first[0]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if h[a] != h[b]:
            return (a, b) if h[a] > h[b] else (b, a)
        n = common_prefix(x, y, h[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            h[b] = n
            return a, b
        h[a] = n
        return b, a

    loser = [0] * k
    winners = list(range(k))
    level = k // 2
    while level:  # winners of the leaves below each node, bottom up
        up = []
        for i in range(level):
            w, lost = play(winners[2 * i], winners[2 * i + 1])
            loser[level + i] = lost
            up.append(w)
        winners, level = up, level // 2
    w = winners[0]
    while head[w] is not None:
        yield head[w], h[w], w
        after = next(runs[w], None)
        head[w], h[w] = after if after is not None else (None, 0)
        node = (w + k) // 2
        while node:
            w, loser[node] = play(w, loser[node])
            node //= 2
