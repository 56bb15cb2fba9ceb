"""A byte-context trie of higher order in flat arrays, for prediction by partial matching.

Counts are frozen, escapes follow method D (each distinct symbol of a context gives half a count to the
escape) and the longer context's symbols are excluded.  Only symbols that were seen after a context are
stored.  A symbol found at the longest known context has probability (2c - 1) / 2N.  After an escape from
context x its suffix is read without the symbols seen after x, so what x's suffix has left (rn symbols
counted, rd distinct) is a number of x alone, kept with x.

Method C gives the escape a whole count for each distinct symbol: a symbol has c / (N + d) there, d the distinct ones.

Texts begin with ``BOS`` bytes and end with ``EOS``.  A window of ``order + 1`` bytes is one unsigned
64-bit key, so the order is 6 at most.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .runtime import ship

BOS, EOS = 0xFE, 0xFF
#: Size of the alphabet that a symbol never seen at all is drawn from: all bytes and the end.
ALPHABET = 257
MOST_ORDER = 6
#: Contexts of higher orders are told apart by the last two bytes, of these orders there are 2**16 windows at most.
LOW = 1
PIECE = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each between its marks, and where each begins."""
    head, tail = bytes([BOS]) * order, bytes([EOS])
    whole = b"".join([head + t + tail for t in texts])
    starts = np.zeros(len(texts), np.int64)
    if texts:
        np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))[:-1] + order + 1, out=starts[1:])
    return np.frombuffer(whole, np.uint8), starts


def windows(part: np.ndarray, order: int) -> np.ndarray:
    """Keys of all windows of order + 1 bytes."""
    a = part.astype(np.uint64)
    n = len(a) - order
    key = a[:n].copy()
    for j in range(1, order + 1):
        key <<= np.uint64(8)
        key |= a[j : j + n]
    return key


def grams(whole: np.ndarray, order: int, piece: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows that end in a symbol, and their counts."""
    keys, counts = [], []
    for at in range(0, max(0, len(whole) - order), piece):
        part = whole[at : at + piece + order]
        k = np.sort(windows(part, order)[part[order:] != BOS])
        first = np.nonzero(np.concatenate(([True], k[1:] != k[:-1])))[0] if len(k) else np.zeros(0, np.int64)
        keys.append(k[first])
        counts.append(np.diff(np.append(first, len(k))))
    return summed(keys, counts)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(k, kind="stable")
    k, n = k[by], n[by]
    first = np.nonzero(np.concatenate(([True], k[1:] != k[:-1])))[0] if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(first) else n


class Lookup:
    """Keys in the order of a multiplicative hash, with the bounds of its buckets."""

    def __init__(self, keys: np.ndarray) -> None:
        """``order``: how values have to be arranged to fit the positions that are found."""
        bits = max(1, int(len(keys) * 2 - 1).bit_length()) if len(keys) else 1
        self.shift = np.uint64(64 - bits)
        bucket = ((keys * _MIX) >> self.shift).astype(np.int32)
        self.order = np.argsort(bucket, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.start = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount(bucket, minlength=1 << bits), out=self.start[1:])

    def state(self) -> tuple:
        return self.shift, self.keys, self.start

    @classmethod
    def of(cls, state: tuple) -> Lookup:
        new = cls.__new__(cls)
        new.shift, new.keys, new.start = state
        return new

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int32)
        bucket = ((keys * _MIX) >> self.shift).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        open_ = np.nonzero(at < end)[0]
        at = at[open_]
        while len(open_):
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = at[hit]
            at = at[~hit] + 1
            open_ = open_[~hit]
            more = at < end[open_]
            at, open_ = at[more], open_[more]
        return out


class Trie:
    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray] | None = None, method: str = "D") -> None:
        """``keys``: distinct windows of order + 1 bytes, with their counts.

        They may be only those of some pairs of bytes before the symbol; ``low`` then has all windows of order ``LOW``.
        """
        self.order = order
        by = np.argsort(keys)
        k, n = keys[by].astype(np.uint64, copy=False), counts[by].astype(np.float64)
        del by
        levels = {order: (k, n)}
        for o in range(order - 1, -1, -1):
            if low is not None and o == LOW:
                by = np.argsort(low[0])
                k, n = low[0][by].astype(np.uint64, copy=False), low[1][by].astype(np.float64)
            else:
                k, n = summed([k & np.uint64((1 << (8 * (o + 1))) - 1)], [n])
            levels[o] = (k, n)
        self.levels = []
        above = None
        for o in range(order + 1):
            k, n = levels[o]
            context = k >> np.uint64(8)
            first = np.nonzero(np.concatenate(([True], context[1:] != context[:-1])))[0] if len(k) else np.zeros(0, np.int64)
            total = np.add.reduceat(n, first) if len(first) else n
            distinct = np.diff(np.append(first, len(k))).astype(np.float64)
            own = np.repeat(np.arange(len(first), dtype=np.int32), distinct.astype(np.int64))
            if o == 0:
                rn, rd = np.zeros(len(first)), ALPHABET - distinct
            else:
                pk, pn, pc, ptotal, pdistinct = above
                up = np.searchsorted(pk, k & np.uint64((1 << (8 * o)) - 1))
                parent = pc[up[first]] if len(first) else np.zeros(0, np.int64)
                rn = ptotal[parent] - (np.add.reduceat(pn[up], first) if len(first) else 0.0)
                rd = pdistinct[parent] - distinct
            pairs, contexts = Lookup(k), Lookup(context[first])
            count, whole, rest = (2 * n - 1, 2 * total, 2 * rn) if method == "D" else (n, total + distinct, rn + rd)
            kept = {
                "first": (pairs, np.log10(count / whole[own])), "count": (pairs, np.log10(count)), "escape": (contexts, np.log10(distinct / whole)),
                # of the suffix, without what was seen here; where nothing is left the step is free
                "left": (contexts, np.where(rd > 0, np.log10(np.maximum(rest, 1)), 0.0)),
                "again": (contexts, np.where(rd > 0, np.log10(np.maximum(rd, 1) / np.maximum(rest, 1)), 0.0)),
            }
            self.levels.append({name: values[at.order].astype(np.float32) for name, (at, values) in kept.items()} | {"pairs": Lookup.of(pairs.state()), "contexts": Lookup.of(contexts.state())})
            del kept, pairs, contexts, context
            levels[o] = None
            above = (k, n, own, total, distinct)
        self.unseen = -np.log10(max(1.0, ALPHABET - len(self.levels[0]["first"])))

    def state(self) -> tuple:
        """Plain arrays, for a broadcast that needs no code of this package to be read."""
        plain = [{k: v.state() if isinstance(v, Lookup) else v for k, v in level.items()} for level in self.levels]
        return self.order, self.unseen, plain

    @classmethod
    def of(cls, state: tuple) -> Trie:
        new = cls.__new__(cls)
        new.order, new.unseen, levels = state
        new.levels = [{k: Lookup.of(v) if isinstance(v, tuple) else v for k, v in level.items()} for level in levels]
        return new

    def values(self, part: np.ndarray) -> np.ndarray:
        """log10 probability of each byte of ``part`` from the ``order``-th on; marks cost nothing."""
        keys = windows(part, self.order)
        out = np.zeros(len(keys))
        real = part[self.order :] != BOS
        out[real] = self.of_windows(keys[real])
        return out

    def of_windows(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each window."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        left, again = np.zeros(len(todo), np.float32), np.zeros(len(todo), np.float32)
        known = np.zeros(len(todo), bool)
        for o in range(self.order, -1, -1):
            if not len(todo):
                break
            level = self.levels[o]
            key = keys[todo] & np.uint64((1 << (8 * (o + 1))) - 1)
            pair = level["pairs"].find(key)
            hit = pair >= 0
            p = pair[hit]
            out[todo[hit]] += np.where(known[hit], level["count"][p] - left[hit], level["first"][p])
            miss = ~hit
            todo, left, again, known, key = todo[miss], left[miss], again[miss], known[miss], key[miss]
            context = level["contexts"].find(key >> np.uint64(8))
            inside = context >= 0
            c = context[inside]
            out[todo[inside]] += np.where(known[inside], again[inside], level["escape"][c])
            left[inside], again[inside] = level["left"][c], level["again"][c]
            known |= inside
        if len(todo):
            out[todo] += self.unseen if len(self.levels[0]["first"]) else -np.log10(ALPHABET)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included."""
        return totals(self.values, *joined(texts, self.order), self.order)


def totals(values_of: Callable[[np.ndarray], np.ndarray], whole: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """The sums of the values of each text's bytes."""
    out = np.zeros(len(starts))
    for at in range(0, max(0, len(whole) - order), PIECE):
        to = min(at + PIECE, len(whole) - order)
        values = values_of(whole[at : to + order])
        i, j = int(np.searchsorted(starts, at, side="right")) - 1, int(np.searchsorted(starts, to))
        out[i:j] += np.add.reduceat(values, np.maximum(starts[i:j], at) - at)
    return out


ship(__name__)
