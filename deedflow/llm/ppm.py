"""Prediction by partial matching over bytes with frozen statistics.

The order is ``ORDER`` for any number of languages.  Tries of byte contexts whose tables have ``CELLS`` cells at most are kept as one table: a row for each context that was seen, a
column for each symbol.  More or larger ones are kept as sparse tries (``Tries``), which hold only what was seen
and give the same code lengths.  Escapes follow method C (an escape counts as often as there are distinct symbols)
and symbols of the longer context are excluded from the shorter one, so every row is a whole distribution,
worked out once.  Because every suffix of a seen context was seen with at least the same symbols, what is
excluded at one step is exactly what the context before had; each row follows from its parent's.

Scoring a text is then two table look-ups a byte, done for whole batches in numpy.  Texts begin with
``BOS`` bytes and end with one ``EOS`` symbol; neither byte occurs in UTF-8.
"""

from __future__ import annotations

import numpy as np

from . import trie
from .runtime import ship
from .trie import ALPHABET, BOS, EOS

ORDER = 3
#: Cells (contexts x symbols x models) of a table at most; 2**24 four-byte floats are 64 MiB.
CELLS = 1 << 24
PIECE = 1 << 19
#: Distinct windows of so many bytes of text are looked up together in sparse tries.
SPAN = 1 << 22


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each between its marks, and where each begins."""
    head, tail = bytes([BOS]) * ORDER, bytes([EOS])
    whole = b"".join([head + t + tail for t in texts])
    starts = np.zeros(len(texts), np.int64)
    if texts:
        np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))[:-1] + ORDER + 1, out=starts[1:])
    return np.frombuffer(whole, np.uint8), starts


def grams(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of ORDER + 1 bytes that end in a symbol, and their counts."""
    keys, counts = [], []
    for at in range(0, max(0, len(whole) - ORDER), PIECE * 8):
        a = whole[at : at + PIECE * 8 + ORDER].astype(np.uint32)
        key = (a[:-3] << np.uint32(24)) | (a[1:-2] << np.uint32(16)) | (a[2:-1] << np.uint32(8)) | a[3:]
        k, n = np.unique(key[a[3:] != BOS], return_counts=True)
        keys.append(k)
        counts.append(n)
    return summed(keys, counts)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, weights=np.concatenate(counts), minlength=len(k)).astype(np.int64)


class Model:
    """Tables of one or more tries over a common set of contexts.

    ``symbol``: byte to column; ``context``: number of three columns to row; ``table``: log10 probability by
    row, column and trie.
    """

    def __init__(self, tries: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> None:
        keys = [k.astype(np.uint32) for k, _ in tries]
        every = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint32)
        seen = np.unique(np.concatenate([(every >> np.uint32(8 * i)) & np.uint32(255) for i in range(4)]))
        self.symbol = np.full(256, len(seen), np.int64)  # the last column stands for one symbol never seen
        self.symbol[seen] = np.arange(len(seen))
        self.width = len(seen) + 1
        a = self.width
        col = [self.symbol[(every >> np.uint32(8 * i)) & np.uint32(255)] for i in (3, 2, 1, 0)]
        path = [np.zeros(len(every), np.int64), col[2], col[1] * a + col[2], (col[0] * a + col[1]) * a + col[2]]
        self.order = order
        # rows: the root, then the contexts of each order
        ids = [np.zeros(1, np.int64)] + [np.unique(p) for p in path[1 : order + 1]]
        first = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
        self.context = np.zeros(a**3, np.int32)
        cube = self.context.reshape(a, a, a)
        if order >= 1:
            cube[:, :, ids[1]] = first[1] + np.arange(len(ids[1]))
        if order >= 2:
            cube.reshape(a, a * a)[:, ids[2]] = first[2] + np.arange(len(ids[2]))
        if order >= 3:
            self.context[ids[3]] = first[3] + np.arange(len(ids[3]))
        self.table = np.zeros((int(first[-1]), a, len(tries)), np.float32)
        for t, (k, n) in enumerate(tries):
            self._fill(t, k.astype(np.uint32), n.astype(np.float64), ids, first)
        bos = self.symbol[BOS]
        if bos < len(seen):
            self.table[:, bos, :] = 0.0  # marks are no symbols and cost nothing
        self.table = self.table.reshape(-1, len(tries))

    def state(self) -> tuple:
        """Plain arrays, for a broadcast that workers keep between tasks and can read without this code."""
        return "table", self.order, self.width, self.symbol, self.context, self.table

    @classmethod
    def of(cls, state: tuple) -> Model:
        new = cls.__new__(cls)
        _, new.order, new.width, new.symbol, new.context, new.table = state
        return new

    def _fill(self, t: int, keys: np.ndarray, counts: np.ndarray, ids: list[np.ndarray], first: np.ndarray) -> None:
        a = self.width
        col = [self.symbol[(keys >> np.uint32(8 * i)) & np.uint32(255)] for i in (3, 2, 1, 0)]
        path = [np.zeros(len(keys), np.int64), col[2], col[1] * a + col[2], (col[0] * a + col[1]) * a + col[2]]
        parents: np.ndarray | None = None
        probs: np.ndarray | None = None
        for k in range(self.order + 1):
            n = np.bincount(np.searchsorted(ids[k], path[k]) * a + col[3], weights=counts, minlength=len(ids[k]) * a).reshape(-1, a)
            p = np.empty((len(ids[k]), a), np.float64)
            up = np.zeros(len(ids[k]), np.int64) if k < 2 else np.searchsorted(ids[k - 1], ids[k] % a ** (k - 1))
            for at in range(0, len(n), 4096):
                rows = slice(at, at + 4096)
                c = n[rows]
                if k == 0:
                    p[rows] = _mixed(c, np.zeros_like(c), np.full_like(c, 1.0 / max(1, ALPHABET - (c > 0).sum())))
                else:
                    p[rows] = _mixed(c, parents[up[rows]], probs[up[rows]])
            self.table[first[k] : first[k + 1], :, t] = np.log10(p)
            parents, probs = n, p

    def values(self, whole: np.ndarray, at: int, to: int) -> np.ndarray:
        """log10 probabilities of the symbols at ``at + ORDER`` to ``to + ORDER``, a column for each trie."""
        s = self.symbol[whole[at : to + ORDER]]
        key = (s[:-3] * self.width + s[1:-2]) * self.width + s[2:-1]
        cell = self.context[key].astype(np.int64) * self.width + s[3:]
        return np.take(self.table, cell, axis=0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included, under each trie."""
        whole, starts = joined(texts)
        out = np.zeros((len(texts), self.table.shape[1]))
        for at in range(0, max(0, len(whole) - ORDER), PIECE):
            to = min(at + PIECE, len(whole) - ORDER)
            values = self.values(whole, at, to)
            i, j = int(np.searchsorted(starts, at, side="right")) - 1, int(np.searchsorted(starts, to))
            out[i:j] += np.add.reduceat(values, np.maximum(starts[i:j], at) - at, axis=0, dtype=np.float64)
        return out


class Tries:
    """One sparse trie for each language."""

    def __init__(self, tries: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> None:
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        self.order = order
        self.tries = [trie.Trie(*trie.summed([k.astype(np.uint32).astype(np.uint64) & mask], [n]), order, method="C") for k, n in tries]

    def state(self) -> tuple:
        return "tries", self.order, [t.state() for t in self.tries]

    @classmethod
    def of(cls, state: tuple) -> Tries:
        new = cls.__new__(cls)
        _, new.order, tries = state
        new.tries = [trie.Trie.of(t) for t in tries]
        return new

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included, under each trie."""
        whole, starts = trie.joined(texts, self.order)
        out = np.zeros((len(texts), len(self.tries)))
        for at in range(0, max(0, len(whole) - self.order), SPAN):
            to = min(at + SPAN, len(whole) - self.order)
            part = whole[at : to + self.order]
            real = part[self.order :] != BOS
            some, back = np.unique(trie.windows(part, self.order)[real], return_inverse=True)
            i, j = int(np.searchsorted(starts, at, side="right")) - 1, int(np.searchsorted(starts, to))
            for t, one in enumerate(self.tries):
                values = np.zeros(to - at)
                values[real] = one.of_windows(some)[back]
                out[i:j, t] += np.add.reduceat(values, np.maximum(starts[i:j], at) - at)
        return out


def cells(tries: list[tuple[np.ndarray, np.ndarray]]) -> int:
    """How many cells a table of all tries would have."""
    every = np.unique(np.concatenate([k.astype(np.uint32) for k, _ in tries]))
    symbols = len(np.unique(every.view(np.uint8))) + 1
    contexts = sum(len(np.unique((every >> np.uint32(8)) & np.uint32((1 << (8 * o)) - 1))) for o in range(1, ORDER + 1))
    return (contexts + 1) * symbols * len(tries)


def model_of(tries: list[tuple[np.ndarray, np.ndarray]], most: int = CELLS) -> Model | Tries:
    """The tries as a table if it has at most so many cells, else sparse."""
    return Model(tries) if cells(tries) <= most else Tries(tries)


def frozen(state: tuple) -> Model | Tries:
    return (Model if state[0] == "table" else Tries).of(state)


def _mixed(c: np.ndarray, parent: np.ndarray, parent_p: np.ndarray) -> np.ndarray:
    """Distributions of contexts with counts ``c``, from their parents' counts and distributions."""
    seen = c > 0
    n, d = c.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    # what the parent gives to symbols that it hasn't seen, without its own escape
    pn, pd = parent.sum(axis=1, keepdims=True), (parent > 0).sum(axis=1, keepdims=True)
    deeper = np.where(pd > 0, parent_p * (pn + pd) / np.maximum(pd, 1), parent_p)
    rest = np.where(seen, 0.0, parent)
    rn, rd = rest.sum(axis=1, keepdims=True), (rest > 0).sum(axis=1, keepdims=True)
    escape = np.where(rd > 0, rd / np.maximum(rn + rd, 1), 1.0)
    lower = np.where(parent > 0, parent / np.maximum(rn + rd, 1), escape * deeper)
    # a context of another trie only has no counts here: it is its parent
    own = np.where(seen, c / np.maximum(n + d, 1), d / np.maximum(n + d, 1) * lower)
    return np.where(n > 0, own, parent_p)


ship(__name__)
