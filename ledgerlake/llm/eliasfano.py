"""Elias-Fano sequences and a two-level n-gram trie over them, in memory-mapped files."""

from __future__ import annotations

import os
import tempfile

import numpy as np

LEVELS = 255


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Each value's low ``width`` bits, one after the other; eight spare bytes at the end."""
    if not width:
        return np.zeros(8, np.uint8)
    out = []
    for lo in range(0, len(values), 1 << 19):  # a multiple of eight: parts end on bytes
        v = values[lo:lo + (1 << 19)].astype("<u8")
        bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.reshape(-1), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


def _unpacked(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64) * width
    byte = bit >> 3
    out = np.zeros(len(at), np.uint64)
    for k in range((width + 14) // 8):
        out |= packed[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return (out >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class EliasFano:
    """A sorted sequence: low bits packed, high bits in unary (a one per value, a zero per bucket)."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self._starts: np.ndarray | None = None
        self._ones: np.ndarray | None = None

    @staticmethod
    def arrays(values: np.ndarray, universe: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(width of the low bits, low, high) of sorted values below ``universe``."""
        n = len(values)
        width = min(48, max(0, (universe // max(1, n)).bit_length() - 1))
        h = (values >> np.uint64(width)).astype(np.int64)
        buckets = (universe >> width) + 1
        bits = np.zeros(n + buckets, np.uint8)
        bits[h + np.arange(n)] = 1
        return width, _packed(values, width), np.packbits(bits, bitorder="little")

    def starts(self) -> np.ndarray:
        """Where each bucket's values begin: select over the zeros, for a batch of queries."""
        if self._starts is None:
            bits = np.unpackbits(np.asarray(self.high), bitorder="little")
            zeros = np.flatnonzero(bits == 0)
            self._starts = np.concatenate([[0], np.minimum(
                zeros - np.arange(len(zeros)), self.n)]).astype(np.int64)
        return self._starts

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each x in the sequence, -1 where it is absent."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        s = self.starts()
        h = (x >> np.uint64(self.width)).astype(np.int64)
        mask = np.uint64((1 << self.width) - 1)
        inside = np.flatnonzero(h < len(s) - 1)
        at, end, low = s[h[inside]], s[h[inside] + 1], x[inside] & mask
        # A frequent context's successors fill whole buckets: halve them, do not walk.
        lo, hi = at.copy(), end.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            less = _unpacked(self.low, self.width, mid) < low[todo]
            lo[todo[less]] = mid[less] + 1
            hi[todo[~less]] = mid[~less]
            todo = todo[lo[todo] < hi[todo]]
        own = np.flatnonzero(lo < end)
        hit = own[_unpacked(self.low, self.width, lo[own]) == low[own]]
        out[inside[hit]] = lo[hit]
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at these places: select over the ones, for a batch of queries."""
        if self._ones is None:
            self._ones = np.flatnonzero(np.unpackbits(np.asarray(self.high), bitorder="little"))
        h = (self._ones[i] - i).astype(np.uint64)
        return (h << np.uint64(self.width)) | _unpacked(self.low, self.width, i)

    def between(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The place of each x among the values at places lo to hi (excluded), -1 if absent."""
        out, lo, last = np.full(len(x), -1, np.int64), lo.copy(), hi
        hi = hi.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):  # halved: a frequent context has very many successors
            mid = (lo[todo] + hi[todo]) >> 1
            less = self.at(mid) < x[todo]
            lo[todo[less]] = mid[less] + 1
            hi[todo[~less]] = mid[~less]
            todo = todo[lo[todo] < hi[todo]]
        own = np.flatnonzero(lo < last)
        hit = own[self.at(lo[own]) == x[own]]
        out[hit] = lo[hit]
        return out

    def values(self) -> np.ndarray:
        bits = np.unpackbits(np.asarray(self.high), bitorder="little")
        h = (np.flatnonzero(bits)[:self.n] - np.arange(self.n)).astype(np.uint64)
        return (h << np.uint64(self.width)) | _unpacked(self.low, self.width, np.arange(self.n))


class Trie:
    """Contexts, their successors, and the quantised log10 probabilities of those.

    Level one: the contexts' hashes. Pointers: where each context's successors begin and the
    one before it ends. Level two: successor numbers relative to their context, one monotone
    sequence as each context adds its own base. A bigram is found by its context's
    place in level one, the two pointers there, and a search of the successors between them.
    All arrays lie in one file that is mapped, not read.
    """

    def __init__(self, contexts: np.ndarray, degree: np.ndarray, successors: np.ndarray,
                 log_prob: np.ndarray):
        """contexts ascending; successors grouped by context, ascending in each."""
        self.words = np.unique(successors)
        word = np.searchsorted(self.words, successors).astype(np.uint64)
        owner = np.repeat(np.arange(len(contexts), dtype=np.uint64), degree)
        self.width = np.uint64(max(1, len(self.words)))
        pointers = np.concatenate([[0], np.cumsum(degree)]).astype(np.uint64)
        edges = np.unique(np.quantile(log_prob, np.linspace(0, 1, LEVELS + 1)[1:-1])) \
            if len(log_prob) else np.zeros(0)
        code = np.searchsorted(edges, log_prob, side="left")
        n = np.bincount(code, minlength=LEVELS)
        self.codebook = np.bincount(code, log_prob, LEVELS) / np.maximum(n, 1)
        parts: list[np.ndarray] = []
        shape = []
        for values, universe in ((contexts, 1 << 64), (pointers, int(pointers[-1]) + 1),
                                 (owner * self.width + word, len(contexts) * int(self.width) + 1)):
            width, low, high = EliasFano.arrays(values, universe)
            shape.append((len(values), width, len(low), len(high)))
            parts += [low, high]
        parts.append(code.astype(np.uint8))
        handle, self.path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as f:
            for p in parts:
                f.write(p.tobytes())
        self.map = np.memmap(self.path, np.uint8, "r")
        os.unlink(self.path)  # the map keeps it: a task that fails leaves no file
        at, levels = 0, []
        for count, width, low, high in shape:
            levels.append(EliasFano(count, width, self.map[at:at + low],
                                    self.map[at + low:at + low + high]))
            at += low + high
        self.contexts, self.pointers, self.successors = levels
        self.codes = self.map[at:]

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """1 + the probability's code for each (context, word), 0 where it is absent."""
        c = self.contexts.find(context)
        w = np.searchsorted(self.words, word)
        w[w == len(self.words)] = 0
        known = (c >= 0) & (self.words[w] == word if len(self.words) else False)
        out = np.zeros(len(context), np.int64)
        own = c[known]
        begin, end = (self.pointers.at(own + k).astype(np.int64) for k in (0, 1))
        x = own.astype(np.uint64) * self.width + w[known].astype(np.uint64)
        at = self.successors.between(x, begin, end)
        out[known] = np.where(at >= 0, self.codes[np.maximum(at, 0)].astype(np.int64) + 1, 0) \
            if len(self.codes) else 0
        return out

    def close(self) -> None:
        del self.map, self.codes
