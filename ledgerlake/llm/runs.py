"""Periodic runs of words, found by recompression.

A text's words are a sequence of symbols. Recompression shortens it level by
level: block compression turns each maximal repetition of a symbol into one
symbol, pair compression splits the alphabet in two halves and turns each pair
(left, right) into one. The levels are a run-length grammar: equal stretches
get equal symbols but for a bounded number at their ends on each level. How far
two positions agree (LCE) is read off the grammar: climb while both positions
begin the same symbols, step over at most a pair or a block where they do not,
and at the first difference walk down again. The mirrored grammar answers
backward. All queries of a chunk climb together in array operations, and levels
are made only while some query still climbs.

A run of period p and at least 4p words holds a position i, a multiple of 3p,
with i and i + p both inside. These grids, harmonic over all p, are the
candidates: n/3 * ln n of a text of n words. One with unequal words there is
out; for the others forward and backward LCE give the exact ends. The stretch
is a run if it is long enough; of equal stretches the least period counts
(by Fine and Wilf any smaller period divides the found one and leaves the same
stretch, so it is found on a grid of its own).

``collapsed`` keeps of every run its first period only.

Edge cases: null, empty and blank texts have no word and no run and collapse to
the empty text; texts are independent of each other, so equal and repeated rows
get equal results; ties of the strongest run go to the smallest start, then
period; an empty table gives an empty table. A text is held by one task as a
whole, with memory in proportion to its words; candidates are drawn in slabs of
bounded size. Added columns are named by ``common.fresh`` where docs has such a
name already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType)

from ledgerlake.llm.common import chunks, fresh, prepare, text_bytes

LEAST_WORDS, LEAST_PERIODS = 6, 4
CHUNK = 1 << 20
# Candidates looked at together; bounds a task's memory, not what is found.
SLAB = 1 << 20

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


@dataclass
class Level:
    """One level's symbols and how the next level groups them (once that is made)."""
    sym: np.ndarray
    # of the next level: whether a symbol is a group's first, its group, groups' first symbols
    head: np.ndarray | None = None
    parent: np.ndarray | None = None
    child: np.ndarray | None = None
    block: bool = False

    def mirrored(self) -> "Level":
        if self.head is None:
            return Level(self.sym[::-1])
        n, groups = len(self.sym), len(self.child)
        tail = np.append(self.head[1:], True)
        last = np.append(self.child[1:], n) - 1
        return Level(self.sym[::-1], tail[::-1], (groups - 1) - self.parent[::-1],
                     (n - 1) - last[::-1], self.block)

    def size(self, group: np.ndarray) -> np.ndarray:
        """How many symbols these groups hold."""
        end = np.full(len(group), len(self.sym))
        inner = group + 1 < len(self.child)
        end[inner] = self.child[group[inner] + 1]
        return end - self.child[group]


class Grammar:
    """Levels of block and pair compression of one sequence, made on demand."""

    def __init__(self, sym: np.ndarray):
        self.levels = [Level(sym)]
        self.mirror = [self.levels[0].mirrored()]
        self.symbols = int(sym.max()) + 1 if len(sym) else 0

    def grow(self) -> bool:
        """Make the next level; False where one symbol is left."""
        top = self.levels[-1]
        if len(top.sym) < 2:
            return False
        if len(self.levels) % 2 == 0 or not self._blocks(top):
            while not self._pairs(top):
                pass
        self.mirror[-1] = top.mirrored()
        self.mirror.append(self.levels[-1].mirrored())
        return True

    def _link(self, level: Level, head: np.ndarray, key: np.ndarray, many: np.ndarray,
              block: bool) -> None:
        level.head, level.block = head, block
        level.child = np.flatnonzero(head)
        level.parent = np.cumsum(head) - 1
        sym = level.sym[level.child].copy()
        names, inverse = np.unique(key, return_inverse=True)
        sym[many] = self.symbols + inverse
        self.symbols += len(names)
        self.levels.append(Level(sym))

    def _blocks(self, level: Level) -> bool:
        s = level.sym
        head = np.append(True, s[1:] != s[:-1])
        if head.all():
            return False
        child = np.flatnonzero(head)
        size = np.diff(np.append(child, len(s)))
        many = np.flatnonzero(size > 1)
        self._link(level, head, (s[child[many]] << 32) | size[many], many, True)
        return True

    def _pairs(self, level: Level) -> bool:
        """Symbols are left or right by a hash that differs by level and try."""
        s = level.sym
        self.tries = getattr(self, "tries", 0) + 1
        salt = np.uint64(0x9E3779B97F4A7C15 * (2 * self.tries + 1) % 2**64)
        x = (s.astype(np.uint64) + np.uint64(1)) * salt
        left = ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 1
        first = np.flatnonzero(left[:-1] & ~left[1:])
        if not len(first):
            return False
        head = np.ones(len(s), bool)
        head[first + 1] = False
        many = (np.cumsum(head) - 1)[first]
        self._link(level, head, (s[first] << 32) | s[first + 1], many, False)
        return True

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that agree from positions a and b on (a != b)."""
        return self._lce(self.levels, a, b)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that agree before positions a and b."""
        n = len(self.levels[0].sym)
        return self._lce(self.mirror, n - a, n - b)

    def _lce(self, levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The sequence ends (and, mirrored, begins) with a symbol that occurs once, so two
        different positions differ before either runs out."""
        out = np.empty(len(a), np.int64)
        parked: list[list[tuple]] = []
        q, j, k = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        at = 0
        while len(q):
            if at + 1 == len(levels):
                self.grow()
            level = levels[at]
            parked.append([])
            up: list[tuple] = []
            while len(q):
                same = level.sym[j] == level.sym[k]
                parked[at].append((q[~same], j[~same], k[~same]))
                q, j, k = q[same], j[same], k[same]
                if level.head is None:  # one symbol is left: positions cannot both be on it
                    j, k = j + 1, k + 1
                    continue
                both = level.head[j] & level.head[k]
                up.append((q[both], level.parent[j[both]], level.parent[k[both]]))
                q, j, k = q[~both], j[~both], k[~both]
                if level.block:
                    gj, gk = level.parent[j], level.parent[k]
                    left_j = level.child[gj] + level.size(gj) - j
                    left_k = level.child[gk] + level.size(gk) - k
                    step = np.minimum(left_j, left_k)
                else:
                    step = 1
                j, k = j + step, k + step
            q, j, k = (np.concatenate(x) for x in zip(*up)) if up else (q, j, k)
            at += 1
        for at in range(len(parked) - 1, -1, -1):
            q, j, k = (np.concatenate(x) for x in zip(*parked[at]))
            if not at:
                out[q] = j - a[q]
                break
            below = levels[at - 1]
            c, d = below.child[j], below.child[k]
            same = np.flatnonzero(below.sym[c] == below.sym[d])
            if below.block:
                step = np.minimum(below.size(j[same]), below.size(k[same]))
            else:
                step = 1
            c[same] += step
            d[same] += step
            parked[at - 1].append((q, c, d))
        return out


def find_runs(texts: list[list[bytes]], least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words) its runs (start, length, period), by start, then period."""
    ids: dict[bytes, int] = {}
    seq: list[int] = []
    begin = []
    for t in texts:
        seq.append(-1)
        begin.append(len(seq))
        seq.extend([ids.setdefault(w, len(ids)) for w in t])
    seq.append(-1)
    sym = np.array(seq, np.int64)
    del seq
    cut = np.flatnonzero(sym < 0)
    sym[cut] = len(ids) + np.arange(len(cut))  # between texts: symbols that occur once
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    first = np.array(begin, np.int64)
    n = np.array([len(t) for t in texts], np.int64)
    periods = n // least_periods
    grid = least_periods - 1
    grammar = None
    for text, p in _rows(periods):
        count = -(-(n[text] - p) // (grid * p))
        for lo, hi in _slabs(count):
            c = count[lo:hi]
            row = np.repeat(np.arange(lo, hi), c)
            step = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
            own, period = text[row], p[row]
            i = first[own] + step * (grid * period)
            hit = sym[i] == sym[i + period]
            own, period, i = own[hit], period[hit], i[hit]
            if not len(i):
                continue
            grammar = grammar or Grammar(sym)
            f = grammar.forward(i, i + period)
            b = grammar.backward(i, i + period)
            length = f + b + period
            run = length >= np.maximum(least_words, least_periods * period)
            for t, s, m, q in zip(own[run].tolist(), (i - b)[run].tolist(),
                                  length[run].tolist(), period[run].tolist()):
                at = (s - begin[t], m)
                if found[t].get(at, q) >= q:
                    found[t][at] = q
    return [sorted(((s, m, q) for (s, m), q in f.items()), key=lambda r: (r[0], r[2]))
            for f in found]


def _rows(periods: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, period) pairs, about SLAB of them at a time."""
    lo = 0
    ends = np.cumsum(periods)
    while lo < len(periods):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLAB)))
        m = periods[lo:hi]
        text = np.repeat(np.arange(lo, lo + len(m)), m)
        yield text, np.arange(len(text)) - np.repeat(np.cumsum(m) - m, m) + 1
        lo = lo + len(m)


def _slabs(count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLAB candidates together."""
    ends, lo = np.cumsum(count), 0
    while lo < len(count):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLAB)))
        yield lo, min(hi, len(count))
        lo = hi


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length/period, then smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those of any run beyond its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    s, m, q = np.array(runs, np.int64).T
    np.add.at(depth, s + q, 1)
    np.add.at(depth, s + m, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def word_runs(docs: DataFrame, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> DataFrame:
    """docs with n_words, runs (array of start, length, period), best (one of them or null)
    and collapsed (text: the kept words joined by one blank)."""
    prepare(docs.sparkSession)
    names = [fresh(docs.columns, c) for c in ("n_words", "runs", "best", "collapsed")]
    schema = StructType([*docs.schema.fields, *map(StructField, names, (
        LongType(), ArrayType(RUN), RUN, StringType()))])
    at = docs.columns.index("text")
    run_type = pa.struct([(c, pa.int64()) for c in RUN.names])
    types = [pa.int64(), pa.list_(run_type), run_type, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new: list[list] = [[], [], [], []]
            texts = text_bytes(b.column(at))
            for lo, hi in chunks(texts, CHUNK):
                words = [t.split() for t in texts[lo:hi]]
                for w, found in zip(words, find_runs(words, least_words, least_periods)):
                    best = strongest(found)
                    new[0].append(len(w))
                    new[1].append([dict(zip(RUN.names, r)) for r in found])
                    new[2].append(best and dict(zip(RUN.names, best)))
                    new[3].append(b" ".join(collapse(w, found)).decode())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(v, t) for v, t in zip(new, types)]],
                names=[*b.schema.names, *names])

    return docs.mapInArrow(run, schema)
