"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the test items' windows of ``window`` words. Blocks of two
words hash into a shift table; a text's window is moved on by the shift of its
last block, which skips positions where no pattern can end. Where the shift is
zero, the suffix block's bucket selects the patterns with the window's hash,
and their words are compared one by one. Shorter items are one pattern each
and are searched by their own length in the same way.

Patterns are the only thing sent to the tasks, in blocks of items with at most
``block_bytes`` of text: the item table's size is measured, and a larger one is
searched block by block, each pass adding to the columns of the pass before.

The tables take some 45 bytes per word of the items, so a full block some 150 MB.

Edge cases: null texts and items have no words and match nothing; a repeated
item_id counts once, a null one is the id None; an empty table of documents gives an
empty table; repeated documents are searched separately; an empty
benchmark leaves all documents clean. A very long text is read as a whole, in
one task. Columns of documents are read by name, extra ones never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ledgerlake.llm.common import (Words, byte_set, chunks, fresh, materialize, mix, prepare,
                                   text_bytes)

WINDOW = 10
BLOCK_BYTES = 16 << 20
CHUNK = 2 << 20
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, a-z, all beyond ASCII.
WORD_BYTES = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Items:
    """The words of some test items: one buffer, and where each word lies in it."""

    def __init__(self, rows: list[tuple]):
        self.ids = [str(item) for item, _ in rows]
        texts = [(text or "").encode() for _, text in rows]
        raw, start, end, hashes, count, at = [], [], [], [], [], 0
        for lo, hi in chunks(texts, CHUNK):
            w = Words(texts[lo:hi], WORD_BYTES)
            raw.append(w.raw.lower())
            start.append(w.start + at)
            end.append(w.end + at)
            hashes.append(w.hash)
            count.append(np.diff(w.first))
            at += len(w.raw)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.raw = b"".join(raw)
        self.start, self.end = join(start, np.int64), join(end, np.int64)
        self.hash, self.count = join(hashes, np.uint64), join(count, np.int64)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


class Patterns:
    """The tables for the items' windows of one length in words.

    A window is its first word's number and its item: 20 bytes beside the items' words.
    """

    def __init__(self, length: int, items: Items, at: np.ndarray, item: np.ndarray):
        self.length, self.block, self.items = length, min(2, length), items
        h = items.hash
        self.bits = np.uint64(64 - min(22, max(12, int(8 * len(at) * length).bit_length())))
        top = length - self.block + 1
        self.shift = np.full(1 << int(64 - int(self.bits)), top, np.uint8)
        for j in range(top):  # block that ends at word j + block - 1
            np.minimum.at(self.shift, self.end_slot(h, at + j + self.block - 1),
                          np.uint8(min(255, top - 1 - j)))
        # suffix buckets: windows sorted by the hash of all their words
        whole = self.whole(h, at)
        order = np.argsort(whole, kind="stable")
        self.sorted, self.at, self.item = whole[order], at[order], item[order]

    def end_slot(self, h: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.block == 2:
            return mix(h[end - 1] * _STEP + h[end]) >> self.bits
        return mix(h[end]) >> self.bits

    def whole(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for k in range(self.length):
            out = mix(out * _STEP + h[at + k])
        return out

    def search(self, w: Words) -> Iterator[tuple[int, set[str]]]:
        """(first word, ids of the items) of each occurrence; no window spans two texts."""
        n = np.diff(w.first)
        lanes = []
        for lo, count in zip(w.first[:-1][n >= self.length], n[n >= self.length]):
            lanes.append(np.arange(lo + self.length - 1, lo + count, 64))
        if not lanes:
            return
        pos = np.concatenate(lanes)
        text = np.searchsorted(w.first, pos, side="right") - 1
        stop = np.minimum(pos + 64, w.first[text + 1])
        ends = []
        while len(pos):
            s = self.shift[self.end_slot(w.hash, pos)]
            ends.append(pos[s == 0])
            pos = pos + np.maximum(s, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        at = np.concatenate(ends) - (self.length - 1)
        key = self.whole(w.hash, at)
        lo = np.searchsorted(self.sorted, key, side="left")
        hi = np.searchsorted(self.sorted, key, side="right")
        items, words = self.items, range(self.length)
        for i in np.flatnonzero(lo < hi):
            own = [w.word(at[i] + k) for k in words]
            found = {items.ids[self.item[p]] for p in range(lo[i], hi[i])
                     if all(items.word(self.at[p] + k) == own[k] for k in words)}
            if found:
                yield int(at[i]), found


def build(rows: list[tuple], window: int = WINDOW) -> list[Patterns]:
    """Tables by length from (item_id, text) rows."""
    items = Items(rows)
    n = items.count
    first = np.cumsum(n) - n
    length = np.minimum(n, window)
    out = []
    for m in np.unique(length[length > 0]).tolist():
        own = np.flatnonzero(length == m)
        windows = n[own] - m + 1
        item = np.repeat(own, windows)
        at = np.repeat(first[own] - (np.cumsum(windows) - windows), windows) \
            + np.arange(len(item))
        out.append(Patterns(m, items, at, item.astype(np.int32)))
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_bytes`` of text, each collected on its own."""
    b = benchmark.select("item_id", "text")
    size = b.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in b.where(part == k).collect()]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, spans (word ranges lo..hi, hi excluded, merged) and items (sorted ids).

    Where docs has such a name, the added column is named by ``common.fresh``.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = [fresh(docs.columns, c) for c in ("n_words", "spans", "items")]
    span = ArrayType(StructType([StructField("lo", IntegerType()), StructField("hi", IntegerType())]))
    added = [LongType(), span, ArrayType(StringType())]
    schema = StructType([*docs.schema.fields, *map(StructField, names, added)])
    text = docs.columns.index("text")
    out = docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(names, added)])
    for k, items in enumerate(item_blocks(benchmark, block_bytes)):
        if k:
            out = materialize(out, "decontam")
        sent = spark.sparkContext.broadcast(build(items, window))
        out = out.mapInArrow(_searcher(sent, text), schema)
    return out


def _searcher(sent, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        for b in batches:
            texts = text_bytes(b.column(text))
            before, items_before = b.column(-2).to_pylist(), b.column(-1).to_pylist()
            counts, spans, items = [], [], []
            for lo, hi in chunks(texts, CHUNK):
                w = Words(texts[lo:hi], WORD_BYTES)
                counts += np.diff(w.first).tolist()
                hit: dict[int, list[tuple[int, int]]] = {}
                ids: dict[int, set[str]] = {}
                for t in tables:
                    for at, found in t.search(w):
                        i = int(np.searchsorted(w.first, at, side="right")) - 1
                        at -= int(w.first[i])
                        hit.setdefault(i, []).append((at, at + t.length))
                        ids.setdefault(i, set()).update(found)
                for i in range(hi - lo):
                    old = [(s["lo"], s["hi"]) for s in before[lo + i] or []]
                    spans.append(_merged(old + hit.get(i, [])))
                    items.append(sorted(ids.get(i, set()) | set(items_before[lo + i] or [])))
            new = [pa.array(v, f.type) for v, f in zip((counts, spans, items), list(b.schema)[-3:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:-3], *new], schema=b.schema)
    return run


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1]["hi"]:
            out[-1]["hi"] = max(hi, out[-1]["hi"])
        else:
            out.append({"lo": lo, "hi": hi})
    return out
