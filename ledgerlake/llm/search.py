"""Ranked lexical search: Block-Max MaxScore over sharded, compressed postings.

``build`` deals the documents, as they are read, into shards of about
``shard_bytes`` of text, ordered by doc_id in a shard. A term's list in a shard
is cut into blocks of ``BLOCK`` postings, each compressed by itself: gaps between
documents, then counts, in the fewest whole bytes. A block's head keeps its last document
and its skyline, the (count, document length) pairs that no other of the block
beats on both sides: the best contribution of the block is then exact under
whatever corpus averages, which are known only after all shards are built. Index
and document lengths are Parquet tables, a row per shard and term.

``search`` takes the queries in blocks of at most ``QUERY_TERMS`` (query, term)
pairs. A block's distinct terms select their lists by a join; document
frequencies are sums over the lists' own. Lists meet their shard in one task,
which answers all queries of the block on it: a query's lists are ordered by
their global bounds (term weight times the best contribution in the shard).
The lists whose bounds together stay below the threshold, the k-th best score so
far, are non-essential: documents only on them cannot enter. Essential lists are
read in ranges of documents; the non-essential ones are then met from the
greatest bound down, and a candidate whose score, the list's block maximum at
it and the bounds of the lists left stay below the threshold is rejected before
the block is decompressed. A task keeps its heaps over all shards that it meets,
so its threshold only grows; the heaps are merged by Spark (a ranked window,
which keeps k rows per query of a task before the shuffle).

A 64-bit hash stands for a term. Scores are integers, sums of which doubles
hold exactly below 2**53, so no order of adding changes a rank.

Edge cases: null texts and texts without a term are indexed with no term, and
count neither in N nor in L; a query of no term, or of terms that no document
holds, has no row; query rows of equal id are one query with the terms of all;
a null id is an id. Rows of equal doc_id are documents of their own. Equal
scores rank by doc_id, null last. Empty tables give an empty table. A very long
text is a shard of its own. Only id and text are read, so extra columns never
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import Words, byte_set, chunks, materialize, prepare, text_bytes

TOP = 10
BLOCK = 128
SHARD_BYTES = 16 << 20
CHUNK = 2 << 20
# Lists of one Arrow batch of the index.
LISTS = 5_000
# (query, term) pairs sent to the tasks at once: bounds the broadcast, not the queries.
QUERY_TERMS = 200_000
# Documents whose essential postings are added up together.
RANGE = 2048
# Shards that one task searches, keeping its heaps.
SHARDS_A_TASK = 4
# Terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ once A-Z are lower-cased.
TERM_BYTES = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
# Fixed values of the score: contribution (SCALE * tf) div (1000 * tf + 8 * m),
# m = 100 - 90 + ((90 * n * N) div L).
SCALE, SATURATION, FLAT, SLOPE = 1_000_000_000, 8, 10, 90


# ---- index ---------------------------------------------------------------------------

def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n of each text; document, term, count of each distinct pair, by term and document)."""
    lengths, doc, term, count = [], [], [], []
    for lo, hi in chunks(texts, CHUNK):
        w = Words(texts[lo:hi], TERM_BYTES)
        n = np.diff(w.first)
        lengths.append(n)
        d = np.repeat(np.arange(lo, hi), n)
        order = np.lexsort((d, w.hash))
        d, h = d[order], w.hash[order]
        new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))) \
            if len(d) else np.empty(0, np.int64)
        doc.append(d[new])
        term.append(h[new])
        count.append(np.diff(np.append(new, len(d))))
    if not doc:
        return (np.empty(0, np.int64),) * 4
    d, t, c = (np.concatenate(x) for x in (doc, term, count))
    order = np.lexsort((d, t))  # a document lies in one chunk: pairs are distinct
    return np.concatenate(lengths), d[order], t[order], c[order]


def pack(doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: np.ndarray) -> tuple:
    """All lists of a shard (postings by term, then document; n: document lengths).

    Gives (terms, postings of each, heads, skylines, bodies), the last three as binary columns.
    Heads: last document, body end, skyline end and byte widths of each block (int32).
    Skylines: count and document length (int32 pairs). A body: the gaps (from the block
    before, or -1), then the counts, each in the block's widths.
    """
    size = len(doc)
    at = np.arange(size)
    cut = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    sizes = np.diff(np.append(cut, size))
    inside = at - np.repeat(cut, sizes)
    starts = np.flatnonzero(inside % BLOCK == 0)
    n_in = np.diff(np.append(starts, size))
    block = np.repeat(np.arange(len(starts)), n_in)
    gap = np.where(inside == 0, doc + 1, np.diff(doc, prepend=0))
    a, b = (_widths(np.maximum.reduceat(x, starts)) for x in (gap, count))
    ends = np.cumsum(n_in * (a + b))
    begin = ends - n_in * (a + b)
    body = np.zeros(int(ends[-1]), np.uint8)
    pos = at - starts[block]
    for value, width, off in ((gap, a, begin), (count, b, begin + n_in * a)):
        w = width[block]
        to = off[block] + pos * w
        for k in range(4):
            own = w > k
            body[to[own] + k] = (value[own] >> (8 * k)) & 255
    # skyline: by length, a longer document must count more; block in the high bits
    order = np.lexsort((-count, n, block))
    key = (block[order] << 32) | count[order]
    most = np.maximum.accumulate(key)
    top = order[np.append(True, most[1:] > most[:-1])]
    sky_end = np.cumsum(np.bincount(block[top], minlength=len(starts)))
    sky = np.stack([count[top], n[top]], 1).astype("<i4")
    # ends are counted within each list
    lists = np.flatnonzero(inside[starts] == 0)
    blocks = np.diff(np.append(lists, len(starts)))
    first = np.repeat(lists, blocks)
    before = [np.append(0, x)[first] for x in (ends, sky_end)]
    heads = np.stack([doc[starts + n_in - 1], ends - before[0], sky_end - before[1],
                      a * 8 + b], 1).astype("<i4")
    last = lists + blocks - 1
    return (term[cut], sizes, _binary(heads, (last + 1) * heads.itemsize * 4),
            _binary(sky, sky_end[last] * sky.itemsize * 2), _binary(body, ends[last]))


def _widths(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of consecutive pieces of one array."""
    offsets = np.append(0, ends).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def unpack(body: bytes, widths: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, counts) of one block; ``before`` is the last document before it."""
    a, b = widths >> 3, widths & 7
    size = len(body) // (a + b)
    gap = np.frombuffer(body, f"<u{a}", size)
    return before + np.cumsum(gap, dtype=np.int64), \
        np.frombuffer(body, f"<u{b}", size, size * a).astype(np.int64)


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index: a row per shard (term null; ids and lengths of its documents, by id) and per
    shard and term (df, heads, skylines, bodies). Not yet written: see ``common.materialize``."""
    prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def shard(ids: list, texts: list[bytes], own: int, id_type: pa.DataType):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None
                                                       else ids[i]))
        n, d, t, c = terms_of([texts[i] for i in order])
        yield pa.RecordBatch.from_arrays(
            [pa.array([own]), pa.nulls(1, pa.int64()), pa.array([int((n > 0).sum())]),
             pa.array([int(n.sum())]), *[pa.nulls(1, pa.binary())] * 3,
             pa.array([[ids[i] for i in order]], pa.list_(id_type)),
             pa.array([n.tolist()], pa.list_(pa.int64()))], names=COLUMNS)
        if not len(d):
            return
        terms, df, *parts = pack(d, t, c, n[d])
        for lo in range(0, len(terms), LISTS):
            m = len(terms[lo:lo + LISTS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, own)), pa.array(terms[lo:lo + m].view(np.int64)),
                 pa.array(df[lo:lo + m]), pa.array(np.zeros(m, np.int64)),
                 *[x.slice(lo, m).cast(pa.binary()) for x in parts],
                 pa.nulls(m, pa.list_(id_type)), pa.nulls(m, pa.list_(pa.int64()))],
                names=COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        own, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0
        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            for i, t in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                if size and size + len(t) > shard_bytes:
                    yield from shard(ids, texts, own, id_type)
                    own, ids, texts, size = own + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield from shard(ids, texts, own, id_type)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "shard long, term long, df long, total long, heads binary, skylines binary, "
             f"bodies binary, ids array<{kind}>, lengths array<long>")


COLUMNS = ["shard", "term", "df", "total", "heads", "skylines", "bodies", "ids", "lengths"]


# ---- one shard -----------------------------------------------------------------------

class Postings:
    """One term's list in a shard; blocks are decompressed when asked for, and kept."""

    def __init__(self, heads: bytes, skylines: bytes, bodies: bytes, n_docs: int, n_terms: int):
        h = np.frombuffer(heads, "<i4").reshape(-1, 4)
        self.last, self.end, self.widths = h[:, 0].astype(np.int64), h[:, 1], h[:, 3]
        self.bodies = bodies
        s = np.frombuffer(skylines, "<i4").reshape(-1, 2).astype(np.int64)
        per_pair = contribution(s[:, 0], s[:, 1], n_docs, n_terms)
        self.block_max = np.maximum.reduceat(per_pair, np.append(0, h[:-1, 2]))
        self.bound = int(self.block_max.max())
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int, lengths: np.ndarray, n_docs: int, n_terms: int):
        """(documents, contributions) of block k."""
        got = self.known.get(k)
        if got is None:
            body = self.bodies[int(self.end[k - 1]) if k else 0:int(self.end[k])]
            doc, count = unpack(body, int(self.widths[k]),
                                int(self.last[k - 1]) if k else -1)
            got = self.known[k] = doc, contribution(count, lengths[doc], n_docs, n_terms)
        return got


def contribution(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's part of a score, before its weight; all whole numbers."""
    return (SCALE * tf) // (1000 * tf + SATURATION * (FLAT + (SLOPE * n * n_docs) // n_terms))


class Shard:
    """The lists of a block of queries in one shard."""

    def __init__(self, lengths: np.ndarray, n_docs: int, n_terms: int):
        self.lengths, self.n_docs, self.n_terms = lengths, n_docs, n_terms
        self.lists: dict[int, Postings] = {}

    def add(self, term: int, heads: bytes, skylines: bytes, bodies: bytes) -> None:
        self.lists[term] = Postings(heads, skylines, bodies, self.n_docs, self.n_terms)

    def block(self, p: Postings, k: int):
        return p.block(k, self.lengths, self.n_docs, self.n_terms)

    def top(self, query: list[tuple[int, int]], k: int, threshold: int) -> tuple:
        """(documents, scores) that may be among the best k, given (term, weight) pairs and a
        score that k documents elsewhere reach; equal scores are not lost."""
        lists = [(w * p.bound, w, p) for t, w in query
                 if w > 0 and (p := self.lists.get(t)) is not None]
        lists.sort(key=lambda x: x[0])
        reach = np.cumsum([0, *[b for b, _, _ in lists]])  # bounds of the lists before each
        floor = max(threshold, 1)
        best_doc, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for lo in range(0, len(self.lengths), RANGE):
            hi = lo + RANGE
            # essential: from the first list whose bound, with all lesser ones, reaches the floor
            essential = int(np.searchsorted(reach[1:], floor))
            if essential == len(lists):
                break
            score = np.zeros(RANGE, np.int64)
            for _, w, p in lists[essential:]:
                a = int(np.searchsorted(p.last, lo))
                b = int(np.searchsorted(p.last, hi - 1))
                for x in range(a, min(b + 1, len(p.last))):
                    doc, part = self.block(p, x)
                    if doc[0] < lo or doc[-1] >= hi:
                        inside = slice(*np.searchsorted(doc, (lo, hi)))
                        doc, part = doc[inside], part[inside]
                    score[doc - lo] += w * part  # a document is once in a list
            cand = np.flatnonzero(score)
            score = score[cand]
            cand = cand + lo
            for at in range(essential - 1, -1, -1):
                live = score + reach[at + 1] >= floor
                cand, score = cand[live], score[live]
                if not len(cand):
                    break
                _, w, p = lists[at]
                where = np.searchsorted(p.last, cand)
                on = where < len(p.last)
                most = np.zeros(len(cand), np.int64)
                most[on] = w * p.block_max[where[on]]
                live = score + reach[at] + most >= floor
                cand, score, where, on = cand[live], score[live], where[live], on[live]
                for x in np.unique(where[on]).tolist():
                    doc, part = self.block(p, x)
                    rows = np.flatnonzero(where == x)
                    i = np.searchsorted(doc, cand[rows])
                    rows = rows[doc[i] == cand[rows]]  # i is inside: the block's last is no less
                    score[rows] += w * part[np.searchsorted(doc, cand[rows])]
            live = score >= floor
            best_doc = np.append(best_doc, cand[live])
            best = np.append(best, score[live])
            if len(best) > k:
                order = np.lexsort((best_doc, -best))[:k]
                best_doc, best = best_doc[order], best[order]
            if len(best) == k:
                floor = max(floor, int(best.min()) + 1)  # later documents lose a tie
        return best_doc, best


# ---- search --------------------------------------------------------------------------

def query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """Rows (query, term), distinct, by the same tokens as the documents."""
    kind = queries.schema[query_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, d, t, _ = terms_of(text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(d)), pa.array(t.view(np.int64), pa.int64())],
                names=["query", "term"])

    return queries.select(F.col(query_id).alias("query"), F.col(text).alias("text")).mapInArrow(
        run, f"query {kind}, term long").distinct()


def search(docs: DataFrame, queries: DataFrame, query_id: str = "item_id", k: int = TOP,
           shard_bytes: int = SHARD_BYTES, query_terms_a_block: int = QUERY_TERMS) -> DataFrame:
    """Rows (query, rank, doc_id, score): each query's k best documents of a score above 0."""
    index = materialize(build(docs, shard_bytes=shard_bytes), "search-index")
    return search_index(index, queries, query_id, k, query_terms_a_block)


def search_index(index: DataFrame, queries: DataFrame, query_id: str = "item_id", k: int = TOP,
                 query_terms_a_block: int = QUERY_TERMS) -> DataFrame:
    """``search`` on a stored index."""
    spark = index.sparkSession
    prepare(spark)
    n_docs, n_terms, n_shards = index.where(F.col("term").isNull()).agg(
        F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)),
        F.count("*")).first()
    tasks = max(1, -(-n_shards // SHARDS_A_TASK))
    wanted = materialize(query_terms(queries, query_id, "text"), "search-queries")
    blocks = max(1, -(-wanted.count() // query_terms_a_block))
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    found = None
    for b in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        out = _search_block(index, own, int(n_docs), int(n_terms), k, id_type, tasks)
        found = out if found is None else found.unionByName(out)
    place = Window.partitionBy("query").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k) \
        .select("query", "rank", "doc_id", "score")


def _search_block(index: DataFrame, own: DataFrame, n_docs: int, n_terms: int, k: int,
                  id_type: str, tasks: int) -> DataFrame:
    spark = index.sparkSession
    terms = own.select(F.col("term").alias("wanted")).distinct()
    lists = materialize(index.join(terms, F.col("term") == F.col("wanted"), "left_semi"),
                        "search-lists")
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * n_docs + 2.0) / (2 * F.col("df") + 1).cast("double")
    weights = own.join(df, "term").select(
        "query", "term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))
    # about query_terms_a_block rows, unless one query alone has more terms
    grouped = weights.groupBy("query").agg(F.collect_list(F.struct("term", "w")).alias("own"))
    sent = spark.sparkContext.broadcast(
        [(r.query, [(x.term, x.w) for x in r.own]) for r in grouped.collect()])
    kind = own.schema["query"].dataType.simpleString()
    by_shard = lists.unionByName(index.where(F.col("term").isNull())) \
        .repartitionByRange(tasks, "shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple]] = [[] for _ in sent.value]
        shard, ids, own_type, query_type = None, None, None, None

        def answer() -> None:
            for q, (_, terms) in enumerate(sent.value):
                heap = heaps[q]
                floor = heap[-1][0] if len(heap) == k else 0
                doc, score = shard.top(terms, k, floor)
                if len(doc):
                    heap += [(s, ids[d]) for d, s in zip(doc.tolist(), score.tolist())]
                    heap.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    del heap[k:]

        for b in batches:
            own_type = b.schema.field("ids").type.value_type
            for r in b.to_pylist():
                if r["term"] is None:
                    if shard is not None:
                        answer()
                    shard = Shard(np.array(r["lengths"], np.int64), n_docs, n_terms)
                    ids = r["ids"]
                else:
                    shard.add(r["term"], r["heads"], r["skylines"], r["bodies"])
        if shard is None:
            return
        answer()
        rows = [(q, d, s) for (q, _), heap in zip(sent.value, heaps) for s, d in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], query_arrow), pa.array([r[1] for r in rows], own_type),
             pa.array([r[2] for r in rows], pa.int64())], names=["query", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    query_arrow = to_arrow_type(own.schema["query"].dataType)
    out = materialize(by_shard.mapInArrow(run, f"query {kind}, doc_id {id_type}, score long"),
                      "search-best")
    sent.unpersist()
    return out
