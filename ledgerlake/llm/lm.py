"""Language-model scoring with Elias-Fano n-gram tries.

The model is an interpolated bigram: p(w|c) = max(n(c,w) - D, 0) / n(c)
+ D t(c) / n(c) p(w), where t(c) counts the kinds of words after c, and
p(w) = (n(w) - D) / N, or D V / N for all unknown words together. It is never
gathered in one place. Texts are cut into blocks; a block sends each of its
distinct words and bigrams, with training counts, to the shard of the word or
of the bigram's context. A shard sums the counts, builds its trie and answers
the bigrams of each block from it: a code of one byte each. The block then
scores its texts. A context that is frequent enough to outweigh a shard is
split over several by its successors, and its totals are added up again.

Words are known by 64-bit hashes, successors of one context by 48 bits of
them. Probabilities are quantised to 255 levels per shard.

Edge cases: a null text is empty and has one token, its end; repeated rows
count and score as often as they occur; without training rows all words are
unknown and the score is that of one unknown word per token; an empty table
gives an empty result. Only doc_id, text and the training condition are read,
so extra columns never clash. A very long text is a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACE_WORDS, Words, chunks, materialize, mix, prepare, text_bytes
from ledgerlake.llm.eliasfano import Trie

BLOCK_BYTES = 8 << 20
SHARD_TOKENS = 1_000_000
LEAST_SHARDS = 16
DISCOUNT = 0.75
# The hashes of a text's end and begin.
END, BEGIN = np.uint64(0x0E4D0E4D0E4D0E4D), np.uint64(0x5E61B5E61B5E61B5)
_W48 = np.uint64((1 << 48) - 1)


def _zip(a: np.ndarray) -> bytes:
    """Compressed, the bytes of each place together."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else a.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1) if len(raw) \
        else np.zeros(0, kind)


def _w48(a: np.ndarray) -> bytes:
    """48-bit numbers, six bytes each: hashes do not compress."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from48(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").reshape(-1)


def blocks(docs: DataFrame, train: Column) -> DataFrame:
    """Rows block, ids, train, sizes (tokens per text, ends included), vocab, tokens, n_train."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0

        def made() -> pa.RecordBatch:
            nonlocal number
            number += 1
            h, size = np.concatenate(hashes), np.concatenate(sizes).astype(np.int32)
            vocab, token, count = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            own = pa.concat_arrays(ids)
            flags = np.concatenate(trains)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([own.to_pylist()], pa.list_(own.type)),
                 pa.array([flags.tolist()]), pa.array([_zip(size)]),
                 pa.array([_zip(vocab[order])]), pa.array([_zip(rank[token])]),
                 pa.array([int(size[flags].sum())])],
                names=["block", "ids", "train", "sizes", "vocab", "tokens", "n_train"])

        ids, trains, hashes, sizes, held = [], [], [], [], 0
        for b in batches:
            texts = text_bytes(b.column("text"))
            flag = np.array(b.column("train").to_pylist(), bool)
            for lo, hi in chunks(texts, 2 << 20):
                w = Words(texts[lo:hi], SPACE_WORDS)
                n = np.diff(w.first)
                at = np.insert(w.hash, w.first[1:], END)  # an end after each text's words
                hashes.append(at)
                sizes.append(n + 1)
                ids.append(b.column("doc_id").slice(lo, hi - lo))
                trains.append(flag[lo:hi])
                held += len(w.raw)
                if held >= BLOCK_BYTES:
                    yield made()
                    ids, trains, hashes, sizes, held = [], [], [], [], 0
        if ids:
            yield made()

    return docs.select("doc_id", train.alias("train"), "text").mapInArrow(
        run, f"block long, ids array<{kind}>, train array<boolean>, sizes binary, vocab binary, "
             "tokens binary, n_train long")


class Bigrams:
    """A block's distinct words and bigrams, and the shards they go to; the same on every reading."""

    def __init__(self, train: list[bool], sizes: bytes, vocab: bytes, tokens: bytes):
        self.vocab = np.append(_unzip(vocab, np.uint64), BEGIN)
        self.size = _unzip(sizes, np.int32).astype(np.int64)
        self.token = _unzip(tokens, np.uint32).astype(np.int64)
        self.train = np.repeat(np.array(train, bool), self.size)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[np.cumsum(self.size) - self.size] = len(self.vocab) - 1
        code = before * len(self.vocab) + self.token
        order = np.argsort(code, kind="stable")
        ordered = code[order]
        new = np.append(True, ordered[1:] != ordered[:-1]) if len(code) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.pair = np.empty(len(code), np.int64)  # the bigram of each token
        self.pair[order] = np.cumsum(new) - 1
        self.context, self.word = np.divmod(ordered[first], len(self.vocab))
        self.count = np.add.reduceat(self.train[order].astype(np.int64), first) \
            if len(first) else np.zeros(0, np.int64)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.token[self.train], minlength=len(self.vocab))

    def shards(self, hot: dict[int, int], shards: int):
        """Per shard that has any: (number, places of its words, of its bigrams by context and
        word). A block meets only the shards of its own words, however many there are."""
        mixed = mix(self.vocab)
        home = (mixed % np.uint64(shards)).astype(np.int64)
        split = np.ones(len(self.vocab), np.int64)
        if hot:
            keys = np.array(sorted(hot), np.uint64)
            at = np.minimum(np.searchsorted(keys, self.vocab), len(keys) - 1)
            is_hot = keys[at] == self.vocab
            split[is_hot] = np.array([hot[int(k)] for k in keys])[at[is_hot]]
        to = (home[self.context] + (mixed[self.word] >> np.uint64(20)).astype(np.int64)
              % split[self.context]) % shards
        # stable: bigrams of a shard stay grouped by context
        order, own = np.argsort(to, kind="stable"), np.argsort(home, kind="stable")
        met = np.union1d(to, home)
        cuts = [np.searchsorted(x, met, side) for x in (to[order], home[own])
                for side in ("left", "right")]
        for s, a, b, c, d in zip(met.tolist(), *cuts):
            yield s, own[c:d], order[a:b]


def _runs(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs of equal values."""
    new = np.append(True, context[1:] != context[:-1]) if len(context) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(context)))


def _hot_contexts(found: DataFrame, total: int, shards: int) -> dict[int, int]:
    """Contexts with over half a shard's share of training bigrams, and over how many to split.

    At most 4 x shards entries reach the driver.
    """
    least = 0.5 / shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                g = Bigrams(row["train"], row["sizes"], row["vocab"], row["tokens"])
                n = np.bincount(g.context, minlength=len(g.vocab))
                at = np.flatnonzero(n >= max(1, least * len(g.context)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.vocab[at].view(np.int64)), pa.array(n[at]),
                     pa.array(np.full(len(at), len(g.context)))], names=["word", "n", "of"])

    rows = found.select("train", "sizes", "vocab", "tokens") \
        .mapInArrow(run, "word long, n long, of long").groupBy("word") \
        .agg((F.sum("n") / F.sum("of")).alias("share"), F.sum("n").alias("n"))
    # the share is of the blocks that listed it: an upper bound of the share of all
    out = rows.where(F.col("share") >= least).orderBy(F.desc("n"), "word") \
        .limit(4 * shards).collect()
    return {int(np.int64(r["word"]).view(np.uint64)): int(math.ceil(2 * shards * r["share"]))
            for r in out}


def requests(found: DataFrame, hot, shards: int) -> DataFrame:
    """Rows shard, block, words, word_n, contexts, degree, successors, pair_n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                g = Bigrams(row["train"], row["sizes"], row["vocab"], row["tokens"])
                n = g.word_counts()
                out = []
                for s, w, p in g.shards(hot.value, shards):
                    first, degree = _runs(g.context[p])
                    out.append((s, row["block"], g.vocab[w].tobytes(), _zip(n[w].astype(np.uint32)),
                                g.vocab[g.context[p][first]].tobytes(),
                                _zip(degree.astype(np.uint32)),
                                _w48(g.vocab[g.word[p]] & _W48),
                                _zip(g.count[p].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int64()]
                                                    + [pa.binary()] * 6)],
                    names=["shard", "block", "words", "word_n", "contexts", "degree",
                           "successors", "pair_n"])

    return found.select("block", "train", "sizes", "vocab", "tokens").mapInArrow(
        run, "shard int, block long, words binary, word_n binary, contexts binary, degree binary, "
             "successors binary, pair_n binary")


REPLY = ("block long, shard int, word_n binary, codes binary, codebook binary, context_n binary, "
         "context_kinds binary, known_words long")


def _answer(messages: pa.Table) -> pa.Table:
    """One shard: sums, trie, and the answer to each block."""
    rows = sorted(messages.to_pylist(), key=lambda r: r["block"])
    words = np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows])
    word_n = np.concatenate([_unzip(r["word_n"], np.uint32) for r in rows]).astype(np.int64)
    kinds, place = np.unique(words, return_inverse=True)
    total = np.bincount(place, word_n, len(kinds)).astype(np.uint32)
    heads = [np.frombuffer(r["contexts"], np.uint64) for r in rows]
    degrees = [_unzip(r["degree"], np.uint32).astype(np.int64) for r in rows]
    context = np.concatenate([np.repeat(h, d) for h, d in zip(heads, degrees)])
    successor = np.concatenate([_from48(r["successors"]) for r in rows])
    n = np.concatenate([_unzip(r["pair_n"], np.uint32) for r in rows]).astype(np.int64)
    seen = np.flatnonzero(n)
    all_contexts = np.unique(np.concatenate(heads))
    c = np.searchsorted(all_contexts, context[seen])
    order = np.lexsort((successor[seen], c))
    c, s, m = c[order], successor[seen][order], n[seen][order]
    new = np.append(True, (c[1:] != c[:-1]) | (s[1:] != s[:-1])) if len(c) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    c, s = c[first], s[first]
    m = np.add.reduceat(m, first) if len(first) else m
    context_n = np.bincount(c, m, len(all_contexts)).astype(np.int64)
    context_kinds = np.bincount(c, minlength=len(all_contexts))
    present = np.flatnonzero(context_kinds)
    trie = Trie(all_contexts[present], context_kinds[present], s,
                np.log10((m - DISCOUNT) / context_n[c]) if len(c) else np.zeros(0))
    out, at, pair_at = [], 0, 0
    for r, h, d in zip(rows, heads, degrees):
        k, pairs = len(np.frombuffer(r["words"], np.uint64)), int(d.sum())
        codes = trie.find(context[pair_at:pair_at + pairs], successor[pair_at:pair_at + pairs])
        i = np.searchsorted(all_contexts, h)
        out.append((r["block"], r["shard"], _zip(total[place[at:at + k]]),
                    _zip(codes.astype(np.uint8)),
                    trie.codebook.astype(np.float32).tobytes(),
                    _zip(context_n[i].astype(np.uint32)), _zip(context_kinds[i].astype(np.uint32)),
                    int((total > 0).sum()) if not out else 0))
        at, pair_at = at + k, pair_at + pairs
    trie.close()
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.int64()]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)],
                                names=[x.split()[0] for x in REPLY.split(", ")])


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Rows doc_id, train, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = materialize(blocks(docs, train), "lm-blocks")
    total, tokens = found.agg(F.coalesce(F.sum("n_train"), F.lit(0)),
                              F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()
    # a token takes about one and a half bytes of the compressed blocks
    shards = max(LEAST_SHARDS, int(tokens / 1.5 / SHARD_TOKENS))
    hot = spark.sparkContext.broadcast(_hot_contexts(found, total, shards))
    replies = materialize(requests(found, hot, shards).groupBy("shard").applyInArrow(
        _answer, REPLY), "lm-replies")
    known = replies.agg(F.coalesce(F.sum("known_words"), F.lit(0))).first()[0]
    mass = float(total + known + 1)

    def finish(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        by_shard = {r["shard"]: r for r in answers.to_pylist()}
        g = Bigrams(row["train"], row["sizes"], row["vocab"], row["tokens"])
        count = np.zeros(len(g.vocab), np.int64)
        context_n, kinds = np.zeros(len(g.vocab), np.int64), np.zeros(len(g.vocab), np.int64)
        part = np.zeros(len(g.context))
        for s, w, p in g.shards(hot.value, shards):
            r = by_shard[s]
            count[w] = _unzip(r["word_n"], np.uint32)
            first, degree = _runs(g.context[p])
            c = g.context[p][first]
            own_n = _unzip(r["context_n"], np.uint32).astype(np.int64)
            np.add.at(context_n, c, own_n)
            np.add.at(kinds, c, _unzip(r["context_kinds"], np.uint32).astype(np.int64))
            code = _unzip(r["codes"], np.uint8).astype(np.int64)
            book = np.append(0.0, 10.0 ** np.frombuffer(r["codebook"], np.float32).astype(float))
            part[p] = book[code] * np.repeat(own_n, degree)  # the shard's part of n(c)
        if total:
            alone = np.where(count > 0, (count - DISCOUNT) / total, DISCOUNT * known / total)
        else:
            alone = np.ones(len(count))
        n, p1 = context_n[g.context], alone[g.word]
        p = np.where(n > 0, (part + DISCOUNT * kinds[g.context] * p1) / np.maximum(n, 1), p1)
        ends = np.cumsum(g.size)
        starts = ends - g.size
        logs = np.log10(p)[g.pair]
        base = np.log10((count + 1) / mass)[g.token]
        seen = (count > 0)[g.token].astype(np.int64)
        sums = [np.add.reduceat(x, starts) for x in (seen, base, logs)]
        kinds_of = block.schema.field("ids").type.value_type
        return pa.Table.from_arrays(
            [pa.array(row["ids"], kinds_of), pa.array(row["train"], pa.bool_()),
             pa.array(g.size), pa.array(sums[0]), pa.array(np.full(len(starts), total)),
             pa.array(sums[1]), pa.array(sums[2])],
            names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return found.drop("n_train").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        finish, f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
