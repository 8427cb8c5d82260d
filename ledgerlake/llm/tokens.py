"""Token counts without token ids.

Texts are cut into pre-tokens and counted, block by block of some ``BLOCK_BYTES`` of text: a
block keeps its distinct pre-tokens once, and for each document which of them it
has and how often. The blocks' pre-tokens are brought together, sorted, and each is
tokenised once for the whole table; its number of pieces goes back to the blocks that have it,
is joined to their frequencies, multiplied and summed per document. What is
shuffled is a block's distinct pre-tokens, not a document's, and no token id is kept. Their
shuffle files go as soon as their numbers are stored, before the blocks are joined. A Python
worker keeps one tokenizer for all its tasks.

The file tells how texts are cut: special strings first (each is one token
wherever it occurs, the library's default), then the pre-tokeniser's pattern.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted separately; a very long text is cut as a whole, and may be a block of its own; a
pre-token that is in every block is one row of each; an empty table gives
an empty result. Only doc_id and text are read, so extra columns never clash.
"""

from __future__ import annotations

import json
import os
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialize, prepare

LIMIT = 512
BLOCK_BYTES = 16 << 20
# Rows of one Arrow batch of pre-tokens.
PIECE_ROWS = 4_000
# Bytes of blocks in one Arrow batch.
BATCH_BYTES = 8 << 20
# Pre-tokens of blocks that a task holds before it sends their numbers.
TASK_PIECES = 250_000
# Fixed value: the pattern of byte-level pre-tokenisers.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _zip(a: array | np.ndarray, rising: bool = False) -> bytes:
    """Numbers below 2**32, the bytes of each place together, compressed; ``rising``: as
    differences modulo 2**32, small wherever the numbers rise. The first byte tells which."""
    a = np.asarray(a).astype("<u4")
    if rising:
        a = np.diff(a, prepend=a.dtype.type(0))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes()
    return bytes([rising]) + zstandard.ZstdCompressor(level=3).compress(planes)


def _unzip(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8)
    a = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)
    return (np.cumsum(a, dtype=a.dtype) if b[0] else a).astype(np.int64)


class PieceCounter:
    """Cuts texts for a byte-level tokenizer file, and counts the tokens of pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                 and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        special = [t for t in spec.get("added_tokens") or []]
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError("only byte-level files without normaliser or prefix space")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pattern = regex.compile(BYTE_LEVEL)

    def cut(self, text: str) -> tuple[Counter, int]:
        """(frequencies of the pre-tokens, special strings)."""
        n, parts = 0, [text]
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            n = len(parts) - 1
        freq: Counter = Counter()
        for p in parts:
            freq.update(self.pattern.findall(p))
        return freq, n

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        # One by one: the library's batches start a thread per core in every Python worker.
        encode = self.tokenizer.encode
        return [len(encode(p, add_special_tokens=False)) for p in pre_tokens]


@lru_cache(maxsize=1)
def _kept_counter(path: str, _changed: int) -> PieceCounter:
    return PieceCounter(path)


def piece_counter(path: str) -> PieceCounter:
    """One counter for all tasks of a Python worker: the library keeps the memory of counters
    that are dropped, so one a task grows with the number of tasks."""
    return _kept_counter(path, os.stat(path).st_mtime_ns)


def blocks(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows block, ids, n_bytes, specials, kinds (distinct pre-tokens per document), places (of
    those in vocab, document by document, ascending in each), counts, vocab."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, number = piece_counter(path), TaskContext.get().partitionId() << 32
        vocab: dict[str, int] = {}
        ids, sizes, specials, kinds, held = [], [], [], [], 0
        places, counts = array("I"), array("I")

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([pa.concat_arrays(ids).to_pylist()],
                                              pa.list_(ids[0].type)),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([specials], pa.list_(pa.int64())),
                 pa.array([kinds], pa.list_(pa.int32())), pa.array([_zip(places, True)]),
                 pa.array([_zip(counts)]),
                 pa.array([list(vocab)], pa.list_(pa.string()))],
                names=["block", "ids", "n_bytes", "specials", "kinds", "places", "counts", "vocab"])

        for b in batches:
            for i, t in enumerate(b.column("text").to_pylist()):
                freq, n = counter.cut(t or "")
                ids.append(b.column("doc_id").slice(i, 1))
                sizes.append(len((t or "").encode()))
                specials.append(n)
                kinds.append(len(freq))
                own = np.array([vocab.setdefault(p, len(vocab)) for p in freq], np.uintc)
                order = np.argsort(own)
                places.frombytes(own[order].tobytes())
                counts.frombytes(np.array(list(freq.values()), np.uintc)[order].tobytes())
                held += sizes[-1]
                if held >= block_bytes:
                    yield made()
                    vocab, number = {}, number + 1
                    ids, sizes, specials, kinds, held = [], [], [], [], 0
                    places, counts = array("I"), array("I")
        if ids:
            yield made()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"block long, ids array<{kind}>, n_bytes array<long>, specials array<long>, "
             "kinds array<int>, places binary, counts binary, vocab array<string>")


def piece_counts(own: DataFrame, path: str) -> DataFrame:
    """Rows block, places, n (zipped) for rows block, place, piece: equal pieces lie together, so
    each is tokenised once. A task sends each block's numbers as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, last, n_last = piece_counter(path), None, 0
        held: list[list[np.ndarray]] = [[], [], []]

        def made() -> pa.RecordBatch:
            block, place, n = (np.concatenate(x) for x in held)
            order = np.lexsort((place, block))
            block, place, n = block[order], place[order], n[order]
            cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(cut[1:], len(block))
            return pa.RecordBatch.from_arrays(
                [pa.array(block[cut]), *[
                    pa.array([_zip(x[lo:hi], rising) for lo, hi in zip(cut, ends)])
                    for x, rising in ((place, True), (n, False))]],
                names=["block", "places", "n"])

        for b in batches:
            coded = b.column("piece").dictionary_encode()
            names = coded.dictionary.to_pylist()
            new = names[1:] if names and names[0] == last else names
            counts = counter.pieces(new)
            if len(new) < len(names):  # a piece that began in the batch before
                counts = [n_last, *counts]
            if not names:
                continue
            last, n_last = names[-1], counts[-1]
            for x, y in zip(held, (b.column("block").to_numpy(), b.column("place").to_numpy(),
                                   np.array(counts)[coded.indices.to_numpy()])):
                x.append(y)
            if sum(map(len, held[0])) >= TASK_PIECES:
                yield made()
                held = [[], [], []]
        if held[0]:
            yield made()

    return own.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        run, "block long, places binary, n binary")


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows doc_id, n_bytes, n_tokens, over_limit for the tokenizer file at ``path``.

    The file must be at ``path`` on every executor.
    """
    spark = docs.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    found = materialize(blocks(docs, path, block_bytes), "token-blocks", compact=True)
    own = found.select("block", F.posexplode("vocab").alias("place", "piece"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PIECE_ROWS))
    pieces = materialize(piece_counts(own, path), "token-pieces", compact=True)
    prepare(spark)
    joined = pieces.groupBy(F.col("block").alias("b")).agg(
        F.collect_list(F.struct("places", "n")).alias("parts"))
    rows = found.drop("vocab").join(joined, F.col("block") == F.col("b"), "left").drop("b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, size, special, kinds = (batch.column(c)[r].values for c in (
                    "ids", "n_bytes", "specials", "kinds"))
                places, counts = (_unzip(batch.column(c)[r].as_py()) for c in ("places", "counts"))
                ends = np.cumsum(kinds.to_numpy(zero_copy_only=False).astype(np.int64))
                n = np.zeros(int(places.max()) + 1 if len(places) else 0, np.int64)
                for part in batch.column("parts")[r].as_py() or []:
                    n[_unzip(part["places"])] = _unzip(part["n"])
                parts = np.append(0, np.cumsum(n[places] * counts))
                starts = np.append(0, ends[:-1])
                tokens = parts[ends] - parts[starts] + special.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [ids, size, pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
