"""Helpers shared by the training-data operators.

Texts are handled as UTF-8 bytes inside tasks: ``bytes.split()`` and
``bytes.lower()`` touch ASCII only, so they give exactly the words
``[^\\x20\\x09-\\x0D]+`` and the A-Z lower-casing the operators ask for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
# Rows of one Arrow batch: long texts stay within a Python worker's memory.
ARROW_ROWS = 500
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators; the shared folder is known to Spark."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    shared_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives executors.

    ``compact`` saves disk: files are zstd, and the shuffle files of the write go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    if compact:
        before = spark.conf.get(SHUFFLE_CLEANUP, None)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path, compression="zstd")
        finally:
            if before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# monotonically_increasing_id: partition above these bits, place in it below.
PLACE_BITS = 33


def ranked(df: DataFrame, order: list[str], rank: str, name: str) -> DataFrame:
    """df, stored, with each row's place (from 0) in the order of these columns, nulls last.

    Rows are range-partitioned and sorted; places in partitions and counts of the partitions
    before make the rank. The counts, a row per shuffle partition, are broadcast.
    """
    mid, part, before = (fresh(df.columns, c) for c in ("mid", "part", "before"))
    by = [F.col(c).asc_nulls_last() for c in order]
    own = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by)
                      .withColumn(mid, F.monotonically_increasing_id()), name)
    own = own.withColumn(part, F.shiftright(mid, PLACE_BITS))
    upto = Window.orderBy(part)  # one row per partition
    counts = own.groupBy(part).agg(F.count("*").alias("n")).select(
        part, (F.sum("n").over(upto) - F.col("n")).alias(before))
    at = F.col(mid).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return own.join(F.broadcast(counts), part).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(before) + at).alias(rank))


def fresh(columns: list[str], base: str) -> str:
    """A column name that clashes with none of ``columns`` (in any case)."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"),
                                       F.lit(0))).cast("long")


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column as bytes per row; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the bytes outside the given ranges."""
    out = np.ones(256, bool)
    for a, b in ranges:
        out[a:b + 1] = False
    return out


SPACE_WORDS = byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = 1 << max(16, int(n).bit_length())
        for key, base in (("p", _P), ("i", _P_INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    return _POWERS["p"], _POWERS["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a few texts: byte ranges, 64-bit hashes, and where each text's begin.

    ``first[i]:first[i+1]`` are the words of text i; ``buf`` holds all bytes.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        begins = ends - np.array([len(t) for t in texts], np.int64)
        self.raw = b"".join(texts)
        self.buf = LOWER[np.frombuffer(self.raw, np.uint8)]
        m = is_word[self.buf]
        before = np.empty_like(m)
        before[:1] = False
        before[1:] = m[:-1]
        after = np.empty_like(m)
        after[-1:] = False
        after[:-1] = m[1:]
        inside = begins < ends
        before[begins[inside]] = False
        after[ends[inside] - 1] = False
        self.start = np.flatnonzero(m & ~before)
        self.end = np.flatnonzero(m & ~after) + 1
        self.first = np.append(np.searchsorted(self.start, begins), len(self.start))
        if len(self.start):
            p, inv = _powers(len(self.buf))
            v = _BYTE[self.buf] * p[:len(self.buf)]
            v[~m] = 0
            self.hash = mix(np.add.reduceat(v, self.start) * inv[self.start]
                            + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.empty(0, np.uint64)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]].lower()
