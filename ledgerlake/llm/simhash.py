"""SimHash near-dedup with a byte-position inverted index and count filtering.

A 64-bit fingerprint is eight positional bytes. Fingerprints within
``max_bits`` differing bits share at least ``8 - max_bits`` of them, so for
two bits at least six. The postings list a fingerprint under every choice of
``kept`` of its four byte pairs (for two bits: two pairs, six lists), one of
which any such pair must share; for the pairs that a list brings together the
shared positional bytes are tallied, pairs below the guaranteed minimum fall
out, and the bits of the rest are compared.
Single positional bytes are not indexed: their lists would be too long.

Only distinct fingerprints are indexed, so exact copies never meet in a list.
A list of more than ``max_list`` fingerprints is not paired: its members are
listed again under each value one bit away in their remaining bytes, where any
two of a list are within two bits by construction. That path is exact, linear,
and its lists hold 33 fingerprints at most. It tallies no bytes; bits are
still compared.

Edge cases: null and blank texts have fingerprint zero and link like others;
repeated rows count once each; a null doc_id gets its component's smallest
other doc_id, or null; an empty table gives an empty result. Only doc_id and
text are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialize, prepare, text_bytes
from ledgerlake.llm.components import connected

SHINGLE_WORDS = 3
MAX_BITS = 2
MAX_LIST = 32
SEED = 42


def fingerprint(text: bytes, n: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' XXH64 hashes, as a signed 64-bit number."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= n:
        hashes = [xxhash.xxh64_intdigest(b" ".join(w), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*(w[i:] for i in range(n))))]
    ones = np.zeros(64, np.int64)
    h = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for lo in range(0, len(h), 65536):
        ones += np.unpackbits(h[lo:lo + 65536], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """Rows doc_id, tie (a hash of the text), fp."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, n) for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tie"), pa.array(fp, pa.int64())],
                names=["doc_id", "tie", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _tie().alias("tie"), "text").mapInArrow(
        run, f"doc_id {kind}, tie long, fp long")


def _tie() -> Column:
    return F.xxhash64("text")


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * (7 - i)).bitwiseAND(F.lit(255))


def _masked(fp: Column, pairs: tuple[int, ...]) -> Column:
    mask = sum(0xFFFF << (16 * (3 - p)) for p in pairs)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """Edges a < b between distinct fingerprints ``fps(fp)``: all that matter to components.

    Lists of up to ``max_list`` give every pair within ``max_bits``; longer ones give
    enough of them to join all that such pairs join.
    """
    if max_bits > 2:
        raise ValueError("four byte pairs guarantee a shared list for up to two bits")
    choices = list(combinations(range(4), 4 - max_bits))
    fp = F.col("fp")
    postings = fps.select("fp", F.posexplode(F.array(*[_masked(fp, c) for c in choices]))
                          .alias("choice", "value"))
    sizes = postings.groupBy("choice", "value").agg(F.count("*").alias("n")).where("n > 1") \
        .select(F.col("choice").alias("c"), F.col("value").alias("v"), "n")
    shared = materialize(postings.join(
        sizes, (F.col("choice") == F.col("c")) & (F.col("value") == F.col("v")))
        .select("fp", "choice", "value", "n"), "simhash-lists")

    short = shared.where(F.col("n") <= max_list).groupBy("choice", "value") \
        .agg(F.sort_array(F.collect_list("fp")).alias("l"))
    pairs = short.select(F.explode(F.transform(
        "l", lambda x, i: F.struct(x.alias("a"), F.slice("l", i + 2, F.size("l")).alias("bs"))))
        .alias("p")).select("p.a", F.explode("p.bs").alias("b"))
    a, b = F.col("a"), F.col("b")
    tally = sum((_byte(a, i) == _byte(b, i)).cast("int") for i in range(8))
    near = pairs.where(tally >= 8 - max_bits) \
        .where(F.bit_count(a.bitwiseXOR(b)) <= max_bits)

    # Centres one bit away (or none): members of a centre's list are within two bits.
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[
        F.lit(_signed(1 << k)) for p in range(4) if p not in c
        for k in range(16 * (3 - p), 16 * (4 - p))]) for c in choices])
    centres = shared.where(F.col("n") > max_list).select(
        "fp", "choice", F.explode(F.element_at(flips, F.col("choice") + 1)).alias("flip"))
    stars = centres.groupBy("choice", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre")) \
        .agg(F.sort_array(F.collect_list("fp")).alias("l")).where(F.size("l") > 1)
    # Under two bits only a member that is the centre itself links to the others.
    hub = F.col("l")[0] if max_bits == 2 else F.col("centre")
    star = stars.where(F.array_contains("l", hub)) \
        .select(hub.alias("h"), F.explode("l").alias("m")).where("h <> m") \
        .select(F.least("h", "m").alias("a"), F.greatest("h", "m").alias("b")) \
        .where(F.bit_count(a.bitwiseXOR(b)) <= max_bits)
    return near.unionByName(star).distinct()


def components(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows doc_id, tie, fp, root, component_id (the smallest doc_id reachable over links)."""
    prepare(docs.sparkSession)
    fps = materialize(fingerprints(docs, n), "simhash-fps")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected(links(distinct.select("fp"), max_bits))
    # Linked fingerprints have a root; the others are their own.
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "root").join(least, "root").select(
        F.col("fp").alias("f"), "root", "component_id")
    return fps.join(by_fp, F.col("fp") == F.col("f")).drop("f")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: the smallest doc_id's (null last; of its texts, by their hash)."""
    reps = components(docs, n, max_bits).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "tie")).alias("r")) \
        .select(F.col("r.doc_id").alias("__id"), F.col("r.tie").alias("__tie"))
    rows = docs.select(F.col("doc_id").alias("__doc"), _tie().alias("__text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    kept = rows.join(reps, F.col("__doc").eqNullSafe(F.col("__id"))
                     & (F.col("__text") == F.col("__tie")), "left_semi")
    # Rows that repeat a doc_id and text are rare: only those go through an aggregate.
    repeated = docs.groupBy(F.col("doc_id").alias("__rid"), _tie().alias("__rt")) \
        .agg(F.count("*").alias("__n")).where("__n > 1")
    same = F.col("__doc").eqNullSafe(F.col("__rid")) & (F.col("__text") == F.col("__rt"))
    once = kept.join(repeated, same, "left_anti")
    again = kept.join(repeated, same, "left_semi").groupBy("__doc", "__text") \
        .agg(F.first("__row").alias("__row"))
    return once.select("__row.*").unionByName(again.select("__row.*"))
