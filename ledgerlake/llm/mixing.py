"""Mixing sources to target weights.

The words of each source form one stream, cut into blocks of ``block_words``.
Each output shard draws how many slots each source gets (the whole part of
its expectation, the rest by a multinomial draw). A source's slots, numbered
over all shards, pass through a keyed pseudorandom permutation of its block
numbers, a new one for each round, and slots and blocks are joined by number.

A hot source is only a third of evenly spread (source, block) keys; its
stream offsets come from a two-level prefix sum, never from one sorted group.
Sources are a table like any other, of any number: their targets come from sums over
it, and shards draw in two steps, first how many slots go to each group of
``GROUP_SOURCES`` sources, then to the sources in it. Only sums per group reach the driver.

Edge cases: a null text has no words and is in no block; a null source is a
source of its own, last in order; repeated rows are packed and counted
separately, in one bucket if they are equal in id, source and text; an empty table
gives an empty mix. A very long text is one row of many blocks. Draws beyond ``max_repeat``
rounds of a source are not used. Only doc_id, source and text are read, so
extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, materialize, mix, prepare, ranked, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
SEED = 11
TASK_SLOTS = 250_000
# Sources that a shard draws among in one go.
GROUP_SOURCES = 50_000
# Prefix sums run over about so many rows each, and over at most so many sums of them.
OFFSET_BUCKET_ROWS = 2_000
MAX_OFFSET_BUCKETS = 100_000
SHARD_GROUP = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Rows sid, source, source_size, target; the excess over the cap is reshared by weight.

    Where some sources are over their cap, the others' unit grows, so a source that is over once
    stays so: rounds of sums go on until no source is added.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rows = ranked(rows, ["source"], "sid", "mix-sources")
    turn = F.pmod("sid", F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = rows.withColumn("weight", weight)
    cap = max_repeat * F.col("source_size")
    total, unit, over, before = None, 0.0, F.lit(False), -1
    while True:
        n, size, capped, free = rows.agg(
            F.count_if(over), F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        total = float(size)
        if n == before or not free:
            break
        before, unit = n, (total - capped) / free
        over = F.lit(unit) * F.col("weight") > cap
    target = F.when(over, cap.cast("double")).otherwise(F.lit(unit) * F.col("weight"))
    return rows.select("sid", "source", "source_size", target.alias("target"))


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed pseudorandom permutation of 0..n-1 (Feistel rounds, walked back into range)."""
    half = np.ceil(np.log2(np.maximum(n, 2)) / 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    y, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = y[todo] >> h, y[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(r << 40)) & m)
        y[todo] = (left << h) | right
        todo = todo[y[todo] >= n[todo].astype(np.uint64)]
    return y.astype(np.int64)


def packed(docs: DataFrame, by_source: DataFrame) -> DataFrame:
    """docs (doc_id, source, size, ...) with sid and offset, its place in the source's stream."""
    n = docs.count()
    buckets = min(MAX_OFFSET_BUCKETS, max(1, n // OFFSET_BUCKET_ROWS))
    d = docs.join(by_source, docs["source"].eqNullSafe(by_source["__source"])) \
        .drop("__source").withColumn("bucket", F.pmod("k1", F.lit(buckets)))
    sums = d.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    base = sums.select("sid", "bucket", (F.sum("n").over(
        Window.partitionBy("sid").orderBy("bucket")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "k1", "k2") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("inside", F.sum("size").over(inside) - F.col("size")) \
        .join(base, ["sid", "bucket"]) \
        .withColumn("offset", F.col("base") + F.col("inside")).drop("inside", "base", "bucket")


def draw_slots(sources: DataFrame, block_words: int = BLOCK_WORDS,
               max_repeat: int = MAX_REPEAT, shard_slots: int = SHARD_SLOTS,
               seed: int = SEED, group_sources: int = GROUP_SOURCES) -> DataFrame:
    """Rows shard, sid, epoch, block: which block of which source fills each output slot."""
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words)
    live = sources.where("source_size > 0 AND target > 0").select(
        "sid", blocks.alias("n"), (F.col("target") / F.col("source_size") * blocks).alias("want"))
    groups = live.groupBy(F.expr(f"sid div {group_sources}").alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("sid", "n", "want"))).alias("s"))
    groups = materialize(groups.select("g", "s.sid", "s.n", "s.want"), "mix-groups")
    # sums are taken in the order of sources, so that reruns agree
    in_turn = lambda x: F.aggregate(x, F.lit(0.0), lambda a, y: a + y)
    wanted = sum(r[0] for r in groups.orderBy("g").select(in_turn("want")).collect())
    shards = max(1, int(np.ceil(wanted / shard_slots))) if wanted else 0
    part = lambda w: w / max(1, shards)
    rest = lambda w: F.greatest(F.lit(0.0), part(w) - F.floor(part(w) + 1e-9))
    per_group = groups.orderBy("g").select("g", in_turn(F.transform("want", rest))).collect()
    numbers = {r[0]: i for i, r in enumerate(per_group)}
    group_rest = np.array([r[1] for r in per_group])
    extra = float(group_rest.sum())

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for g, sid, n, want, grp in zip(b["g"], b["sid"], b["n"], b["want"], b["grp"]):
                per = np.asarray(want, float) / shards
                sure = np.floor(per + 1e-9).astype(np.int64)
                left = np.clip(per - sure, 0, None)
                sid, n, out = np.asarray(sid, np.int64), np.asarray(n, np.int64), []
                for shard in range(grp * SHARD_GROUP, min(shards, (grp + 1) * SHARD_GROUP)):
                    # a fractional total is rounded at random, so its expectation is kept
                    c, own = sure, 0
                    if extra > 1e-9:
                        rng = np.random.default_rng([seed, shard])
                        own = rng.multinomial(int(np.floor(extra + rng.random())),
                                              group_rest / extra)[numbers[g]]
                    if own:
                        rng = np.random.default_rng([seed, shard, int(g) + 1])
                        c = c + rng.multinomial(own, left / left.sum())
                    hit = np.flatnonzero(c)
                    out.append(pd.DataFrame({"shard": shard, "sid": sid[hit], "blocks": n[hit],
                                             "n": c[hit], "grp": grp}))
                yield pd.concat(out)

    chunks = F.explode(F.sequence(F.lit(0), F.lit(max(0, (shards - 1) // SHARD_GROUP))))
    drawn = groups.withColumn("grp", chunks).where(F.lit(shards > 0)) \
        .repartition("g", "grp").mapInPandas(
            counts, "shard long, sid long, blocks long, n long, grp long")
    base = drawn.groupBy("sid", "grp").agg(F.sum("n").alias("g"))
    base = base.select("sid", "grp", (F.sum("g").over(
        Window.partitionBy("sid").orderBy("grp")) - F.col("g")).alias("base"))
    inside = Window.partitionBy("sid", "grp").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = drawn.withColumn("j", F.sum("n").over(inside) - F.col("n")).join(
        base, ["sid", "grp"]).select("shard", "sid", "blocks", "n",
                                     (F.col("base") + F.col("j")).alias("j"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            k = b["n"].to_numpy()
            within = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            sid = np.repeat(b["sid"].to_numpy(), k)
            n = np.repeat(b["blocks"].to_numpy(), k)
            j = np.repeat(b["j"].to_numpy(), k) + within
            epoch = j // n
            key = mix(np.uint64(seed) + mix(sid.astype(np.uint64) * np.uint64(1 << 20)
                                            + epoch.astype(np.uint64)))
            yield pd.DataFrame({
                "shard": np.repeat(b["shard"].to_numpy(), k), "sid": sid, "epoch": epoch,
                "block": permuted(j % n, n, key)})[epoch < max_repeat]

    # a few counts become very many slots: deal them out by what they become
    tasks = max(1, int(wanted) // TASK_SLOTS)
    return placed.repartition(tasks, "shard", "sid").mapInPandas(
        fill, "shard long, sid long, epoch long, block long")


def _parts(spark, docs: DataFrame, with_text: bool, weights, block_words, max_repeat, seed):
    prepare(spark)
    text = F.col("text")
    d = docs.select("doc_id", "source", word_count(text).alias("size"),
                    F.xxhash64("doc_id", "source", "text").alias("k1"),
                    F.xxhash64(F.lit(1), "text", "source", "doc_id").alias("k2"),
                    *([text] if with_text else []))
    if not with_text:
        d = materialize(d, "mix-sizes")
    sizes = materialize(d.drop("text"), "mix-sizes") if with_text else d
    sources = source_targets(sizes, weights, max_repeat)
    sources = materialize(sources, "mix-targets")
    slots = draw_slots(sources, block_words, max_repeat, seed=seed)
    return d, sizes, sources.withColumnRenamed("source", "__source"), slots


def _pieces(placed: DataFrame, block_words: int, *more: str) -> DataFrame:
    """A row for each block that a text has words in: words from..to of the text."""
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    p = placed.where("size > 0").select("sid", "offset", "size", *more,
                                        F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.lit(0), F.col("block") * block_words - F.col("offset"))
    hi = F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("offset"))
    return p.withColumn("lo", lo).withColumn("n", hi - lo)


def mix_usage(spark, docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS,
              max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken."""
    d, sizes, by_source, slots = _parts(spark, docs, False, weights, block_words, max_repeat, seed)
    placed = materialize(packed(sizes, by_source), "mix-placed")
    used = slots.groupBy("sid", "block").agg(F.count("*").alias("times"))
    # Spark takes the slots for as small as the shards they are drawn from: never broadcast them
    taken = _pieces(placed, block_words).join(used.hint("merge"), ["sid", "block"]) \
        .groupBy("sid", "offset").agg(F.sum(F.col("n") * F.col("times")).alias("taken")) \
        .withColumnRenamed("sid", "s").withColumnRenamed("offset", "o")
    # a text without words shares its offset with the next one, but is in no block
    on = (F.col("sid") == F.col("s")) & (F.col("offset") == F.col("o")) & (F.col("size") > 0)
    return placed.join(taken, on, "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(spark, docs: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS,
                  max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """The mix itself: shard, source, epoch, block, n_words, doc_ids, text; a row per slot."""
    d, sizes, by_source, slots = _parts(spark, docs, True, weights, block_words, max_repeat, seed)
    # texts go with their rows: they move once, and equal rows need no telling apart
    split = packed(d, by_source).where("size > 0").select(
        "doc_id", "source", "sid", "offset", "size", F.regexp_extract_all(
            "text", F.lit(f"({WORD})"), F.lit(0)).alias("words"))
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words)

    def piece(b):
        lo = F.greatest(F.lit(0), b * block_words - F.col("offset"))
        hi = F.least(F.col("size"), (b + 1) * block_words - F.col("offset"))
        return F.struct(b.alias("block"), (hi - lo).alias("n"), F.array_join(
            F.slice("words", (lo + 1).cast("int"), (hi - lo).cast("int")), " ").alias("text"))

    pieces = split.select("doc_id", "source", "sid", "offset", F.explode(
        F.transform(F.sequence(first, last), piece)).alias("p"))
    # a block holds at most block_words pieces
    blocks = pieces.groupBy("sid", F.col("p.block").alias("block")).agg(
        F.first("source").alias("source"), F.sum("p.n").alias("n_words"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", F.col("p.text").alias("text"))))
        .alias("parts"))
    return slots.hint("merge").join(blocks, ["sid", "block"]).select(
        "shard", "source", "epoch", "block", "n_words",
        F.col("parts.doc_id").alias("doc_ids"),
        F.array_join(F.col("parts.text"), " ").alias("text"))
