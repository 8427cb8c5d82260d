"""Sharding by proportional stratified interleaving.

The rows of each source are put in a seeded random order (by a hash of seed, id
and text) and ranked. A row's fractional rank, (rank + 1/2) / rows of its
source, spreads every source evenly over 0 to 1; sorted by it, any stretch holds
the sources in the proportions of the whole, to about one row each. The sorted
rows are cut into shards of equal counts, at most one row apart (law ``rows``);
the place within the shard is the slot.

Both orders are made by range partitioning on keys that end in the row's place in the input,
so no source, text or id is ever one group: a source with a third of the rows,
and rows that are equal in all columns, are divided among tasks like any others.
Ranks come from the places within partitions plus counts of the partitions
before: a row per partition and source, summed up per source over the
partitions, and a row per partition for the final order. The latter alone is
broadcast; its rows are the shuffle partitions.

Edge cases: null texts have size 16 and the crc32 of the empty text; a null
source is a source; a null id is hashed like any value; rows of equal id and text (repeated
rows) are rows of their own, in the order of the input; an empty table gives an
empty table; with fewer rows than shards the last shards are empty. Texts are
read as a whole, and need not be sent along: all columns of docs are passed on,
so select those the shards shall hold. Added columns are named by
``common.fresh`` where docs has such a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, materialize, prepare

SHARDS = 40
SEED = 13
# Fixed value: what a row weighs beside its text's bytes.
ROW_BYTES = 16
# monotonically_increasing_id: partition above these bits, place in it below.
PLACE_BITS = 33


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def shuffle_key(docs: DataFrame, seed: int) -> Column:
    """The seeded order of rows; equal for equal id and text."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), F.col("doc_id"),
                      F.col("text").isNull(), F.col("text"))


def place_of(mid: Column) -> tuple[Column, Column]:
    """(partition, place in it) of a stored monotonically_increasing_id."""
    return F.shiftright(mid, PLACE_BITS), mid.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def interleave(rows: DataFrame, key: str, shards: int = SHARDS, source: str = "source") -> DataFrame:
    """rows with shard and slot; ``key`` names the column that orders a source's rows."""
    prepare(rows.sparkSession)
    columns = rows.columns
    nth, mid, part, at, frac, shard, slot = (
        fresh(columns, c) for c in ("nth", "mid", "part", "at", "frac", "shard", "slot"))
    src, before, total, first = (fresh(columns, c) for c in ("src", "before", "total", "first"))

    def ordered(df: DataFrame, *order: str, name: str) -> DataFrame:
        """Sorted over all partitions and stored, with each row's partition and place."""
        own = df.repartitionByRange(*order).sortWithinPartitions(*order) \
            .withColumn(mid, F.monotonically_increasing_id())
        p, i = place_of(F.col(mid))
        return materialize(own, name).withColumn(part, p).withColumn(at, i).drop(mid)

    # 1. the order within sources
    d = ordered(rows.withColumn(nth, F.monotonically_increasing_id()), source, key, nth,
                name="shard-sources")
    runs = d.groupBy(F.col(part).alias("p"), F.col(source).alias(src)).agg(
        F.min(at).alias(first), F.count("*").alias("n"))
    of_source = Window.partitionBy(src)
    runs = materialize(runs.select(
        "p", src, first,
        (F.sum("n").over(of_source.orderBy("p")) - F.col("n")).alias(before),
        F.sum("n").over(of_source).alias(total)), "shard-runs")
    p = fresh(columns, "p")
    runs = runs.withColumnRenamed("p", p)
    ranked = d.join(runs, (F.col(part) == F.col(p)) & F.col(source).eqNullSafe(F.col(src)))
    rank = F.col(before) + F.col(at) - F.col(first)
    # 2. the order by fractional rank; a source's rows never share one
    ranked = ranked.withColumn(frac, (rank + 0.5) / F.col(total)) \
        .select(*[F.col(f"`{c}`") for c in columns], nth, frac)
    d = ordered(ranked, frac, source, key, nth, name="shard-order")
    counts = d.groupBy(F.col(part).alias(p)).agg(F.count("*").alias(total))
    upto = Window.orderBy(p)  # one row per partition
    counts = materialize(counts.select(
        p, (F.sum(total).over(upto) - F.col(total)).alias(before),
        F.sum(total).over(Window.partitionBy()).alias(total)), "shard-counts")
    out = d.join(F.broadcast(counts), F.col(part) == F.col(p))
    # 3. equal cuts: shard s begins at row ceil(s * rows / shards)
    place = F.col(before) + F.col(at)
    out = out.withColumn(nth, place).withColumn(shard, F.expr(
        f"cast((`{nth}` * {shards}) div `{total}` as int)"))
    begin = F.expr(f"(cast(`{shard}` as bigint) * `{total}` + {shards - 1}) div {shards}")
    return out.withColumn(slot, F.col(nth) - begin).select(
        *[F.col(f"`{c}`") for c in columns], shard, slot)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                    columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all, if None) with size, text_crc32, law, shard and slot."""
    names = [fresh(docs.columns, c) for c in ("size", "text_crc32", "law", "key", "of_source")]
    size, crc, law, key, src = names
    passed = docs.columns if columns is None else columns
    rows = docs.select(*[F.col(f"`{c}`") for c in passed],
                       size_of(F.col("text")).alias(size), text_crc32(F.col("text")).alias(crc),
                       F.lit("rows").alias(law), F.col("source").alias(src),
                       shuffle_key(docs, seed).alias(key))
    return interleave(rows, key, shards, src).drop(key, src)
