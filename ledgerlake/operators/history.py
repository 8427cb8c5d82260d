"""Type-2 history of a table, and point-in-time joins on it.

A history holds every version of a key's row with the half-open interval of days
[valid_from, valid_to) in which it held; the open version ends at ``OPEN_END``.
It is partitioned by valid_to, so a daily load reads and writes the open versions and those
that this day closed, never the closed past.

``asof_join`` gives each fact the version of its key that is the latest at the
fact's time. No window ever holds all of a key: facts are split by key and day,
and the version a day begins with is found on one row per key and day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.marts import VALID_TO

OPEN_END = dt.date.fromisoformat(VALID_TO)
# Columns of a load that say when it ran, not what it found.
STAMPS = ("updated_at", "batch_date", "is_current", "valid_from", "valid_to", "processed_date",
          "silver_timestamp")
HISTORY = ("row_hash", "valid_from", "valid_to", "is_current")


class OutOfOrder(ValueError):
    """A load older than the history's newest."""


def row_hash(df: DataFrame, stamps: Sequence[str] = STAMPS) -> Column:
    """SHA-256 of a row's tracked columns as JSON: null, empty and absent values differ."""
    tracked = sorted(c for c in df.columns if c not in stamps and c not in HISTORY)
    return F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)


def _versions(snapshot: DataFrame, run_date: dt.date, stamps: Sequence[str]) -> DataFrame:
    keep = [c for c in snapshot.columns if c not in HISTORY]
    return snapshot.select(*keep, row_hash(snapshot, stamps).alias("row_hash"),
                           F.lit(run_date).alias("valid_from"), F.lit(OPEN_END).alias("valid_to"),
                           F.lit(True).alias("is_current"))


def next_versions(known: DataFrame | None, snapshot: DataFrame, key: str, run_date: dt.date,
                  stamps: Sequence[str] = STAMPS) -> DataFrame:
    """The versions that end on ``run_date`` or are open after a load of ``snapshot``.

    ``known`` are the open versions and those closed on run_date, by an earlier attempt of this
    load. That attempt is undone first: what it opened goes, what it closed is open again. Then
    an open version is kept if its key has the same row hash, and closed on run_date if its
    row differs or its key is gone; new and changed rows are opened. One join on the
    key; a key that comes back later opens a new version. Rows of a null key, or several of
    one key, are an error of the caller's: snapshots are deduplicated by key.
    """
    new = _versions(snapshot, run_date, stamps)
    if known is None:
        return new
    day = F.lit(run_date)
    base = known.filter(F.col("valid_from") < day).withColumn(
        "valid_to", F.lit(OPEN_END)).withColumn("is_current", F.lit(True))
    columns = new.columns
    missing = [c for c in columns if c not in base.columns]
    for c in missing:  # a column that comes later is null in older versions
        base = base.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
    columns += [c for c in base.columns if c not in columns]
    for c in columns:
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
    old_row = F.struct(*[F.col(c) for c in columns])
    joined = base.select(F.col(key).alias("_k"), old_row.alias("_old")).join(
        new.select(F.col(key).alias("_k"), F.struct(*columns).alias("_new")), "_k", "full")
    same = F.col("_old.row_hash") == F.col("_new.row_hash")
    closed = F.when(F.col("_old").isNotNull() & ~F.coalesce(same, F.lit(False)),
                    F.col("_old").withField("valid_to", day).withField("is_current", F.lit(False)))
    open_now = F.when(F.coalesce(same, F.lit(False)), F.col("_old")).otherwise(F.col("_new"))
    return joined.select(F.explode(F.array_compact(F.array(closed, open_now))).alias("_v")) \
        .select("_v.*")


def load_history(table, snapshot: DataFrame, key: str, run_date: dt.date,
                 stamps: Sequence[str] = STAMPS) -> None:
    """Bring a lake table's history up to ``snapshot`` of run_date.

    A rerun of the newest load changes nothing if the snapshot is the same, and replaces what it
    wrote if it is not. An older load is refused: versions that were opened since rest on it.
    """
    if not table.exists():
        table.write_snapshot(next_versions(None, snapshot, key, run_date, stamps), "valid_to")
        return
    history = table.read()
    newest = history.filter(F.col("valid_to") == F.lit(OPEN_END)).agg(F.max("valid_from")) \
        .first()[0]
    if newest and newest > run_date:
        raise OutOfOrder(f"{table.name} holds {newest}, after {run_date}")
    later = history.filter((F.col("valid_to") > F.lit(run_date))
                           & (F.col("valid_to") < F.lit(OPEN_END)))
    if not later.isEmpty():
        raise OutOfOrder(f"{table.name} holds versions closed after {run_date}")
    known = history.filter(F.col("valid_to").isin(run_date, OPEN_END))
    table.replace_partitions(next_versions(known, snapshot, key, run_date, stamps), "valid_to",
                             days=[run_date, OPEN_END])


def valid_at(history: DataFrame, day: Column | dt.date) -> DataFrame:
    """The versions that held on a day."""
    day = day if isinstance(day, Column) else F.lit(day)
    return history.filter((F.col("valid_from") <= day) & (F.col("valid_to") > day))


# ---- point-in-time join ------------------------------------------------------------------

def asof_join(facts: DataFrame, versions: DataFrame, key: str, at: str, since: str,
              values: Sequence[str], until: str | None = None) -> DataFrame:
    """facts with ``values`` of the latest version of their key whose ``since`` <= ``at``.

    With ``until`` the values are null from that time on (a gap in the history). Of versions of
    one key and time the greatest (by values) counts. Facts without key or time, or before
    their key's first version, get nulls; no fact is lost or doubled.

    Facts are split by (key, day). What a day begins with comes from a window over the
    versions and one row per key and day that has facts, which a hot key fills with days, not
    with facts; each day then carries its own versions on. ``at`` and ``since`` must be of one
    type, dates or timestamps.
    """
    if set(values) & set(facts.columns):
        raise ValueError(f"facts have {sorted(set(values) & set(facts.columns))} already")
    taken = [*values] + ([until] if until else [])
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    day_of = lambda c: F.to_date(c)
    right = versions.filter(F.col(key).isNotNull() & F.col(since).isNotNull()) \
        .groupBy(F.col(key).alias("_k"), F.col(since).alias("_t")) \
        .agg(F.max(F.struct(*taken)).alias("_v"))
    left = facts.filter(known).withColumn("_day", day_of(F.col(at)))
    # 1. per key and day: the version that the day begins with
    days = left.select(F.col(key).alias("_k"), F.col("_day")).distinct()
    starts = days.select("_k", F.col("_day").cast(facts.schema[at].dataType).alias("_t"),
                         F.col("_day"), F.lit(None).cast(right.schema["_v"].dataType).alias("_v"))
    # at equal times the version comes first: the day begins with it
    order = Window.partitionBy("_k").orderBy("_t", F.col("_day").isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = starts.unionByName(right.withColumn("_day", F.lit(None).cast("date"))) \
        .withColumn("_v", F.last("_v", ignorenulls=True).over(order)) \
        .filter(F.col("_day").isNotNull() & F.col("_v").isNotNull()) \
        .select("_k", "_day", "_t", "_v")
    # 2. within a key's day: carry the start's version and the day's own
    within = begun.unionByName(right.withColumn("_day", day_of(F.col("_t"))))
    columns = facts.columns
    rows = left.select(F.col(key).alias("_k"), "_day", F.col(at).alias("_t"),
                       F.lit(None).cast(right.schema["_v"].dataType).alias("_v"),
                       F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_fact"))
    carry = Window.partitionBy("_k", "_day").orderBy("_t", F.col("_fact").isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.unionByName(within, allowMissingColumns=True) \
        .withColumn("_v", F.last("_v", ignorenulls=True).over(carry)) \
        .filter(F.col("_fact").isNotNull())
    value = lambda c: F.col("_v").getField(c)
    if until:
        ended = F.coalesce(value(until) <= F.col("_t").cast(versions.schema[until].dataType),
                           F.lit(False))
        picked = [F.when(~ended, value(c)).alias(c) for c in values]
    else:
        picked = [value(c).alias(c) for c in values]
    return found.select("_fact.*", *picked).unionByName(
        facts.filter(~known), allowMissingColumns=True)
