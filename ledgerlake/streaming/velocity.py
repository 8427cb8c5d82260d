"""Velocity features: how often and how much a customer paid in the last hour and day.

Each scored transaction gets the number and sum of its customer's transactions
with an event time in [t - span, t], t its own, over all that arrived in its
micro-batch or before. State is kept per group of customers (``GROUPS``, by a hash of
the customer), in a map from hour to the group's transactions of that hour: a batch
rewrites only the hours it brings, old hours are read, not rewritten, and what
a call costs (of the state, of Python) is paid per group and hour, not per customer. A
transaction delivered again (same customer, id and event time) replaces its earlier amount.

State expires by event time: a timer per hour fires once the watermark has
passed the hour's end by the longest span. No transaction ahead of the watermark
can need that hour any more, so results do not change; a customer who stops
paying leaves no state behind. A row behind the watermark is not lost: it comes
out with ``late`` set and without features, and leaves the state as it is. (The
event time goes to the state as a plain number: a column that carries the
watermark would make Spark drop such rows before the state sees them.)

A micro-batch is bounded (files per trigger) and so is what a group's state
can hold (span plus lateness); state lives in RocksDB, checkpointed to the
shared folder. ``batch_features`` gives the same features of a finished table
by range windows over days (a busy customer is split by day).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlake.streaming import fraud_stream as FS

HOUR_MS = 3_600_000
SPANS_H = (1, 24)
LATENESS = "24 hours"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = ("customer_id string, transaction_id string, seq string, event_ms long, cents long, "
          "late boolean, "
          + ", ".join(f"n_{h}h long, cents_{h}h long" for h in SPANS_H))
COLUMNS = ["customer_id", "transaction_id", "seq", "event_ms", "cents", "late",
           *[x for h in SPANS_H for x in (f"n_{h}h", f"cents_{h}h")]]
HOUR_STATE = "customer array<string>, id array<string>, at array<long>, cents array<long>"
# Groups of customers that share state; fixed, as the state of a checkpoint rests on it.
GROUPS = 512
ID = ["customer_id", "transaction_id", "event_ms"]
# State partitions per core; no more than the session's shuffle partitions.
PARTITIONS_PER_CORE = 2


@contextmanager
def keyed_state(spark: SparkSession):
    """Session settings of a stream that starts inside: RocksDB, and as many state partitions as
    keep the cores busy. Every partition of a stateful step is a store that each batch opens and
    commits, and each of its tasks sends the driver a counter for every partition."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    some = max(PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism, 8)
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(was), some)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def window_sums(held: pd.DataFrame, new: pd.DataFrame, spans_ms: list[int]):
    """(count, sum) per span of the held rows of the same customer within [t - span, t], for
    each new row of time t."""
    codes = pd.factorize(pd.concat([held["customer_id"], new["customer_id"]], ignore_index=True),
                         use_na_sentinel=False)[0].astype(np.int64)
    own, of = codes[:len(held)], codes[len(held):]
    at, t = (x["event_ms"].to_numpy(np.int64) for x in (held, new))
    times = np.unique(at)
    # customer and time as one number, which orders rows by both
    place = lambda code, x: code * (len(times) + 1) + np.searchsorted(times, x)
    key = place(own, at)
    order = np.argsort(key, kind="stable")
    key, upto = key[order], np.append(0, np.cumsum(held["cents"].to_numpy(np.int64)[order]))
    hi = np.searchsorted(key, place(of, t), side="right")
    for span in spans_ms:
        lo = np.searchsorted(key, place(of, t - span), side="left")
        yield hi - lo, upto[hi] - upto[lo]


class VelocityState(StatefulProcessor):
    """The transactions of one group of customers by hour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hours = handle.getMapState("hours", "hour long", HOUR_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        new = pd.concat(list(rows), ignore_index=True)
        late = new["event_ms"] <= timerValues.getCurrentWatermarkInMs()
        if late.any():
            yield new[late].assign(late=True).reindex(columns=COLUMNS)
            new = new[~late]
            if new.empty:
                return
        digits = new["seq"].fillna("").str.len()
        # the last arrival of an id and time: as in the decision log, longer numbers are later
        new = new.assign(digits=digits).sort_values(["digits", "seq"], kind="stable") \
            .drop_duplicates(ID, keep="last")
        old = [pd.DataFrame(dict(zip([*ID, "cents"], map(list, v))))
               for _, v in self.hours.iterator()]
        held = pd.concat([*old, new[[*ID, "cents"]]], ignore_index=True) \
            .drop_duplicates(ID, keep="last")
        hour = held["event_ms"].to_numpy(np.int64) // HOUR_MS
        touched = np.isin(hour, new["event_ms"].to_numpy(np.int64) // HOUR_MS)
        for own, part in held[touched].groupby(hour[touched]):
            self.hours.updateValue((int(own),), tuple(
                [None if x is None or x != x else x for x in part[c].tolist()]
                for c in (*ID, "cents")))
            self.handle.registerTimer((int(own) + 1 + max(SPANS_H)) * HOUR_MS)
        out = new.assign(late=False)
        for h, (n, cents) in zip(SPANS_H, window_sums(held, new, [h * HOUR_MS for h in SPANS_H])):
            out[f"n_{h}h"], out[f"cents_{h}h"] = n, cents
        yield out[COLUMNS]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        hour = expiredTimerInfo.getExpiryTimeInMs() // HOUR_MS - 1 - max(SPANS_H)
        if self.hours.containsKey((hour,)):
            self.hours.removeKey((hour,))
        return iter(())

    def close(self) -> None:
        pass


def batch_features(rows: DataFrame, key: str = "customer_id", at: str = "event_ms",
                   cents: str = "cents") -> DataFrame:
    """rows with n_1h, cents_1h, n_24h, cents_24h over all rows of the key in [t - span, t].

    Each row also goes to the next day as context, so that a window partition is one day of a
    key and the day before, however busy the key. Rows without key or time get no features.
    """
    day_ms = 24 * HOUR_MS
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    day = F.floor(F.col(at) / day_ms)
    both = rows.filter(known).withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False)))) \
        .withColumn("_day", F.when(F.col("_own"), day).otherwise(day + 1))
    of_day = Window.partitionBy(key, "_day").orderBy(at)
    features = []
    for h in SPANS_H:
        span = of_day.rangeBetween(-h * HOUR_MS, 0)
        features += [F.count(F.lit(1)).over(span).alias(f"n_{h}h"),
                     F.sum(cents).over(span).alias(f"cents_{h}h")]
    own = both.select(*rows.columns, "_own", *features).filter("_own").drop("_own")
    return own.unionByName(rows.filter(~known), allowMissingColumns=True)


def event_rows(decoded: DataFrame) -> DataFrame:
    """Valid rows with an event time; those without one have no features."""
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return decoded.filter(F.col("error").isNull()).select(
        "customer_id", "transaction_id", "seq", ts.alias("event_time"),
        F.unix_millis(ts).alias("event_ms"),
        (F.col("amount").cast("decimal(18,2)") * 100).cast("long").alias("cents")) \
        .filter(F.col("event_time").isNotNull())


def feature_columns() -> list[Column]:
    return [x for h in SPANS_H for x in (
        F.col(f"n_{h}h"), (F.col(f"cents_{h}h") / 100.0).alias(f"sum_{h}h"))]


def velocity_stream(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Streaming rows with their features; ``events`` as ``event_rows`` gives them."""
    rows = events.withWatermark("event_time", lateness).drop("event_time").withColumn(
        "grp", F.pmod(F.xxhash64("customer_id"), F.lit(GROUPS))).groupBy("grp") \
        .transformWithStateInPandas(VelocityState(), OUTPUT, "append", "eventTime")
    return rows.select(
        "customer_id", "transaction_id", "seq", F.timestamp_millis("event_ms").alias("event_time"),
        (F.col("cents") / 100.0).alias("amount"), "late", *feature_columns())


def start_velocity_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                          lateness: str = LATENESS,
                          max_files_per_trigger: int = FS.MAX_FILES_PER_TRIGGER):
    """readStream -> decode -> keyed state -> one folder of features per micro-batch."""
    records = spark.readStream.schema(FS.ENVELOPE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir)
    features = velocity_stream(event_rows(FS.decode_records(records)), lateness)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    with keyed_state(spark):
        return features.writeStream.foreachBatch(write_batch).outputMode("append") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
