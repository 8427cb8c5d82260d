"""Event-time windows over the record stream: tumbling, sliding and sessions, in append mode.

A window comes out once the watermark has passed its end, and never changes
after. Windows and sessions are Spark's own, so counts and sums are combined in
each task before they are shuffled, and a busy window or key sends one row per
task; sessions are merged within a task first, too. A transaction delivered
again within the watermark counts once.

A record behind the watermark is not lost silently: a second branch of the same
query gives each record that some of its windows no longer take, with their
number. Both branches share one watermark, so what the windows leave out and what
comes out as late is the same. That branch is spread over ``LATE_GROUPS`` groups
by a hash of the record and keeps no state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlake.streaming import fraud_stream as FS
from ledgerlake.streaming.velocity import keyed_state

LATE_GROUPS = 64
LATENESS = "24 hours"


@dataclass(frozen=True)
class Windows:
    """``kind`` tumbling, sliding (with ``slide_ms``) or session (``size_ms`` is the gap)."""
    kind: str
    size_ms: int
    slide_ms: int | None = None

    def column(self) -> Column:
        size = f"{self.size_ms} milliseconds"
        if self.kind == "session":
            return F.session_window("event_time", size)
        if self.kind == "sliding":
            return F.window("event_time", size, f"{self.slide_ms} milliseconds")
        return F.window("event_time", size)

    def step_ms(self) -> int:
        return self.slide_ms if self.kind == "sliding" else self.size_ms

    def first_end_ms(self) -> Column:
        """The end of the earliest window of a record; further ones follow by ``step_ms``."""
        at = F.col("event_ms")
        if self.kind == "session":
            return at + self.size_ms
        back = self.size_ms - self.step_ms()
        return F.floor((at - back) / self.step_ms()) * self.step_ms() + self.size_ms

    def per_record(self) -> int:
        return self.size_ms // self.step_ms() if self.kind == "sliding" else 1


class Late(StatefulProcessor):
    """The records that some of their windows no longer take."""

    def __init__(self, step_ms: int, per_record: int):
        self.step_ms, self.per_record = step_ms, per_record

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        passed = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            missed = ((passed - batch["first_end_ms"]) // self.step_ms + 1).clip(
                0, self.per_record)
            late = batch[missed > 0]
            if len(late):
                yield pd.DataFrame({
                    "grp": late["grp"], "transaction_id": late["transaction_id"],
                    "seq": late["seq"], "event_ms": late["event_ms"],
                    "n_missed": missed[missed > 0].astype("int64")})

    def close(self) -> None:
        pass


LATE_SCHEMA = "grp string, transaction_id string, seq string, event_ms long, n_missed long"


def event_rows(decoded: DataFrame, group: str) -> DataFrame:
    """Valid records with an event time, and the column that windows are kept by."""
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return decoded.filter(F.col("error").isNull()).select(
        F.col(group).alias("grp"), "transaction_id", "seq", ts.alias("event_time"),
        F.unix_millis(ts).alias("event_ms"),
        (F.col("amount").cast("decimal(18,2)") * 100).cast("long").alias("cents"),
        (F.coalesce("is_fraud", F.lit(0)) == 1).alias("fraud")) \
        .filter(F.col("event_time").isNotNull())


def windowed(events: DataFrame, windows: Windows) -> DataFrame:
    """Closed windows by group; ``events`` carry a watermark."""
    once = events.dropDuplicatesWithinWatermark(["transaction_id"])
    agg = once.groupBy(windows.column().alias("w"), "grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"),
        F.count_if("fraud").alias("n_fraud"))
    return agg.select("w.start", "w.end", "grp", "n", "cents", "n_fraud")


def late_records(events: DataFrame, windows: Windows) -> DataFrame:
    own = events.withColumn("first_end_ms", windows.first_end_ms()).withColumn(
        "spread", F.pmod(F.xxhash64("transaction_id", "seq"), F.lit(LATE_GROUPS)))
    return own.drop("event_time").groupBy("spread").transformWithStateInPandas(
        Late(windows.step_ms(), windows.per_record()), LATE_SCHEMA, "append", "eventTime")


def start_window_stream(spark: SparkSession, source_dir: str, windows_path: str, late_path: str,
                        checkpoint: str, windows: Windows, group: str = "category",
                        lateness: str = LATENESS,
                        max_files_per_trigger: int = FS.MAX_FILES_PER_TRIGGER):
    """readStream -> decode -> closed windows and late records, a folder of each per batch."""
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    records = spark.readStream.schema(FS.ENVELOPE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir)
    events = event_rows(FS.decode_records(records), group).withWatermark("event_time", lateness)
    out = windowed(events, windows).unionByName(late_records(events, windows),
                                                allowMissingColumns=True)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        is_window = F.col("start").isNotNull()
        closed = batch.filter(is_window).select(
            F.col("start").alias("window_start"), F.col("end").alias("window_end"),
            F.col("grp").alias(group), "n", (F.col("cents") / 100.0).alias("total_amount"),
            "n_fraud")
        late = batch.filter(~is_window).select(
            F.col("grp").alias(group), "transaction_id", "seq",
            F.timestamp_millis("event_ms").alias("event_time"), "n_missed")
        try:
            for rows, path in ((closed, windows_path), (late, late_path)):
                (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
                 .parquet(path))
        finally:
            batch.unpersist()

    with keyed_state(spark):
        return out.writeStream.foreachBatch(write_batch).outputMode("append") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_windows(spark: SparkSession, path: str, group: str = "category") -> DataFrame:
    """Every window that has come out; empty before the first."""
    return spark.read.schema(f"window_start timestamp, window_end timestamp, {group} string, "
                             "n long, total_amount double, n_fraud long, batch_id long") \
        .parquet(path).drop("batch_id")


def late_table(spark: SparkSession, path: str, group: str = "category") -> DataFrame:
    return spark.read.schema(f"{group} string, transaction_id string, seq string, "
                             "event_time timestamp, n_missed long, batch_id long") \
        .parquet(path).drop("batch_id")
