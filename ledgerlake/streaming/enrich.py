"""Enrichment of the decision stream: customer attributes, and fraud labels that come later.

``start_enriched_stream`` joins each micro-batch with a lake table as it stands when the
batch runs. (A table read once when a stream starts keeps the file list of that moment.) The
join is a plain left join of the batch; Spark broadcasts the smaller side where it
measures it to be small. With a history as lookup the attributes are those of the event's time.

``label_join`` is a stream-stream join: a decision waits for its label as long as labels count,
and comes out without one after that. Both sides carry watermarks, so the
state of either is bounded by ``within`` plus the lateness.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import history
from ledgerlake.streaming import fraud_stream as FS
from ledgerlake.streaming.velocity import keyed_state

LABEL_SCHEMA = "transaction_id string, labelled_at string, fraud int"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def event_time() -> Column:
    return F.try_to_timestamp(F.col("timestamp"), F.lit(TIME_FORMAT))


def enrich(decisions: DataFrame, lookup: DataFrame, columns: list[str],
           as_of: bool = False) -> DataFrame:
    """decisions with ``columns`` of their customer; null for an unknown one.

    Stream ids are text, so the lookup's key is compared as text. ``as_of`` takes ``lookup`` as a
    type-2 history and picks the version that held on the event's day.
    """
    known = lookup.withColumn("customer_id", F.col("customer_id").cast("string"))
    if as_of:
        dated = decisions.withColumn("_day", event_time().cast("date"))
        return history.asof_join(dated, known, "customer_id", "_day", "valid_from", columns,
                                 "valid_to").drop("_day")
    return decisions.join(known.select("customer_id", *columns), "customer_id", "left")


def start_enriched_stream(spark: SparkSession, source_dir: str, lookup: Callable[[], DataFrame],
                          columns: list[str], out_path: str, checkpoint: str,
                          processed_at: dt.datetime, as_of: bool = False,
                          max_files_per_trigger: int = FS.MAX_FILES_PER_TRIGGER):
    """readStream -> decide -> join with the table of that moment -> a folder per batch.

    ``lookup`` is called for every batch. A replayed batch replaces its folder; it is enriched
    by the table as it is then, so replays agree if the lookup is a history (``as_of``).
    """
    reader = spark.readStream.schema(FS.ENVELOPE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger)
    scored = FS.score_decoded(FS.decode_records(reader.json(source_dir)))
    decided = FS.decisions(scored, processed_at)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if as_of:  # it is read three times, and would be decoded and scored as often
            batch.persist()
        try:
            rows = enrich(batch, lookup(), columns, as_of)
            (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
             .parquet(out_path))
        finally:
            if as_of:
                batch.unpersist()

    return decided.writeStream.foreachBatch(write_batch) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def label_join(decisions: DataFrame, labels: DataFrame, within: str, lateness: str) -> DataFrame:
    """Streaming decisions, each with the labels that came within ``within`` of it.

    A decision without a label comes out once the watermark has passed the time it waits for
    one. Rows behind the watermark are not joined.
    """
    d = decisions.withWatermark("event_time", lateness)
    at = F.try_to_timestamp(F.col("labelled_at"), F.lit(TIME_FORMAT))
    right = labels.select(F.col("transaction_id").alias("label_id"), at.alias("label_time"),
                          F.col("fraud").alias("label")).filter(F.col("label_time").isNotNull()) \
        .withWatermark("label_time", lateness)
    return d.join(right, F.expr(
        f"transaction_id = label_id AND label_time >= event_time "
        f"AND label_time <= event_time + INTERVAL {within}"), "leftOuter").drop("label_id")


def start_label_stream(spark: SparkSession, source_dir: str, labels_dir: str, out_path: str,
                       checkpoint: str, processed_at: dt.datetime, within: str = "72 HOURS",
                       lateness: str = "24 hours"):
    """Two file streams -> interval join -> labelled decisions, a folder per batch."""
    records = spark.readStream.schema(FS.ENVELOPE_SCHEMA).json(source_dir)
    labels = spark.readStream.schema(LABEL_SCHEMA).json(labels_dir)
    scored = FS.score_decoded(FS.decode_records(records))
    decided = FS.decisions(scored, processed_at).withColumn("event_time", event_time()) \
        .filter(F.col("event_time").isNotNull()).select(
            "transaction_id", "customer_id", "event_time", "fraud_score", "decision")
    joined = label_join(decided, labels, within, lateness)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))

    with keyed_state(spark):
        return joined.writeStream.foreachBatch(write_batch).outputMode("append") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
