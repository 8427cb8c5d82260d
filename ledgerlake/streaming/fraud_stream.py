"""Fraud scoring on a record stream.

Records arrive as JSON envelopes ``{"kinesis": {"data": <base64 JSON>,
"sequenceNumber": ...}}``, one per line, in a directory watched by the file
source (Kafka or Kinesis is a source swap). Every step is a Column
expression, so the same ``decode_records`` + ``score_decoded`` run on a batch
DataFrame and on a streaming one.

A record that cannot be scored is split off with a reason instead of
stopping the batch. Decisions go to an append-only log, one folder per
micro-batch, overwritten on replay; readers take the latest decision per
transaction (``current_decisions``), which is the upsert.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import scoring
from ledgerlake.functions.scalars import hour_of, ts_literal
from ledgerlake.plans import pipeline

ENVELOPE_SCHEMA = "kinesis STRUCT<data: STRING, sequenceNumber: STRING>"
# JSON value types that compare as numbers, and error reasons.
NUMERIC_TYPES = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*|BOOLEAN)$"
ERR_BASE64 = "not_base64"
ERR_JSON = "not_json_object"
ERR_TXN_ID = "missing_transaction_id"
ERR_CUSTOMER = "missing_customer_id"
ERR_AMOUNT = "bad_amount"
ERR_DEVICE = "bad_device_id"
ERR_LAT = "bad_location_lat"
STREAM_SOURCE = "fraud_stream"
MAX_FILES_PER_TRIGGER = 1000


KEYS = ("transaction_id", "customer_id", "amount", "merchant", "category", "timestamp",
        "device_id", "location_lat", "location_lng", "is_fraud", "currency")
TYPED_KEYS = ("amount", "timestamp", "device_id", "location_lat")


def decode_records(records: DataFrame, data: str = "kinesis.data",
                   seq: str = "kinesis.sequenceNumber") -> DataFrame:
    """Envelope -> base64 -> JSON object -> typed columns plus ``error``.

    Absent keys take the reference defaults (amount and ids excepted, which
    are errors); a key present with JSON null is an error for amount,
    device and latitude, and gives hour 12 for the timestamp. The parse,
    the field lookups and their JSON types are separate projections, so no
    expression is evaluated twice. ``error`` depends, in form only, on the
    partition: Spark moves a filter on it through projections of deterministic
    columns down to the scan, where each branch of it would parse the record anew.
    """
    raw = F.col(data)
    binary = F.try_to_binary(raw, F.lit("base64"))
    # sequence numbers are text: they may have far more digits than a bigint
    parsed = records.select(F.col(seq).alias("seq"), raw.alias("data"),
                            binary.isNotNull().alias("_b64"),
                            F.try_parse_json(binary.cast("string")).alias("_v"))
    # one lookup turns the object into a struct of variants (null when the
    # document is not an object); only the checked fields get a type probe
    shape = "struct<" + ", ".join(f"{k}: variant" for k in KEYS) + ">"
    fields = parsed.select(
        "seq", "data", "_b64",
        F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)).alias("_obj"),
        F.try_variant_get("_v", "$", shape).alias("_s"))
    typed = fields.select(
        "seq", "data", "_b64", "_obj",
        *[F.col(f"_s.{k}").alias(f"_f_{k}") for k in KEYS],
        *[F.schema_of_variant(F.col(f"_s.{k}")).alias(f"_t_{k}") for k in TYPED_KEYS])

    def present(n):
        return F.col(f"_f_{n}").isNotNull()

    def is_num(n):
        return F.coalesce(F.col(f"_t_{n}").rlike(NUMERIC_TYPES), F.lit(False))

    def is_str(n):
        return F.coalesce(F.col(f"_t_{n}") == "STRING", F.lit(False))

    def get(n, t):
        return F.try_variant_get(F.col(f"_f_{n}"), "$", t)

    error = (F.when(~F.col("_b64"), F.lit(ERR_BASE64))
             .when(~F.col("_obj"), F.lit(ERR_JSON))
             .when(~present("amount") | ~is_num("amount"), F.lit(ERR_AMOUNT))
             .when(present("device_id") & ~is_str("device_id"), F.lit(ERR_DEVICE))
             .when(present("location_lat") & ~is_num("location_lat"), F.lit(ERR_LAT))
             .when(~present("transaction_id"), F.lit(ERR_TXN_ID))
             .when(~present("customer_id"), F.lit(ERR_CUSTOMER)))

    # true for every row, and no constant to the optimizer
    always = F.spark_partition_id() >= 0

    def text_or(n, default):
        return F.when(~present(n), F.lit(default)).when(is_str(n), get(n, "string"))

    return typed.select(
        "seq", "data",
        get("transaction_id", "string").alias("transaction_id"),
        get("customer_id", "string").alias("customer_id"),
        F.when(is_num("amount"), get("amount", "double")).alias("amount"),
        F.when(~present("merchant"), F.lit("")).otherwise(get("merchant", "string"))
        .alias("merchant"),
        get("category", "string").alias("category"),
        text_or("timestamp", "").alias("timestamp"),
        text_or("device_id", "").alias("device_id"),
        F.when(~present("location_lat"), F.lit(0.0))
        .when(is_num("location_lat"), get("location_lat", "double")).alias("location_lat"),
        get("location_lng", "double").alias("location_lng"),
        F.when(~present("is_fraud"), F.lit(0)).otherwise(get("is_fraud", "int"))
        .alias("is_fraud"),
        get("currency", "string").alias("currency"),
        F.when(always, error).alias("error"),
    )


def score_decoded(decoded: DataFrame) -> DataFrame:
    """Score columns for valid rows (invalid rows keep nulls)."""
    scored = scoring.score_columns(decoded, hour_of("timestamp", is_text=True))
    ok = F.col("error").isNull()
    return scored.select(
        *[c for c in decoded.columns],
        F.when(ok, F.col("fraud_score")).alias("fraud_score"),
        F.when(ok, F.col("reasons")).alias("reasons"),
        F.when(ok, F.col("decision")).alias("decision"))


def batch_metric_columns() -> list[Column]:
    ok = F.col("error").isNull()
    d = F.col("decision")
    return [F.count_if(ok).alias("processed"), F.count_if(ok & (d == "ALLOW")).alias("allowed"),
            F.count_if(ok & (d == "FLAG")).alias("flagged"),
            F.count_if(ok & (d == "BLOCK")).alias("blocked"),
            F.count_if(~ok).alias("errors")]


def batch_metrics(scored: DataFrame) -> DataFrame:
    return scored.agg(*batch_metric_columns())


def decisions(scored: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Decision records of the valid rows, with the arrival sequence."""
    valid = scored.filter(F.col("error").isNull())
    return scoring.decision_rows(valid, F.col("timestamp"), processed_at, extra=["seq"])


def error_rows(scored: DataFrame, processed_at: dt.datetime) -> DataFrame:
    return scored.filter(F.col("error").isNotNull()).select(
        "seq", "data", "transaction_id", F.lit(STREAM_SOURCE).alias("source"),
        F.col("error").alias("reason"), ts_literal(processed_at).alias("dlq_timestamp"))


def latest_per_key(decided: DataFrame) -> DataFrame:
    """Upsert semantics inside one input: the last arrival per transaction."""
    return pipeline.last_arrival(decided, [])


# ---- the streaming job ---------------------------------------------------------------

def start_scoring_stream(spark: SparkSession, source_dir: str, decisions_path: str,
                         dlq_path: str, checkpoint: str, processed_at: dt.datetime,
                         available_now: bool = True,
                         max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                         metrics_path: str | None = None):
    """readStream -> decode -> score -> foreachBatch(log + DLQ + counters).

    ``max_files_per_trigger`` bounds a batch, so a backlog is read in many.
    The counters of each batch are a row of the table at ``metrics_path``
    (default: beside the decision log), keyed by batch: a replay replaces it.
    """
    metrics = metrics_path or f"{decisions_path.rstrip('/')}_metrics"
    reader = spark.readStream.schema(ENVELOPE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_decoded(decode_records(reader.json(source_dir)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            pipeline.append_decisions(decisions(batch, processed_at), decisions_path, batch_id)
            errors = error_rows(batch, processed_at).withColumn("batch_id", F.lit(batch_id))
            (errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(dlq_path))
            (batch_metrics(batch).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(metrics))
        finally:
            batch.unpersist()

    writer = (scored.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


METRICS_SCHEMA = ("processed LONG, allowed LONG, flagged LONG, blocked LONG, errors LONG, "
                  "batch_id LONG")


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The counters of every batch a stream has written, one row per batch."""
    return spark.read.schema(METRICS_SCHEMA).parquet(path).select(
        "batch_id", "processed", "allowed", "flagged", "blocked", "errors")
