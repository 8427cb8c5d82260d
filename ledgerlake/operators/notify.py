"""Notification rows for an outbox table (topic, subject, message, created_at).

Delivery is outside Spark; jobs only write these rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import ts_literal

OUTBOX_SCHEMA = "topic STRING, subject STRING, message STRING, created_at TIMESTAMP_NTZ"
# Topics and message texts.
TOPIC_ERASURE = "erasure"
TOPIC_ALERTS = "alerts"
NL = "\n"


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _row(topic: str, subject: Column, message: Column, at: dt.datetime) -> list[Column]:
    return [F.lit(topic).alias("topic"), subject.alias("subject"),
            message.alias("message"), ts_literal(at).alias("created_at")]


def request_received(requests: DataFrame, at: dt.datetime) -> DataFrame:
    """One notice per accepted erasure request."""
    rid, cid = F.col("request_id"), F.col("customer_id")
    msg = F.concat(F.lit("GDPR deletion request received!" + NL + "Customer: "), cid,
                   F.lit(NL + "Request ID: "), rid,
                   F.lit(NL + "SLA deadline: "), iso(F.col("sla_deadline")),
                   F.lit(NL + "Will complete within 24 hours."))
    return requests.filter(rid.isNotNull()).select(
        *_row(TOPIC_ERASURE, F.concat(F.lit("GDPR Request Received: "), rid), msg, at))


def deletion_complete(requests: DataFrame, at: dt.datetime) -> DataFrame:
    """One notice per erased request."""
    rid, cid = F.col("request_id"), F.col("customer_id")
    msg = F.concat(F.lit("Your data deletion is complete!" + NL + "Request ID: "), rid,
                   F.lit(NL + "Customer: "), cid,
                   F.lit(NL + "Completed: "), iso(ts_literal(at)),
                   F.lit(NL + "All your data has been permanently deleted."))
    return requests.select(
        *_row(TOPIC_ERASURE, F.concat(F.lit("GDPR Deletion Complete: "), rid), msg, at))


def quality_failure(verdicts: DataFrame, run_date: dt.date, at: dt.datetime) -> DataFrame:
    """One alert listing the failed suites, or no row when all passed."""
    failed = verdicts.filter(~F.col("passed")).agg(
        F.sort_array(F.collect_list("suite")).alias("suites"))
    msg = F.concat(F.lit(f"DATA QUALITY FAILURE{NL}Date: {run_date.isoformat()}{NL}"
                         "Failed checks: ["),
                   F.array_join(F.transform("suites", lambda s: F.concat(F.lit("'"), s,
                                                                         F.lit("'"))), ", "),
                   F.lit(f"]{NL}Action: Investigate before running ETL!"))
    return failed.filter(F.size("suites") > 0).select(
        *_row(TOPIC_ALERTS, F.lit("DATA QUALITY ALERT"), msg, at))


def pipeline_failure(spark: SparkSession, pipeline: str, step: str, run_date: dt.date,
                     at: dt.datetime) -> DataFrame:
    msg = (f"PIPELINE FAILURE ALERT{NL}Pipeline: {pipeline}{NL}Step: {step}{NL}"
           f"Date: {run_date.isoformat()}{NL}Time: {at.isoformat()}{NL}"
           "Action: Check the job logs.")
    return spark.createDataFrame(
        [(TOPIC_ALERTS, f"ALERT: {pipeline} failed on {step}", msg, at)], OUTBOX_SCHEMA)


def pipeline_success(spark: SparkSession, pipeline: str, run_date: dt.date,
                     at: dt.datetime) -> DataFrame:
    msg = (f"Daily pipeline succeeded.{NL}Date: {run_date.isoformat()}{NL}"
           f"Time: {at.isoformat()}{NL}Gold tables updated.")
    return spark.createDataFrame(
        [(TOPIC_ALERTS, f"SUCCESS: {pipeline}", msg, at)], OUTBOX_SCHEMA)


def write_outbox(df: DataFrame, path: str, key: str) -> None:
    """Put notices into the outbox under the key of what they are about: a rerun replaces
    its own notices and adds none."""
    (df.withColumn("notice_key", F.lit(key)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("notice_key").parquet(path))
