"""Registered queries on keyed stream state, event-time windows and stream joins.

Records arrive in three portions by event time. Each is landed after the stream
has finished the one before and stopped, so every query below also runs through
two restarts from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import history
from ledgerlake.plans import defaults as D
from ledgerlake.plans.registry import _fixture, register
from ledgerlake.session import scratch_path
from ledgerlake.sources import bindings as B
from ledgerlake.sources import lake as L
from ledgerlake.streaming import enrich, velocity, windows

ARRIVALS = 3
LATENESS_H = 72
HOUR_MS = 3_600_000
WINDOWS = {
    "tumbling": windows.Windows("tumbling", 6 * HOUR_MS),
    "sliding": windows.Windows("sliding", 12 * HOUR_MS, 4 * HOUR_MS),
    "session": windows.Windows("session", 3 * HOUR_MS),
}
WINDOW_GROUP = {"tumbling": "category", "sliding": "merchant", "session": "customer_id"}


def arrivals(spark, sf_dir, of=B.arriving_records):
    """The arrivals' files, one folder each (landed once per session)."""
    def land(spark, sf_dir):
        path = scratch_path(spark, "arrivals")
        of(spark, sf_dir).write.partitionBy("arrival").json(path)
        return path
    return _fixture(spark, sf_dir, f"arrivals-{of.__name__}", land)


def run_through(spark, sf_dir, start, tag: str, sources=None) -> str:
    """Land each arrival in the watched folders and run the stream until it has read them.

    ``start`` gets the stream's folder and the number of the arrival.
    """
    root = scratch_path(spark, tag)
    landed = {name: arrivals(spark, sf_dir, of)
              for name, of in (sources or {"incoming": B.arriving_records}).items()}
    for k in range(1, ARRIVALS + 1):
        for name, path in landed.items():
            spark.read.text(f"{path}/arrival={k}").write.mode("append").text(f"{root}/{name}")
        start(root, k).awaitTermination()
    return root


@register("stream_velocity")
def q_stream_velocity(spark, sf_dir):
    """Features of every record; those behind the watermark are marked late."""
    root = run_through(spark, sf_dir, lambda root, _: velocity.start_velocity_stream(
        spark, f"{root}/incoming", f"{root}/features", f"{root}/checkpoint",
        f"{LATENESS_H} hours"), "velocity")
    return spark.read.parquet(f"{root}/features").drop("batch_id")


@register("velocity_history")
def q_velocity_history(spark, sf_dir):
    """The same features over the finished table."""
    rows = B.transactions(spark, sf_dir).select(
        "transaction_id", "customer_id", F.col("timestamp").alias("event_time"),
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("event_ms"),
        (F.col("amount").cast("decimal(18,2)") * 100).cast("long").alias("cents"))
    return velocity.batch_features(rows).select(
        "transaction_id", "customer_id", "event_time", *velocity.feature_columns())


def _window_run(spark, sf_dir, kind):
    def run(spark, sf_dir):
        return run_through(spark, sf_dir, lambda root, _: windows.start_window_stream(
            spark, f"{root}/incoming", f"{root}/windows", f"{root}/late", f"{root}/checkpoint",
            WINDOWS[kind], WINDOW_GROUP[kind], f"{LATENESS_H} hours"), f"windows-{kind}")
    return _fixture(spark, sf_dir, f"windows-{kind}", run)


@register("stream_tumbling_windows")
def q_stream_tumbling_windows(spark, sf_dir):
    return windows.closed_windows(spark, f"{_window_run(spark, sf_dir, 'tumbling')}/windows")


@register("stream_sliding_windows")
def q_stream_sliding_windows(spark, sf_dir):
    return windows.closed_windows(spark, f"{_window_run(spark, sf_dir, 'sliding')}/windows",
                                  "merchant")


@register("stream_session_windows")
def q_stream_session_windows(spark, sf_dir):
    return windows.closed_windows(spark, f"{_window_run(spark, sf_dir, 'session')}/windows",
                                  "customer_id")


@register("stream_late_records")
def q_stream_late_records(spark, sf_dir):
    """Records that sliding windows no longer took, with the number of windows missed."""
    return windows.late_table(spark, f"{_window_run(spark, sf_dir, 'sliding')}/late", "merchant")


@register("stream_enriched")
def q_stream_enriched(spark, sf_dir):
    """Decisions with the kyc table as it stood when they arrived: before each arrival the table
    is loaded anew, while the stream goes on from its checkpoint."""
    kyc = L.Lake.scratch(spark, "enrich").table("silver", "kyc")

    def start(root, arrival):
        kyc.write_snapshot(B.kyc_load(spark, sf_dir, arrival - 1))
        return enrich.start_enriched_stream(
            spark, f"{root}/incoming", kyc.read, ["kyc_status", "risk_tier"], f"{root}/out",
            f"{root}/checkpoint", D.RUN_TS)

    root = run_through(spark, sf_dir, start, "enriched")
    return spark.read.parquet(f"{root}/out").select(
        "transaction_id", "seq", "customer_id", "decision", "fraud_score", "kyc_status",
        "risk_tier")


@register("stream_enriched_as_of")
def q_stream_enriched_as_of(spark, sf_dir):
    """Decisions with the kyc version that held on their day, from the type-2 history."""
    kyc = L.Lake.scratch(spark, "enrich").table("silver", "kyc_history")
    for load, day in enumerate(B.HISTORY_LOADS):
        history.load_history(kyc, B.kyc_load(spark, sf_dir, load), "customer_id", day)
    root = run_through(spark, sf_dir, lambda root, _: enrich.start_enriched_stream(
        spark, f"{root}/incoming", kyc.read, ["kyc_status", "risk_tier"], f"{root}/out",
        f"{root}/checkpoint", D.RUN_TS, as_of=True), "enriched-as-of")
    return spark.read.parquet(f"{root}/out").select(
        "transaction_id", "seq", "customer_id", "decision", "kyc_status", "risk_tier")


@register("stream_labels")
def q_stream_labels(spark, sf_dir):
    """Decisions joined with the fraud labels that came within 72 hours."""
    root = run_through(
        spark, sf_dir, lambda root, _: enrich.start_label_stream(
            spark, f"{root}/incoming", f"{root}/labels", f"{root}/out", f"{root}/checkpoint",
            D.RUN_TS), "labels",
        {"incoming": B.first_records, "labels": B.arriving_labels})
    return spark.read.parquet(f"{root}/out").filter(F.col("transaction_id") != "closing") \
        .drop("batch_id")
