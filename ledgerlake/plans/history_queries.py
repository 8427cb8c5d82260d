"""Registered queries on type-2 history, point-in-time joins, mergeable daily state and the
steps of erasure batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import clean, erasure, history, marts, sketches
from ledgerlake.plans import defaults as D
from ledgerlake.plans import pipeline
from ledgerlake.plans.registry import (own_lake, register, requests_df, silver_tickets,
                                       silver_transactions)
from ledgerlake.sources import bindings as B
from ledgerlake.sources import lake as L

LOADS = range(len(B.HISTORY_LOADS))


def customer_360_load(spark, sf_dir, load, silver=None):
    """customer_360 as of a load's day: transactions up to it, kyc and customers as then.

    ``silver`` are the stored silver transactions and tickets; without it both are computed."""
    day = B.HISTORY_LOADS[load]
    all_txn, tickets = silver or (silver_transactions(spark, sf_dir), silver_tickets(spark, sf_dir))
    customers = clean.silver_customers(B.customers_load(spark, sf_dir, load), day, D.RUN_TS)[0]
    kyc = clean.silver_kyc(B.kyc_load(spark, sf_dir, load), day, D.RUN_TS)[0]
    txn = all_txn.filter(F.col("transaction_date") <= F.lit(day))
    return marts.customer_360_from_summary(
        customers, kyc, marts.transaction_summary(txn, distinct="narrow"), tickets, day, D.RUN_TS)


def stored_silver(lake, spark, sf_dir):
    """The silver transactions and tickets, written once: every load reads the transactions
    twice, and would clean them and the tickets anew each time."""
    for name, rows in (("transactions", silver_transactions(spark, sf_dir)),
                       ("support_tickets", silver_tickets(spark, sf_dir))):
        lake.table("silver", name).write_snapshot(rows)
    return tuple(lake.table("silver", n).read() for n in ("transactions", "support_tickets"))


@register("customer_360_history")
def q_customer_360_history(spark, sf_dir):
    """Every version of every customer after three loads, the last of them run twice."""
    lake = L.Lake.scratch(spark, "history")
    table, silver = lake.table("gold", "customer_360_history"), stored_silver(lake, spark, sf_dir)
    for load in (*LOADS, LOADS[-1]):
        history.load_history(table, customer_360_load(spark, sf_dir, load, silver), "customer_id",
                             B.HISTORY_LOADS[load])
    return table.read().select(
        "customer_id", "valid_from", "valid_to", "is_current", "kyc_status", "risk_tier",
        "total_transactions", "total_spend", "fraud_rate", "unique_merchants", "email_masked")


def kyc_history(spark, sf_dir):
    table = L.Lake.scratch(spark, "kyc-history").table("silver", "kyc_history")
    for load in LOADS:
        history.load_history(
            table, clean.silver_kyc(B.kyc_load(spark, sf_dir, load), B.HISTORY_LOADS[load],
                                    D.RUN_TS)[0], "customer_id", B.HISTORY_LOADS[load])
    return table.read()


@register("asof_transactions")
def q_asof_transactions(spark, sf_dir):
    """Each transaction with the kyc status and risk tier that held at its time."""
    at = lambda c: F.col(c).cast("timestamp_ntz")
    versions = kyc_history(spark, sf_dir).withColumn("since", at("valid_from")) \
        .withColumn("until", at("valid_to"))
    facts = silver_transactions(spark, sf_dir).select(
        "transaction_id", "customer_id", "timestamp", "amount")
    return history.asof_join(facts, versions, "customer_id", "timestamp", "since",
                             ["kyc_status", "risk_tier"], "until")


@register("valid_at_day")
def q_valid_at_day(spark, sf_dir):
    """The kyc table as it was on a day between two loads."""
    return history.valid_at(kyc_history(spark, sf_dir), B.HISTORY_LOADS[1]).select(
        "customer_id", "kyc_status", "risk_tier", "valid_from", "valid_to")


@register("erasure_steps")
def q_erasure_steps(spark, sf_dir):
    """The steps of one erasure batch, as its ledger has them."""
    lake = own_lake(spark, sf_dir)
    pipeline.run_erasure(spark, lake, requests_df(spark, sf_dir), D.RUN_TS, B.customer_key)
    return erasure.stored_steps(spark, lake.steps_path()).select(
        "batch_id", "step", "status", "rows_before", "rows_deleted", "at")


@register("erasure_sla")
def q_erasure_sla(spark, sf_dir):
    """Whether each request was, or still can be, served by its deadline."""
    lake = own_lake(spark, sf_dir)
    out = pipeline.run_erasure(spark, lake, requests_df(spark, sf_dir), D.RUN_TS, B.customer_key)
    return erasure.sla_status(out["requests"], F.lit(D.RUN_TS)).select(
        "customer_id", "requested_at", "status", "sla_deadline", "completed_at", "sla")


# How far an estimate may be from the exact distinct count.
SKETCH_ERROR = 0.02


@register("customer_sketches")
def q_customer_sketches(spark, sf_dir):
    """The summary from sketches: silver up to the last load but one, then that load's days one
    by one as daily runs; with whether each distinct count is within 2 % of the exact one."""
    lake = L.Lake.scratch(spark, "sketches")
    table, txn = lake.table("silver", "transactions"), silver_transactions(spark, sf_dir)
    last = txn.agg(F.max("transaction_date")).first()[0]
    first = F.col("transaction_date") < F.lit(last)
    table.write_snapshot(txn.filter(first), "transaction_date")
    if not table.read().isEmpty():
        pipeline.update_sketches(lake, last)
    table.replace_partitions(txn.filter(~first), "transaction_date", days=[last])
    as_of = pipeline.update_sketches(lake, last)
    state = lake.table(*pipeline.SKETCH_TABLE).read().filter(F.col("as_of") == F.lit(as_of))
    found = sketches.summary_from_state(state.drop("as_of"))
    exact = marts.distinct_counts(table.read()).select(
        F.col("customer_id").alias("_id"), *[F.col(n).alias(f"exact_{n}")
                                             for _, n in marts.DISTINCT_DIMENSIONS[1:]])
    close = [(F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.col(f"exact_{n}") * SKETCH_ERROR)
             .alias(f"{n}_close") for _, n in marts.DISTINCT_DIMENSIONS[1:]]
    return found.join(exact, F.col("customer_id") == F.col("_id")).select(
        "customer_id", "total_transactions", "total_spend", "active_days", "fraud_rate",
        "latest_location_lat", *[f"exact_{n}" for _, n in marts.DISTINCT_DIMENSIONS[1:]], *close)
