"""Bronze -> silver cleaning: dedup, rule split, masking, stamps.

Dedup is a hash aggregate (``max`` of a struct) rather than a window: the
partial aggregate collapses each key inside every map task before the
shuffle, so a key that holds a third of all rows (null ids included) costs
one row per task, not one giant sorted group.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import date_literal, ts_literal

# Fixed values of the silver layer.
PII_COLUMNS = ("email", "phone", "name", "address")
DLQ_REASON = "validation_failed"
DLQ_SOURCES = {"transactions": "transactions", "customers": "customers",
               "kyc": "kyc", "support_tickets": "tickets"}


def dedup_by_key(df: DataFrame, key: str, order_by: Sequence[str] = (),
                 count_as: str | None = None) -> DataFrame:
    """One row per ``key`` (null is one key): the row that is greatest by
    ``order_by`` descending, then by every other column descending, with
    nulls lowest. Deterministic, unlike ``dropDuplicates``. ``count_as``
    adds the number of input rows of each key."""
    rest = [c for c in df.columns if c != key and c not in order_by]
    packed = F.struct(*[F.col(c) for c in (*order_by, *rest)])
    aggs = [F.max(packed).alias("_row")]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    kept = df.groupBy(key).agg(*aggs)
    return kept.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c)
                         for c in df.columns], *([count_as] if count_as else []))


def all_rules(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good passes every rule; bad is every other row, a null
    verdict included. Both are filters over one input, no join."""
    ok = all_rules(rules)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def transaction_rules(reject_nan: bool = False) -> dict[str, Column]:
    rules = {
        "transaction_id_not_null": F.col("transaction_id").isNotNull(),
        "customer_id_not_null": F.col("customer_id").isNotNull(),
        "amount_not_null": F.col("amount").isNotNull(),
        "amount_positive": F.col("amount") > 0,
        "timestamp_not_null": F.col("timestamp").isNotNull(),
    }
    if reject_nan:
        rules["amount_not_nan"] = ~F.isnan("amount")
    return rules


def customer_rules() -> dict[str, Column]:
    return {"customer_id_not_null": F.col("customer_id").isNotNull(),
            "signup_date_not_null": F.col("signup_date").isNotNull()}


def kyc_rules() -> dict[str, Column]:
    return {"customer_id_not_null": F.col("customer_id").isNotNull(),
            "kyc_status_not_null": F.col("kyc_status").isNotNull()}


def ticket_rules() -> dict[str, Column]:
    return {"ticket_id_not_null": F.col("ticket_id").isNotNull(),
            "customer_id_not_null": F.col("customer_id").isNotNull()}


def validate_transactions(df, reject_nan: bool = False):
    return split_by_rules(df, transaction_rules(reject_nan))


def validate_customers(df):
    return split_by_rules(df, customer_rules())


def validate_kyc(df):
    return split_by_rules(df, kyc_rules())


def validate_tickets(df):
    return split_by_rules(df, ticket_rules())


def mask_pii(df: DataFrame, columns: Sequence[str] = PII_COLUMNS) -> DataFrame:
    """Replace each PII column by ``<c>_masked`` = SHA-256 hex (null stays
    null); the masked columns go last, in the order given."""
    present = [c for c in columns if c in df.columns]
    return df.select(*[c for c in df.columns if c not in present],
                     *[F.sha2(F.col(c).cast("string"), 256).alias(f"{c}_masked")
                       for c in present])


def stamp_silver(df: DataFrame, run_date: dt.date, run_ts: dt.datetime) -> DataFrame:
    return df.select("*", date_literal(run_date).alias("processed_date"),
                     ts_literal(run_ts).alias("silver_timestamp"))


def dlq_rows(bad: DataFrame, source: str, run_ts: dt.datetime,
             reason: str = DLQ_REASON) -> DataFrame:
    return bad.select("*", F.lit(source).alias("source"), F.lit(reason).alias("reason"),
                      ts_literal(run_ts).alias("dlq_timestamp"))


# Composite silver jobs: each returns (silver rows, dead-letter rows).
# ``prepare`` is applied to the deduplicated rows before the split; the daily
# job passes a persist so the two writes share one dedup shuffle.

def _same(df: DataFrame) -> DataFrame:
    return df


def silver_transactions(bronze: DataFrame, run_date, run_ts, reject_nan=False,
                        prepare=_same):
    deduped = prepare(dedup_by_key(bronze, "transaction_id", _txn_order(bronze)))
    good, bad = validate_transactions(deduped, reject_nan)
    return (stamp_silver(good, run_date, run_ts),
            dlq_rows(bad, DLQ_SOURCES["transactions"], run_ts))


def _txn_order(df: DataFrame) -> list[str]:
    return [c for c in ("timestamp", "copy") if c in df.columns]


def silver_customers(bronze: DataFrame, run_date, run_ts, prepare=_same):
    # Masking runs before the split so no raw PII reaches the dead letters.
    masked = prepare(mask_pii(dedup_by_key(bronze, "customer_id")))
    good, bad = validate_customers(masked)
    return (stamp_silver(good, run_date, run_ts),
            dlq_rows(bad, DLQ_SOURCES["customers"], run_ts))


def silver_kyc(bronze: DataFrame, run_date, run_ts, prepare=_same):
    good, bad = validate_kyc(prepare(dedup_by_key(bronze, "customer_id")))
    return (stamp_silver(good, run_date, run_ts),
            dlq_rows(bad, DLQ_SOURCES["kyc"], run_ts))


def silver_support_tickets(bronze: DataFrame, run_date, run_ts, prepare=_same):
    good, bad = validate_tickets(prepare(dedup_by_key(bronze, "ticket_id", ["created_date"])))
    return (stamp_silver(good, run_date, run_ts),
            dlq_rows(bad, DLQ_SOURCES["support_tickets"], run_ts))


def row_counts(bronze: DataFrame, key: str, order_by: Sequence[str],
               rules: dict[str, Column]) -> DataFrame:
    """Rows in, rows after dedup, duplicates removed, good and bad rows,
    from one aggregate pass over the deduplicated rows."""
    ok = F.coalesce(all_rules(rules), F.lit(False))
    deduped = dedup_by_key(bronze, key, order_by, count_as="_n")
    return deduped.agg(
        F.sum("_n").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_deduped"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(ok).alias("good_rows"),
        F.count_if(~ok).alias("bad_rows"),
    )
