"""Projections that exercise each scalar-function family on transactions.

Every column is a built-in Spark expression; the families mirror the scalar
functions the jobs use (hashing, prefixes, slicing, money text, labels, ids;
rounding, division, tiers, caps, fills, membership; hours, date shifts,
formats, literals; base64, JSON fields, arrays and maps).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import hour_of, money_text, ts_literal

# Fixed values used by the projections.
LOW_TOUCH_CATEGORIES = ("click", "purchase")
MERCHANT_UNKNOWN = "unknown"


def text_functions(txn: DataFrame) -> DataFrame:
    date_text = F.col("transaction_date").cast("string")
    return txn.select(
        "transaction_id",
        F.sha2(F.col("device_id"), 256).alias("device_hash"),
        F.col("device_id").startswith("device-").alias("known_device"),
        F.substring(date_text, 1, 4).alias("txn_year"),
        F.substring(date_text, 6, 2).alias("txn_month"),
        F.substring(date_text, 9, 2).alias("txn_day"),
        money_text("amount").alias("amount_text"),
        F.substring(date_text, 1, 7).alias("month_sample"),
        F.when(F.col("is_fraud") == 1, "FRAUD").otherwise("NORMAL").alias("fraud_label"),
        F.concat_ws("-", F.lit("TXN"), F.col("transaction_id").cast("string"),
                    F.date_format("timestamp", "yyyyMMdd")).alias("txn_ref"),
    )


def numeric_functions(txn: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return txn.select(
        "transaction_id",
        F.round(amount / 3, 2).alias("amount_third"),
        F.try_divide(amount, F.col("location_lat") - 8).alias("amount_per_lat"),
        F.when(amount > 100000, "very_high").when(amount > 50000, "high")
        .when(amount > 20000, "elevated").otherwise("normal").alias("amount_tier"),
        F.least(amount / 1000, F.lit(100.0)).alias("capped_thousands"),
        F.coalesce(F.when(F.col("merchant") != "m0", F.col("merchant")),
                   F.lit(MERCHANT_UNKNOWN)).alias("merchant_or_unknown"),
        F.col("category").isin(*LOW_TOUCH_CATEGORIES).alias("low_touch"),
        F.col("device_id").isNull().alias("device_missing"),
    )


def time_functions(txn: DataFrame, run_ts: dt.datetime) -> DataFrame:
    ts = F.col("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return txn.select(
        "transaction_id",
        hour_of(iso, is_text=True).alias("hour_from_text"),
        F.date_sub("transaction_date", 1).alias("previous_day"),
        (ts + F.expr("INTERVAL 24 HOURS")).alias("deadline"),
        F.date_format(ts, "yyyyMMddHHmmss").alias("stamp"),
        F.date_format(ts, "yyyyMMdd").alias("day_key"),
        iso.alias("iso_ts"),
        F.lit("9999-12-31").cast("date").alias("open_end"),
        ts_literal(run_ts).alias("run_ts"),
    )


def codec_functions(txn: DataFrame) -> DataFrame:
    b64 = F.base64(F.col("merchant").cast("binary"))
    tags = F.array_compact(F.array(F.when(F.col("is_fraud") == 1, F.lit("fraud")),
                                   F.when(F.col("amount") > 50000, F.lit("big"))))
    attrs = F.map_from_arrays(F.array(F.lit("merchant"), F.lit("category")),
                              F.array(F.col("merchant"), F.col("category")))
    return txn.select(
        "transaction_id",
        b64.alias("merchant_b64"),
        F.try_to_binary(b64, F.lit("base64")).cast("string").alias("merchant_decoded"),
        F.try_to_binary(F.concat(F.lit("!!"), F.col("merchant")), F.lit("base64"))
        .cast("string").alias("junk_decoded"),
        F.get_json_object(F.to_json(F.struct("merchant", "amount")), "$.merchant")
        .alias("merchant_from_json"),
        F.array_join(tags, ",").alias("tags"),
        F.size(tags).alias("n_tags"),
        F.element_at(attrs, F.lit("category")).alias("category_from_map"),
    )
