"""Rule-based fraud score as Column expressions.

The same columns serve a batch DataFrame and a streaming one; no UDF is
involved, so scoring runs inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import json_string_array, money_text, ts_literal

# Fixed values of the rule engine: thresholds, points, reason labels and
# decision cut-offs.
KNOWN_DEVICE_PREFIX = "device-"
AMOUNT_VERY_HIGH, AMOUNT_HIGH, AMOUNT_ELEVATED = 100000, 50000, 20000
POINTS_VERY_HIGH, POINTS_HIGH, POINTS_ELEVATED = 50, 30, 15
HOUR_MIDNIGHT, HOUR_EARLY = 5, 7
POINTS_MIDNIGHT, POINTS_EARLY = 25, 10
POINTS_UNKNOWN_DEVICE = 20
LAT_HIGH, LAT_LOW = 30, 10
POINTS_LOCATION = 10
POINTS_HIGH_AMOUNT_UNKNOWN_DEVICE = 15
POINTS_HIGH_AMOUNT_MIDNIGHT = 15
SCORE_CAP = 100
BLOCK_AT, FLAG_AT = 70, 40
MODEL_VERSION = "rule-engine-v1"


def _rules(amount: Column, hour: Column, device: Column, lat: Column):
    """(condition, points, reason) in rule order; tiers are exclusive.

    NaN compares false everywhere, as in plain float arithmetic (Spark
    itself orders NaN above every number), so it is turned into null first.
    """
    amount = F.when(~F.isnan(amount), amount)
    lat = F.when(~F.isnan(lat), lat)
    known = F.coalesce(device.startswith(KNOWN_DEVICE_PREFIX), F.lit(False))
    amt = money_text(amount)
    h = hour.cast("string")
    return [
        (amount > AMOUNT_VERY_HIGH, POINTS_VERY_HIGH,
         F.concat(F.lit("very_high_amount:"), amt)),
        ((amount <= AMOUNT_VERY_HIGH) & (amount > AMOUNT_HIGH), POINTS_HIGH,
         F.concat(F.lit("high_amount:"), amt)),
        ((amount <= AMOUNT_HIGH) & (amount > AMOUNT_ELEVATED), POINTS_ELEVATED,
         F.concat(F.lit("elevated_amount:"), amt)),
        (hour < HOUR_MIDNIGHT, POINTS_MIDNIGHT,
         F.concat(F.lit("midnight_transaction:hour_"), h)),
        ((hour >= HOUR_MIDNIGHT) & (hour < HOUR_EARLY), POINTS_EARLY,
         F.concat(F.lit("early_morning:hour_"), h)),
        (~known, POINTS_UNKNOWN_DEVICE, F.lit("unknown_device")),
        ((lat > LAT_HIGH) | (lat < LAT_LOW), POINTS_LOCATION,
         F.concat(F.lit("unusual_location:"), lat.cast("string"))),
        ((amount > AMOUNT_HIGH) & ~known, POINTS_HIGH_AMOUNT_UNKNOWN_DEVICE,
         F.lit("high_amount_unknown_device")),
        ((amount > AMOUNT_ELEVATED) & (hour < HOUR_MIDNIGHT), POINTS_HIGH_AMOUNT_MIDNIGHT,
         F.lit("high_amount_midnight")),
    ]


def fraud_score(amount: Column, hour: Column, device: Column, lat: Column) -> Column:
    """Additive score, capped; a rule whose inputs are null adds nothing."""
    return _score_from([cond for cond, _, _ in _rules(amount, hour, device, lat)])


def _score_from(flags: list[Column]) -> Column:
    points = [F.when(f, F.lit(p)).otherwise(F.lit(0))
              for f, (_, p, _) in zip(flags, _rules(F.lit(0.0), F.lit(12), F.lit(""),
                                                     F.lit(20.0)))]
    total = points[0]
    for p in points[1:]:
        total = total + p
    return F.least(total, F.lit(SCORE_CAP))


def fraud_reasons(amount: Column, hour: Column, device: Column, lat: Column) -> Column:
    """array<string> of the reasons that fired, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, text)
                                     for cond, _, text in _rules(amount, hour, device, lat)]))


def fraud_decision(score: Column) -> Column:
    return (F.when(score >= BLOCK_AT, "BLOCK").when(score >= FLAG_AT, "FLAG")
            .otherwise("ALLOW"))


def score_columns(df: DataFrame, hour: Column) -> DataFrame:
    """Add fraud_score, reasons (array) and decision.

    The rule flags are computed once in their own projection and the score
    and reasons read them, which keeps each generated method small enough
    for whole-stage codegen.
    """
    cols = df.columns
    staged = df.select("*", hour.alias("_hour"))
    rules = _rules(F.col("amount"), F.col("_hour"), F.col("device_id"), F.col("location_lat"))
    flagged = staged.select("*", *[cond.alias(f"_rule{i}") for i, (cond, _, _) in
                                   enumerate(rules)])
    flags = [F.col(f"_rule{i}") for i in range(len(rules))]
    scored = flagged.select(
        *cols, _score_from(flags).alias("fraud_score"),
        F.array_compact(F.array(*[F.when(f, text) for f, (_, _, text) in zip(flags, rules)]))
        .alias("reasons"))
    return scored.select("*", fraud_decision(F.col("fraud_score")).alias("decision"))


def decision_rows(scored: DataFrame, timestamp_text: Column,
                  processed_at: dt.datetime, extra: list[str] = ()) -> DataFrame:
    """The 11-column decision record, one per transaction."""
    return scored.select(
        "transaction_id", "customer_id",
        money_text("amount").alias("amount"),
        "merchant", "fraud_score", "decision",
        json_string_array("reasons").alias("reasons"),
        F.col("is_fraud").cast("int").alias("actual_fraud"),
        timestamp_text.alias("timestamp"),
        ts_literal(processed_at).alias("processed_at"),
        F.lit(MODEL_VERSION).alias("model_version"),
        *extra,
    )
