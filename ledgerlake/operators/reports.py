"""The three stored analyst queries, as SQL text and as DataFrame plans.

The SQL files take their inputs as DataFrame arguments of ``spark.sql``, so
no named view is left behind in the session. Both forms give the same
optimized plan; top-k runs as ``TakeOrderedAndProject`` (a per-partition
heap of k rows, then one merge), never a full sort.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import count_when, money_avg, money_sum, ratio_pct

# Fixed values of the stored queries.
TOP_MERCHANTS_LIMIT = 10
HIGH_RISK_LIMIT = 100
HIGH_RISK_TIER = "HIGH"
HIGH_RISK_FRAUD_RATE = 10
HIGH_RISK_COLUMNS = ("customer_id", "total_transactions", "total_spend", "fraud_txn_count",
                     "fraud_rate", "risk_tier", "kyc_status", "total_tickets")


def sql_text(name: str) -> str:
    return resources.files("ledgerlake.sql").joinpath(f"{name}.sql").read_text()


def run_sql(spark: SparkSession, name: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(sql_text(name), **frames)


def sql_daily_fraud_summary(spark, transactions: DataFrame) -> DataFrame:
    return run_sql(spark, "daily_fraud_summary", transactions=transactions)


def sql_top_merchants(spark, transactions: DataFrame) -> DataFrame:
    return run_sql(spark, "top_merchants", transactions=transactions)


def sql_high_risk_customers(spark, customer_360: DataFrame) -> DataFrame:
    return run_sql(spark, "high_risk_customers", customer_360=customer_360)


# DataFrame forms of the same queries.

def daily_fraud_summary(txn: DataFrame) -> DataFrame:
    fraud = F.col("is_fraud") == 1
    out = txn.groupBy("transaction_date").agg(
        F.count("transaction_id").alias("total_transactions"),
        money_sum("amount").alias("total_amount"),
        count_when(fraud).alias("fraud_count"),
        F.round(money_avg("amount"), 2).alias("avg_amount"),
    )
    return (out.select("*", ratio_pct("fraud_count", "total_transactions")
                       .alias("fraud_rate_pct"))
            .orderBy(F.col("transaction_date").desc()))


def merchant_totals(txn: DataFrame) -> DataFrame:
    return txn.groupBy("merchant", "category").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.round(money_sum("amount"), 2).alias("total_amount"),
        F.round(money_avg("amount"), 2).alias("avg_amount"),
        count_when(F.col("is_fraud") == 1).alias("fraud_count"),
    )


def top_merchants(txn: DataFrame, k: int = TOP_MERCHANTS_LIMIT) -> DataFrame:
    return (merchant_totals(txn)
            .orderBy(F.col("total_amount").desc_nulls_last(), "merchant", "category")
            .limit(k))


def high_risk_filter() -> Column:
    return ((F.col("risk_tier") == HIGH_RISK_TIER)
            | (F.col("fraud_rate") > HIGH_RISK_FRAUD_RATE))


def high_risk_customers(c360: DataFrame, k: int | None = HIGH_RISK_LIMIT) -> DataFrame:
    out = c360.filter(high_risk_filter()).select(*HIGH_RISK_COLUMNS)
    if k is None:
        return out
    return out.orderBy(F.col("fraud_rate").desc_nulls_last(), "customer_id").limit(k)
