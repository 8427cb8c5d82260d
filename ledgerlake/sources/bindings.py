"""Bindings of the driver tables to the payment entities.

This is the only module that knows the driver's table and column names. Each
function takes a session and a folder of parquet tables and returns a lazy
DataFrame; nothing is read until an action runs, so column pruning and filter
pushdown reach the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the payment data model.
CURRENCY = "INR"
TICKET_CATEGORY_BY_PRIORITY = {
    "1-URGENT": "fraud_report",
    "2-HIGH": "transaction_dispute",
    "3-MEDIUM": "account_blocked",
    "4-NOT SPECIFIED": "payment_failed",
    "5-LOW": "refund_request",
}
TICKET_STATUS_BY_ORDER_STATUS = {"O": "OPEN", "F": "CLOSED", "P": "PENDING"}
CUSTOMER_PREFIX = "CUST"
SIGNUP_EPOCH = dt.date(2020, 1, 1)
REQUEST_EPOCH = "2024-02-01 00:00:00"


_SCANS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The input folders are read-only, so one scan
    DataFrame per session and path is reused (no repeated listing or footer
    reads while plans are built)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(getattr(spark, "_jsparkSession", spark)), path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transactions <- events (one row per event)."""
    ev = table(spark, sf_dir, "events").withColumn("k", _k(F.col("props")))
    return ev.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("value").cast("decimal(18,2)") * F.lit(500))
        .cast("double").alias("amount"),
        F.concat(F.lit("m"), (F.col("k") % 12).cast("string")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("timestamp"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.when(F.col("k") % 10 == 0,
               F.concat(F.lit("x-"), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.lit("device-"), F.col("user_id").cast("string")))
        .alias("device_id"),
        (F.lit(8) + F.col("k") * F.lit(Decimal("0.3"))).cast("double")
        .alias("location_lat"),
        (F.lit(68) + F.col("k") * F.lit(Decimal("0.29"))).cast("double")
        .alias("location_lng"),
        F.when(F.col("k") < 5, 1).otherwise(0).alias("is_fraud"),
        F.lit(CURRENCY).alias("currency"),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transactions with nulls, bad amounts and re-delivered copies.

    ``copy`` = 1 for every original row; rows with ``id % 50 = 1`` (and a
    non-null id) arrive a second time, clean, with ``copy`` = 2.
    """
    t = transactions(spark, sf_dir)
    tid = F.col("transaction_id")
    amount = F.col("amount")
    dirty = t.select(
        F.when(tid % 97 == 0, F.lit(None).cast("bigint")).otherwise(tid)
        .alias("transaction_id"),
        F.when(tid % 89 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(tid % 83 == 0, F.lit(None).cast("double"))
        .when(tid % 79 == 0, -amount)
        .when(tid % 73 == 0, F.lit(0.0))
        .otherwise(amount).alias("amount"),
        *[c for c in t.columns if c not in ("transaction_id", "customer_id", "amount")],
        F.lit(1).alias("copy"),
    )
    copies = (
        t.filter((tid % 50 == 1) & (tid % 97 != 0))
        .withColumn("copy", F.lit(2))
        .select(*dirty.columns)
    )
    return dirty.unionByName(copies)


def customer_ref(key: Column) -> Column:
    """Customer key as the request layer spells it: CUST + 10 digits."""
    return F.concat(F.lit(CUSTOMER_PREFIX), F.lpad(key.cast("string"), 10, "0"))


def customer_key(ref: Column) -> Column:
    """Inverse of customer_ref; null when the text is not of that form."""
    return F.when(ref.startswith(CUSTOMER_PREFIX),
                  F.substring(ref, 5, 64).try_cast("bigint"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers <- customer (PII columns built from the key)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@mail.example"))
        .alias("email"),
        F.concat(F.lit("+91-"), F.lpad(key.cast("string"), 10, "0")).alias("phone"),
        F.concat(key.cast("string"), F.lit(" Market Road")).alias("address"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").cast("string").alias("state"),
        F.lpad((key % 1000000).cast("string"), 6, "0").alias("pincode"),
        F.date_add(F.lit(SIGNUP_EPOCH), (key % 1000).cast("int")).alias("signup_date"),
        F.col("c_acctbal").alias("avg_spend"),
        (F.lit(8) + (key % 100) * F.lit(Decimal("0.3"))).cast("double").alias("home_lat"),
        (F.lit(68) + (key % 100) * F.lit(Decimal("0.29"))).cast("double").alias("home_lng"),
        F.concat(F.lit("device-"), key.cast("string")).alias("device_id"),
        F.when(key % 10 == 0, 0).otherwise(1).alias("is_active"),
    )


def kyc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kyc <- customer (status and tier from the key)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    signup = F.date_add(F.lit(SIGNUP_EPOCH), (key % 1000).cast("int"))
    return c.select(
        key.alias("customer_id"),
        F.when(key % 10 < 7, "VERIFIED").when(key % 10 < 9, "PENDING")
        .otherwise("REJECTED").alias("kyc_status"),
        F.when(key % 20 < 12, "LOW").when(key % 20 < 18, "MEDIUM")
        .otherwise("HIGH").alias("risk_tier"),
        (key % 3 != 0).alias("pan_verified"),
        (key % 4 != 0).alias("aadhar_verified"),
        F.date_add(signup, 7).alias("kyc_date"),
        F.date_add(signup, 7 + 3650).alias("kyc_expiry"),
    )


# How kyc and customers differ between the three loads of the history fixture.
HISTORY_LOADS = (dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 1, 31))
RAISED_MOD, REJECTED_MOD, ABSENT_MOD, GONE_MOD = 7, 11, 13, 97


def kyc_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """kyc as the load 0, 1 or 2 finds it: from 1 on some tiers are raised, from 2 on some
    customers rejected; some rows are missing in load 1 only."""
    key = F.col("customer_id")
    out = kyc(spark, sf_dir)
    if load >= 1:
        out = out.withColumn("risk_tier", F.when(key % RAISED_MOD == 0, "HIGH")
                             .otherwise(F.col("risk_tier")))
    if load >= 2:
        out = out.withColumn("kyc_status", F.when(key % REJECTED_MOD == 0, "REJECTED")
                             .otherwise(F.col("kyc_status")))
    return out.filter(key % ABSENT_MOD != 0) if load == 1 else out


def customers_load(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """customers of a load; some are gone in load 1 and back in load 2."""
    out = customers(spark, sf_dir)
    return out.filter(F.col("customer_id") % GONE_MOD != 0) if load == 1 else out


def _mapped(col: Column, mapping: dict) -> Column:
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(col == src, dst) if expr is None
                else expr.when(col == src, dst))
    return expr


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """support_tickets <- orders (one ticket per order)."""
    o = table(spark, sf_dir, "orders")
    prio = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_custkey").alias("customer_id"),
        _mapped(prio, TICKET_CATEGORY_BY_PRIORITY).alias("category"),
        _mapped(F.col("o_orderstatus"), TICKET_STATUS_BY_ORDER_STATUS).alias("status"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), "HIGH")
        .when(prio == "3-MEDIUM", "MEDIUM").otherwise("LOW").alias("priority"),
        F.col("o_orderdate").cast("date").alias("created_date"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("description"),
    )


def deletion_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Erasure requests: PENDING for every 50th customer, one COMPLETE row,
    one empty id and one id without the CUST prefix."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    requested = F.timestamp_add("SECOND", key, F.lit(REQUEST_EPOCH).cast("timestamp_ntz"))
    pending = c.filter(key % 50 == 0).select(
        customer_ref(key).alias("customer_id"),
        requested.alias("requested_at"),
        F.lit("PENDING").alias("status"),
    )
    extra = c.filter(key == F.lit(1)).select(
        F.explode(F.array(
            F.struct(customer_ref(key).alias("customer_id"), F.lit("COMPLETE").alias("status")),
            F.struct(F.lit("").alias("customer_id"), F.lit("PENDING").alias("status")),
            F.struct(F.concat(F.lit("USER"), F.lpad(key.cast("string"), 10, "0"))
                     .alias("customer_id"), F.lit("PENDING").alias("status")),
        )).alias("r"),
        requested.alias("requested_at"),
    ).select("r.customer_id", "requested_at", "r.status")
    reqs = pending.unionByName(extra)
    return reqs.select(
        "customer_id", "requested_at", "status",
        F.concat(F.lit("GDPR-"), F.col("customer_id"), F.lit("-"),
                 F.date_format("requested_at", "yyyyMMddHHmmss")).alias("request_id"),
        (F.col("requested_at") + F.expr("INTERVAL 24 HOURS")).alias("sla_deadline"),
        F.when(F.col("status") == "COMPLETE",
               F.col("requested_at") + F.expr("INTERVAL 1 HOURS"))
        .otherwise(F.lit(None).cast("timestamp_ntz")).alias("completed_at"),
    )


# Which transaction ids the stream fixture corrupts, and how.
STREAM_FAULTS = (
    (211, "not_base64"),
    (223, "not_json"),
    (227, "amount_text"),
    (229, "amount_null"),
    (233, "amount_absent"),
    (239, "device_null"),
    (241, "device_absent"),
    (251, "timestamp_null"),
)
STREAM_REDELIVERY_MOD, STREAM_REDELIVERY_REM = 50, 7
STREAM_NO_SEQUENCE_MOD = 257


def stream_fault(tid: Column) -> Column:
    expr = None
    for mod, name in STREAM_FAULTS:
        expr = (F.when(tid % mod == 0, F.lit(name)) if expr is None
                else expr.when(tid % mod == 0, F.lit(name)))
    return expr


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream envelopes built from transactions: delivery 1 carries every
    transaction (some corrupted by rule), delivery 2 re-sends every 50th
    with the amount doubled. Timestamps are ISO text with a T."""
    return _stream_records(spark, sf_dir).select("delivery", "kinesis")


# Fixed value: the event day that begins the second arrival; a record sent again comes with the
# arrival after its own.
SECOND_ARRIVAL = dt.date(2024, 1, 16)


def arriving_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_records`` with the arrival (1 to 3) that brings each, by event time."""
    own = F.when(F.col("timestamp") < F.lit(SECOND_ARRIVAL), 1).otherwise(2)
    return _stream_records(spark, sf_dir).select(
        (own + F.col("delivery") - 1).alias("arrival"), "kinesis")


# Which transactions get a fraud label, and up to how many hours later.
LABELLED_MOD, LABEL_HOURS = 3, 120
CLOSING_TIME = "2024-06-01T00:00:00"


def arriving_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels (arrival, transaction_id, labelled_at, fraud), by the time of the label; the third
    arrival is one label of a far later time, which moves the watermark past all others."""
    t = transactions(spark, sf_dir)
    tid = F.col("transaction_id")
    at = F.timestamp_add("HOUR", tid % LABEL_HOURS, F.col("timestamp"))
    own = t.filter(tid % LABELLED_MOD == 0).select(
        F.when(at < F.lit(SECOND_ARRIVAL), 1).otherwise(2).alias("arrival"),
        tid.cast("string").alias("transaction_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("labelled_at"),
        F.col("is_fraud").alias("fraud"))
    return own.unionByName(_closing(t).select(
        F.lit(3).alias("arrival"), F.lit("closing").alias("transaction_id"),
        F.lit(CLOSING_TIME).alias("labelled_at"), F.lit(0).alias("fraud")))


def _closing(t: DataFrame) -> DataFrame:
    """One row, if there are transactions."""
    return t.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")


def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals 1 and 2 of ``arriving_records`` as first sent, and one closing record in 3."""
    own = _stream_records(spark, sf_dir).filter(F.col("delivery") == 1).select(
        F.when(F.col("timestamp") < F.lit(SECOND_ARRIVAL), 1).otherwise(2).alias("arrival"),
        "kinesis")
    doc = F.to_json(F.struct(
        F.lit("closing").alias("transaction_id"), F.lit("closing").alias("customer_id"),
        F.lit(1.0).alias("amount"), F.lit(CLOSING_TIME).alias("timestamp"),
        F.lit("device-closing").alias("device_id"), F.lit(20.0).alias("location_lat")))
    closing = _closing(transactions(spark, sf_dir)).select(
        F.lit(3).alias("arrival"),
        F.struct(F.base64(doc.cast("binary")).alias("data"),
                 F.lit("9").alias("sequenceNumber")).alias("kinesis"))
    return own.unionByName(closing)


def _stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions(spark, sf_dir)
    tid = F.col("transaction_id")
    first = t.withColumn("delivery", F.lit(1))
    again = (t.filter(tid % STREAM_REDELIVERY_MOD == STREAM_REDELIVERY_REM)
             .withColumn("amount", F.col("amount") * 2).withColumn("delivery", F.lit(2)))
    rows = first.unionByName(again).withColumn(
        "fault", F.when(F.col("delivery") == 1, stream_fault(tid)))
    ts_text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    fault = F.col("fault")

    def unless(value, *faults):
        return F.when(fault.isin(*faults), F.lit(None)).otherwise(value)

    doc = F.struct(
        tid.alias("transaction_id"), F.col("customer_id"),
        unless(F.col("amount"), "amount_null", "amount_absent").alias("amount"),
        F.col("merchant"), F.col("category"),
        unless(ts_text, "timestamp_null").alias("timestamp"),
        unless(F.col("device_id"), "device_null", "device_absent").alias("device_id"),
        F.col("location_lat"), F.col("location_lng"), F.col("is_fraud"), F.col("currency"))
    # JSON null for *_null faults; dropping nulls instead makes *_absent
    with_nulls = F.to_json(doc, {"ignoreNullFields": "false"})
    without_nulls = F.to_json(doc, {"ignoreNullFields": "true"})
    json_text = (F.when(fault.isin("amount_absent", "device_absent"), without_nulls)
                 .when(fault == "amount_text",
                       F.regexp_replace(with_nulls, r'"amount":([-0-9.Ee]+)', '"amount":"$1"'))
                 .when(fault == "not_json", F.concat(F.lit("not json "), tid.cast("string")))
                 .otherwise(with_nulls))
    data = (F.when(fault == "not_base64", F.concat(F.lit("!!"), tid.cast("string")))
            .otherwise(F.base64(json_text.cast("binary"))))
    # 56 digits, and absent for some first deliveries
    seq = F.when(~((F.col("delivery") == 1) & (tid % STREAM_NO_SEQUENCE_MOD == 0)),
                 F.concat(F.col("delivery").cast("string"),
                          F.lpad(tid.cast("string"), 55, "0")))
    return rows.select("delivery", "timestamp",
                       F.struct(data.alias("data"), seq.alias("sequenceNumber")).alias("kinesis"))
