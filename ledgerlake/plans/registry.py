"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each callable reads the driver tables through the bindings, so its work grows
with them. Names match the operator ids of the design inventory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.functions import families, scoring
from ledgerlake.functions.scalars import hour_of, json_string_array
from ledgerlake.functions.scalars import ts_literal
from ledgerlake.operators import clean, erasure, marts, notify, profiling, quality, reports
from ledgerlake.plans import defaults as D
from ledgerlake.plans import pipeline
from ledgerlake.sources import bindings as B
from ledgerlake.sources import lake as L
from ledgerlake.session import scratch_path
from ledgerlake.streaming import fraud_stream as FS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- silver inputs shared by many queries ---------------------------------

def silver_transactions(spark, sf_dir):
    return clean.silver_transactions(B.transactions(spark, sf_dir), D.RUN_DATE, D.RUN_TS)[0]


def silver_customers(spark, sf_dir):
    return clean.silver_customers(B.customers(spark, sf_dir), D.RUN_DATE, D.RUN_TS)[0]


def silver_kyc(spark, sf_dir):
    return clean.silver_kyc(B.kyc(spark, sf_dir), D.RUN_DATE, D.RUN_TS)[0]


def silver_tickets(spark, sf_dir):
    return clean.silver_support_tickets(B.support_tickets(spark, sf_dir),
                                        D.RUN_DATE, D.RUN_TS)[0]


def gold_customer_360_df(spark, sf_dir):
    return marts.customer_360(silver_customers(spark, sf_dir), silver_kyc(spark, sf_dir),
                              silver_transactions(spark, sf_dir),
                              silver_tickets(spark, sf_dir), D.RUN_DATE, D.RUN_TS)


# ---- gold -------------------------------------------------------------------

def _clean_silver(spark, sf_dir):
    """The silver tables of the clean transactions, stored once per session."""
    def build(spark, sf_dir):
        lake = L.Lake.scratch(spark, "clean-silver")
        lake.table("silver", "transactions").write_snapshot(
            silver_transactions(spark, sf_dir), partition_by="transaction_date")
        lake.table("silver", "customers").write_snapshot(silver_customers(spark, sf_dir))
        lake.table("silver", "kyc").write_snapshot(silver_kyc(spark, sf_dir))
        lake.table("silver", "support_tickets").write_snapshot(silver_tickets(spark, sf_dir))
        return lake
    return _fixture(spark, sf_dir, "clean_silver", build)


@register("gold_customer_360")
def q_gold_customer_360(spark, sf_dir):
    """From stored silver, as the gold job reads it."""
    return pipeline.customer_360_of(_clean_silver(spark, sf_dir), D.RUN_DATE, D.RUN_TS)


@register("gold_customer_360_raw")
def q_gold_customer_360_raw(spark, sf_dir):
    """From the raw tables: dedup, validation and masking in the same plan, nothing stored."""
    return gold_customer_360_df(spark, sf_dir)


@register("agg_transaction_summary")
def q_agg_transaction_summary(spark, sf_dir):
    return marts.transaction_summary(silver_transactions(spark, sf_dir))


@register("agg_ticket_summary")
def q_agg_ticket_summary(spark, sf_dir):
    return marts.ticket_summary(silver_tickets(spark, sf_dir))


@register("join_left_kyc")
def q_join_left_kyc(spark, sf_dir):
    return marts.join_left_kyc(silver_customers(spark, sf_dir), silver_kyc(spark, sf_dir))


def _join_txn(spark, sf_dir):
    return marts.join_left_summary(
        marts.join_left_kyc(silver_customers(spark, sf_dir), silver_kyc(spark, sf_dir)),
        marts.transaction_summary(silver_transactions(spark, sf_dir)))


@register("join_left_txn_summary")
def q_join_left_txn_summary(spark, sf_dir):
    return _join_txn(spark, sf_dir)


def _join_all(spark, sf_dir):
    return marts.join_left_summary(_join_txn(spark, sf_dir),
                                   marts.ticket_summary(silver_tickets(spark, sf_dir)))


@register("join_left_ticket_summary")
def q_join_left_ticket_summary(spark, sf_dir):
    return _join_all(spark, sf_dir)


@register("select_columns")
def q_select_columns(spark, sf_dir):
    return silver_kyc(spark, sf_dir).select(*marts.KYC_COLUMNS)


@register("scd2_stamp")
def q_scd2_stamp(spark, sf_dir):
    return marts.scd2_stamp(_join_all(spark, sf_dir), D.RUN_DATE, D.RUN_TS)


@register("fill_defaults")
def q_fill_defaults(spark, sf_dir):
    return marts.fill_defaults(_join_all(spark, sf_dir))


@register("agg_daily")
def q_agg_daily(spark, sf_dir):
    return marts.daily_aggregates(silver_transactions(spark, sf_dir), D.RUN_TS)


@register("agg_regulatory")
def q_agg_regulatory(spark, sf_dir):
    return marts.regulatory_reports(silver_transactions(spark, sf_dir), D.RUN_TS)


@register("report_stamp")
def q_report_stamp(spark, sf_dir):
    return marts.regulatory_report(silver_transactions(spark, sf_dir), D.DAY, D.RUN_TS)


@register("filter_day")
def q_filter_day(spark, sf_dir):
    from pyspark.sql import functions as F
    from ledgerlake.functions.scalars import date_literal
    return silver_transactions(spark, sf_dir).filter(
        F.col("transaction_date") == date_literal(D.DAY))


# ---- stored SQL and top-k ---------------------------------------------------

@register("sql_daily_fraud_summary")
def q_sql_daily_fraud_summary(spark, sf_dir):
    return reports.sql_daily_fraud_summary(spark, silver_transactions(spark, sf_dir))


@register("order_desc")
def q_order_desc(spark, sf_dir):
    return reports.daily_fraud_summary(silver_transactions(spark, sf_dir))


@register("sql_top_merchants")
def q_sql_top_merchants(spark, sf_dir):
    return reports.sql_top_merchants(spark, silver_transactions(spark, sf_dir))


@register("topk_merchants")
def q_topk_merchants(spark, sf_dir):
    return reports.top_merchants(silver_transactions(spark, sf_dir))


@register("topk_high_risk")
def q_topk_high_risk(spark, sf_dir):
    return reports.sql_high_risk_customers(spark, gold_customer_360_df(spark, sf_dir))


@register("filter_or")
def q_filter_or(spark, sf_dir):
    return reports.high_risk_customers(gold_customer_360_df(spark, sf_dir), k=None)


# ---- cleaning (dirty transactions) -------------------------------------------

def dirty_deduped(spark, sf_dir):
    bronze = B.dirty_transactions(spark, sf_dir)
    return clean.dedup_by_key(bronze, "transaction_id", ["timestamp", "copy"])


@register("dedup_by_key")
def q_dedup_by_key(spark, sf_dir):
    return dirty_deduped(spark, sf_dir)


@register("validate_transactions")
def q_validate_transactions(spark, sf_dir):
    return clean.validate_transactions(dirty_deduped(spark, sf_dir))[0]


@register("except_distinct")
def q_except_distinct(spark, sf_dir):
    deduped = dirty_deduped(spark, sf_dir)
    good = clean.validate_transactions(deduped)[0]
    return deduped.subtract(good)


@register("validate_customers")
def q_validate_customers(spark, sf_dir):
    return clean.validate_customers(B.customers(spark, sf_dir))[0]


@register("validate_kyc")
def q_validate_kyc(spark, sf_dir):
    return clean.validate_kyc(B.kyc(spark, sf_dir))[0]


@register("validate_tickets")
def q_validate_tickets(spark, sf_dir):
    return clean.validate_tickets(B.support_tickets(spark, sf_dir))[0]


@register("mask_pii")
def q_mask_pii(spark, sf_dir):
    return clean.mask_pii(B.customers(spark, sf_dir))


@register("stamp_silver")
def q_stamp_silver(spark, sf_dir):
    return clean.stamp_silver(B.transactions(spark, sf_dir), D.RUN_DATE, D.RUN_TS)


@register("silver_transactions")
def q_silver_transactions(spark, sf_dir):
    return clean.silver_transactions(B.dirty_transactions(spark, sf_dir),
                                     D.RUN_DATE, D.RUN_TS)[0]


@register("silver_customers")
def q_silver_customers(spark, sf_dir):
    return silver_customers(spark, sf_dir)


@register("silver_kyc")
def q_silver_kyc(spark, sf_dir):
    return silver_kyc(spark, sf_dir)


@register("silver_support_tickets")
def q_silver_support_tickets(spark, sf_dir):
    return silver_tickets(spark, sf_dir)


@register("row_count_metrics")
def q_row_count_metrics(spark, sf_dir):
    return clean.row_counts(B.dirty_transactions(spark, sf_dir), "transaction_id",
                            ["timestamp", "copy"], clean.transaction_rules())


# ---- fraud scoring (batch) ---------------------------------------------------

def scored_transactions(spark, sf_dir):
    from pyspark.sql import functions as F
    txn = silver_transactions(spark, sf_dir)
    return scoring.score_columns(txn, hour_of("timestamp", is_text=False)), F


@register("fraud_score")
def q_fraud_score(spark, sf_dir):
    scored, F = scored_transactions(spark, sf_dir)
    return scored.select("transaction_id", "fraud_score",
                         json_string_array("reasons").alias("reasons"))


@register("fraud_decision")
def q_fraud_decision(spark, sf_dir):
    scored, F = scored_transactions(spark, sf_dir)
    return scored.select("transaction_id", "fraud_score", "decision")


@register("fraud_result_row")
def q_fraud_result_row(spark, sf_dir):
    scored, F = scored_transactions(spark, sf_dir)
    return scoring.decision_rows(scored, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
                                 D.RUN_TS)


# ---- quality -------------------------------------------------------------------

def _day(df):
    from pyspark.sql import functions as F
    from ledgerlake.functions.scalars import date_literal
    return df.filter(F.col("transaction_date") == date_literal(D.DAY))


def _silver_dirty(spark, sf_dir):
    return clean.silver_transactions(B.dirty_transactions(spark, sf_dir), D.RUN_DATE,
                                     D.RUN_TS)[0]


def dq_suites(spark, sf_dir):
    return {
        "bronze_transactions": (_day(B.dirty_transactions(spark, sf_dir)),
                                quality.bronze_transactions_rules()),
        "silver_transactions": (_day(_silver_dirty(spark, sf_dir)),
                                quality.silver_transactions_rules()),
        "silver_customers": (silver_customers(spark, sf_dir), quality.silver_customers_rules()),
        "gold_customer_360": (gold_customer_360_df(spark, sf_dir),
                              quality.gold_customer_360_rules()),
    }


def _suite(name):
    def run(spark, sf_dir):
        df, rules = dq_suites(spark, sf_dir)[name]
        return quality.run_suite(spark, name, df, rules)
    return run


for _name in ("bronze_transactions", "silver_transactions", "silver_customers",
              "gold_customer_360"):
    register(f"dq_{_name}")(_suite(_name))


def dq_all(spark, sf_dir):
    out = None
    for name, (df, rules) in dq_suites(spark, sf_dir).items():
        r = quality.run_suite(spark, name, df, rules)
        out = r if out is None else out.unionByName(r)
    return out


@register("dq_engine")
def q_dq_engine(spark, sf_dir):
    return dq_all(spark, sf_dir)


@register("dq_report")
def q_dq_report(spark, sf_dir):
    return quality.suite_verdicts(dq_all(spark, sf_dir))


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    return quality.run_suite(spark, "gate", _day(_silver_dirty(spark, sf_dir)),
                             quality.gate_rules())


# ---- profiling -----------------------------------------------------------------

def bronze_tables(spark, sf_dir):
    return {"transactions": B.dirty_transactions(spark, sf_dir),
            "customers": B.customers(spark, sf_dir), "kyc": B.kyc(spark, sf_dir),
            "support_tickets": B.support_tickets(spark, sf_dir)}


@register("profile_columns")
def q_profile_columns(spark, sf_dir):
    out = None
    for name, df in bronze_tables(spark, sf_dir).items():
        p = profiling.profile_columns(df, name)
        out = p if out is None else out.unionByName(p)
    return out


@register("profile_duplicates")
def q_profile_duplicates(spark, sf_dir):
    keys = {"transactions": "transaction_id", "customers": "customer_id",
            "kyc": "customer_id", "support_tickets": "ticket_id"}
    out = None
    for name, df in bronze_tables(spark, sf_dir).items():
        p = profiling.profile_duplicates(df, name, keys[name])
        out = p if out is None else out.unionByName(p)
    return out


@register("profile_distribution")
def q_profile_distribution(spark, sf_dir):
    t = bronze_tables(spark, sf_dir)
    parts = [
        profiling.profile_distribution(spark, t["transactions"], "transactions", "is_fraud",
                                       profiling.FRAUD_LABELS, profiling.FRAUD_OTHER),
        profiling.profile_distribution(spark, t["kyc"], "kyc", "kyc_status"),
        profiling.profile_distribution(spark, t["kyc"], "kyc", "risk_tier"),
        profiling.profile_distribution(spark, t["support_tickets"], "support_tickets",
                                       "category"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("profile_layer_totals")
def q_profile_layer_totals(spark, sf_dir):
    return profiling.profile_layer_totals(bronze_tables(spark, sf_dir))


# ---- lake sources and sinks (write, then read back) ---------------------------------

# Fixture lakes are built once per session and input folder. Queries read
# them (bronze), or take their tables over by reference into a lake of their
# own (erasure), so every call sees the same starting state.
_FIXTURES: dict[tuple, object] = {}


def _fixture(spark, sf_dir, kind, build):
    key = (id(getattr(spark, "_jsparkSession", spark)), sf_dir.rstrip("/"), kind)
    if key not in _FIXTURES:
        _FIXTURES[key] = build(spark, sf_dir)
    return _FIXTURES[key]


def seed_bronze(spark, sf_dir, tag="lake"):
    """The landed raw files of ``sf_dir`` (written once per session)."""
    return _fixture(spark, sf_dir, "bronze", _build_bronze)


def _build_bronze(spark, sf_dir):
    """A fresh lake under the shared folder with the raw files landed."""
    lake = L.Lake.scratch(spark, "bronze")
    L.write_bronze_days(B.dirty_transactions(spark, sf_dir), lake.bronze_path("transactions"))
    for name, fn in (("customers", B.customers), ("kyc", B.kyc),
                     ("support_tickets", B.support_tickets)):
        L.write_bronze_entity(fn(spark, sf_dir), lake.bronze_path(name))
    return lake


def seed_silver_gold(spark, sf_dir, tag="lake"):
    """Silver and gold tables of all days (written once per session)."""
    return _fixture(spark, sf_dir, "silver_gold", _build_silver_gold)


def seed_silver_transactions(spark, sf_dir):
    """A lake with the silver transactions of all days and nothing else (written once per
    session)."""
    return _fixture(spark, sf_dir, "silver_transactions", _build_silver_transactions)


def _build_silver_transactions(spark, sf_dir):
    lake = L.Lake.scratch(spark, "silver-transactions")
    lake.table("silver", "transactions").write_snapshot(
        _silver_dirty(spark, sf_dir), partition_by="transaction_date")
    return lake


def _build_silver_gold(spark, sf_dir):
    lake = L.Lake.scratch(spark, "silver-gold").share(seed_silver_transactions(spark, sf_dir))
    lake.table("silver", "customers").write_snapshot(silver_customers(spark, sf_dir))
    lake.table("silver", "kyc").write_snapshot(silver_kyc(spark, sf_dir))
    lake.table("silver", "support_tickets").write_snapshot(silver_tickets(spark, sf_dir))
    pipeline.run_gold_customer_360(spark, lake, D.RUN_DATE, D.RUN_TS, incremental=True)
    return lake


def own_lake(spark, sf_dir, seed=seed_silver_gold):
    """A lake of its own that starts with the seed's tables."""
    return L.Lake.scratch(spark, "own").share(seed(spark, sf_dir))


def _week(day):
    import datetime as dt
    return [day - dt.timedelta(days=i) for i in range(6, -1, -1)]


@register("scan_parquet_day")
def q_scan_parquet_day(spark, sf_dir):
    lake = seed_bronze(spark, sf_dir)
    return L.scan_parquet_day(spark, lake.bronze_path("transactions"), D.DAY)


@register("scan_parquet")
def q_scan_parquet(spark, sf_dir):
    lake = seed_bronze(spark, sf_dir)
    return L.scan_parquet(spark, lake.bronze_path("customers"))


@register("scan_parquet_listing")
def q_scan_parquet_listing(spark, sf_dir):
    lake = seed_bronze(spark, sf_dir)
    return L.scan_parquet_listing(spark, lake.bronze_path("transactions"))


@register("scan_multi_day_union")
def q_scan_multi_day_union(spark, sf_dir):
    lake = seed_bronze(spark, sf_dir)
    days = _week(D.DAY)
    return L.scan_day_range(spark, lake.bronze_path("transactions"), days[0], days[-1])


@register("union_files")
def q_union_files(spark, sf_dir):
    lake = seed_bronze(spark, sf_dir)
    root = lake.bronze_path("transactions")
    return L.union_frames([L.scan_parquet_day(spark, root, d) for d in _week(D.DAY)])


@register("scan_lake_table")
def q_scan_lake_table(spark, sf_dir):
    lake = L.Lake.scratch(spark)
    t = lake.table("silver", "customers")
    t.write_snapshot(silver_customers(spark, sf_dir))
    return t.read()


@register("write_silver_append")
def q_write_silver_append(spark, sf_dir):
    """Every day loaded, then the whole load run again: still one copy."""
    lake = L.Lake.scratch(spark)
    t = lake.table("silver", "transactions")
    for _ in range(2):
        t.replace_partitions(_silver_dirty(spark, sf_dir), "transaction_date")
    return t.read()


@register("write_gold_overwrite")
def q_write_gold_overwrite(spark, sf_dir):
    """All days written, then one day recomputed: only that day replaced."""
    lake = L.Lake.scratch(spark)
    t = lake.table("gold", "daily_aggregates")
    txn = silver_transactions(spark, sf_dir)
    t.replace_partitions(marts.daily_aggregates(txn, D.RUN_TS), "transaction_date")
    t.replace_partitions(marts.daily_aggregates(txn, D.RUN_TS, D.DAY), "transaction_date",
                         days=[D.DAY])
    return t.read()


@register("write_dlq")
def q_write_dlq(spark, sf_dir):
    lake = L.Lake.scratch(spark)
    bad = clean.silver_transactions(B.dirty_transactions(spark, sf_dir), D.RUN_DATE,
                                    D.RUN_TS)[1]
    t = lake.table("dlq", "transactions")
    for _ in range(2):
        L.write_dlq(bad, t, D.RUN_DATE)
    return t.read()


# ---- erasure ------------------------------------------------------------------------

def requests_df(spark, sf_dir):
    return B.deletion_requests(spark, sf_dir)


@register("scan_pending_requests")
def q_scan_pending_requests(spark, sf_dir):
    return erasure.pending_requests(requests_df(spark, sf_dir))


@register("validate_request")
def q_validate_request(spark, sf_dir):
    return erasure.validate_requests(requests_df(spark, sf_dir), ts_literal(D.RUN_TS))


@register("intake_request")
def q_intake_request(spark, sf_dir):
    return erasure.intake_requests(requests_df(spark, sf_dir).select("customer_id",
                                                                     "requested_at"))


@register("insert_request")
def q_insert_request(spark, sf_dir):
    """The accepted requests, inserted in two goes; the second brings some again."""
    lake = L.Lake.scratch(spark)
    accepted = erasure.intake_requests(
        requests_df(spark, sf_dir).select("customer_id", "requested_at")) \
        .filter("status_code = 200").drop("status_code")
    pipeline.insert_requests(lake, accepted.filter("second(requested_at) % 2 = 0"))
    pipeline.insert_requests(lake, accepted)
    return lake.table("control", "deletion_requests").read()


def _erasure_keys(spark, sf_dir):
    return erasure.erasure_keys(erasure.pending_requests(requests_df(spark, sf_dir)),
                                B.customer_key)


@register("filter_not_in")
def q_filter_not_in(spark, sf_dir):
    return erasure.anti_join_delete(silver_customers(spark, sf_dir),
                                    _erasure_keys(spark, sf_dir))


@register("anti_join_delete")
def q_anti_join_delete(spark, sf_dir):
    return erasure.anti_join_delete(_silver_dirty(spark, sf_dir), _erasure_keys(spark, sf_dir))


def _updated(requests):
    pending = erasure.pending_requests(requests)
    ok = erasure.well_formed(B.customer_key)
    return erasure.update_request_status(requests, pending.filter(ok), D.AUDIT_KEY, D.RUN_TS,
                                         pending.filter(~ok))


@register("update_by_key")
def q_update_by_key(spark, sf_dir):
    return _updated(requests_df(spark, sf_dir))


@register("update_request_status")
def q_update_request_status(spark, sf_dir):
    t = L.Lake.scratch(spark).table("control", "deletion_requests")
    t.write_snapshot(requests_df(spark, sf_dir))
    t.write_snapshot(_updated(t.read()))
    return t.read()


@register("rewrite_delete")
def q_rewrite_delete(spark, sf_dir):
    """The table after the erasure; one that fails raises, as the rows would still be there."""
    lake = own_lake(spark, sf_dir, seed_silver_transactions)
    erasure.erase_from_lake(lake, _erasure_keys(spark, sf_dir),
                            targets=[("silver", "transactions", "silver_transactions")])
    return lake.table("silver", "transactions").read()


@register("gdpr_delete_batch")
def q_gdpr_delete_batch(spark, sf_dir):
    rows = erasure.erase_from_lake(own_lake(spark, sf_dir), _erasure_keys(spark, sf_dir),
                                   partial=True)
    return erasure.summary_frame(spark, rows)


@register("gdpr_run")
def q_gdpr_run(spark, sf_dir):
    """The stored requests after the run."""
    out = pipeline.run_erasure(spark, own_lake(spark, sf_dir), requests_df(spark, sf_dir),
                               D.RUN_TS, B.customer_key)
    # the audit key names a folder of this run's scratch lake, so it is left out
    return out["requests"].drop("audit_log_key")


@register("write_audit_json")
def q_write_audit_json(spark, sf_dir):
    """The audit as read back: each erased request with its batch's header."""
    from pyspark.sql import functions as F
    out = pipeline.run_erasure(spark, own_lake(spark, sf_dir), requests_df(spark, sf_dir),
                               D.RUN_TS, B.customer_key)
    header = spark.read.schema(erasure.AUDIT_SCHEMA).json(f"{out['audit_key']}/header")
    ids = spark.read.schema(erasure.AUDIT_IDS_SCHEMA).json(f"{out['audit_key']}/ids")
    deleted = F.aggregate(F.map_values("deletion_summary"), F.lit(0).cast("long"),
                          lambda n, x: n + x)
    return ids.join(header.select(
        "batch_id", "processed_at", "total_requests", "status",
        F.size("deletion_summary").alias("n_tables"), deleted.alias("rows_deleted")), "batch_id")


@register("render_notification")
def q_render_notification(spark, sf_dir):
    reqs = requests_df(spark, sf_dir)
    intake = erasure.intake_requests(reqs.select("customer_id", "requested_at"))
    verdicts = quality.suite_verdicts(dq_all(spark, sf_dir))
    return (notify.request_received(intake, D.RUN_TS)
            .unionByName(notify.deletion_complete(erasure.pending_requests(reqs).filter(
                erasure.well_formed(B.customer_key)), D.RUN_TS))
            .unionByName(notify.quality_failure(verdicts, D.DAY, D.RUN_TS))
            .unionByName(notify.pipeline_failure(spark, "daily_pipeline", "silver", D.DAY,
                                                 D.RUN_TS))
            .unionByName(notify.pipeline_success(spark, "daily_pipeline", D.DAY, D.RUN_TS)))


# ---- streaming (batch twins and the streaming run) --------------------------------------

DECODED_COLUMNS = ["seq", "transaction_id", "customer_id", "amount", "merchant", "category",
                   "timestamp", "device_id", "location_lat", "location_lng", "is_fraud",
                   "currency", "error"]


def landed_records(spark, sf_dir):
    """The stream fixture as the source sees it: JSON envelope lines in the
    shared folder, one sub-folder per delivery (landed once per session)."""
    path = _fixture(spark, sf_dir, "records", _land_records)
    return spark.read.schema(FS.ENVELOPE_SCHEMA + ", delivery INT").json(path)


def _land_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    B.stream_records(spark, sf_dir).write.partitionBy("delivery").json(path)
    return path


def _land_incoming(spark, sf_dir):
    """The two deliveries as files in one watched folder, the second landed
    after the first (landed once per session)."""
    from pyspark.sql import functions as F
    path = scratch_path(spark, "incoming")
    records = B.stream_records(spark, sf_dir)
    for delivery in (1, 2):
        (records.filter(F.col("delivery") == delivery).select("kinesis")
         .write.mode("append").json(path))
    return path


def stream_scored(spark, sf_dir):
    return FS.score_decoded(FS.decode_records(landed_records(spark, sf_dir)))


@register("stream_decode")
def q_stream_decode(spark, sf_dir):
    return FS.decode_records(landed_records(spark, sf_dir)).select(*DECODED_COLUMNS)


@register("stream_error_split")
def q_stream_error_split(spark, sf_dir):
    return FS.error_rows(stream_scored(spark, sf_dir), D.RUN_TS).drop("data")


@register("batch_metrics")
def q_batch_metrics(spark, sf_dir):
    return FS.batch_metrics(stream_scored(spark, sf_dir))


@register("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    return FS.latest_per_key(FS.decisions(stream_scored(spark, sf_dir), D.RUN_TS)).drop("seq")


@register("upsert_decisions")
def q_upsert_decisions(spark, sf_dir):
    """Two deliveries appended as two batches of the decision log."""
    from pyspark.sql import functions as F
    path = scratch_path(spark, "decisions")
    records = landed_records(spark, sf_dir)
    for batch_id, delivery in enumerate((1, 2)):
        part = FS.score_decoded(FS.decode_records(
            records.filter(F.col("delivery") == delivery)))
        pipeline.append_decisions(FS.decisions(part, D.RUN_TS), path, batch_id)
    return pipeline.current_decisions(spark, path)


def run_stream_fixture(spark, sf_dir):
    """Score the landed deliveries with readStream into a fresh decision log
    (new checkpoint per call, so every call processes all files)."""
    incoming = _fixture(spark, sf_dir, "incoming", _land_incoming)
    root = scratch_path(spark, "stream")
    query = FS.start_scoring_stream(spark, incoming, f"{root}/decisions",
                                    f"{root}/dlq", f"{root}/checkpoint", D.RUN_TS)
    query.awaitTermination()
    return root, query


@register("stream_json_source")
def q_stream_json_source(spark, sf_dir):
    root, _ = run_stream_fixture(spark, sf_dir)
    return pipeline.current_decisions(spark, f"{root}/decisions")


@register("stream_metrics")
def q_stream_metrics(spark, sf_dir):
    root, _ = run_stream_fixture(spark, sf_dir)
    return FS.stored_metrics(spark, f"{root}/decisions_metrics")


# ---- scalar function families ---------------------------------------------------

@register("f_text")
def q_f_text(spark, sf_dir):
    return families.text_functions(B.transactions(spark, sf_dir))


@register("f_numeric")
def q_f_numeric(spark, sf_dir):
    return families.numeric_functions(B.transactions(spark, sf_dir))


@register("f_time")
def q_f_time(spark, sf_dir):
    return families.time_functions(B.transactions(spark, sf_dir), D.RUN_TS)


@register("f_codec")
def q_f_codec(spark, sf_dir):
    return families.codec_functions(B.transactions(spark, sf_dir))


# ---- catalog and the daily run ------------------------------------------------------

@register("catalog_register")
def q_catalog_register(spark, sf_dir):
    """The registered transactions; the other three datasets are counted beside them."""
    from pyspark.sql import functions as F
    lake = L.Lake.scratch(spark, bronze_root=seed_bronze(spark, sf_dir).bronze_path(""))
    database = pipeline.refresh_catalog(spark, lake)
    out = spark.table(f"{database}.transactions")
    for entity in pipeline.BRONZE_ENTITIES:
        n = spark.table(f"{database}.{entity}").agg(F.count(F.lit(1)).alias(f"n_{entity}"))
        out = out.join(F.broadcast(n))  # one row
    return out


# FIXTURES: the reference's 1000 rows per day do not fit ~330 events a day at
# sf0.01, so the registered daily run gates at 100 rows.
DAILY_RUN_MIN_ROWS = 100


@register("daily_run")
def q_daily_run(spark, sf_dir):
    lake = L.Lake.scratch(spark, bronze_root=seed_bronze(spark, sf_dir).bronze_path(""))
    pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS, min_rows=DAILY_RUN_MIN_ROWS)
    return lake.table("gold", "regulatory_reports").read()


def _daily_lake(spark, sf_dir):
    """One daily run, made once per session; the queries below read what it wrote."""
    def build(spark, sf_dir):
        lake = L.Lake.scratch(spark, bronze_root=seed_bronze(spark, sf_dir).bronze_path(""))
        pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS, min_rows=DAILY_RUN_MIN_ROWS)
        return lake
    return _fixture(spark, sf_dir, "daily", build)


DAILY_TABLES = {
    "daily_silver_transactions": ("silver", "transactions"),
    "daily_silver_customers": ("silver", "customers"),
    "daily_silver_kyc": ("silver", "kyc"),
    "daily_silver_support_tickets": ("silver", "support_tickets"),
    "daily_customer_360": ("gold", "customer_360"),
    "daily_aggregates": ("gold", "daily_aggregates"),
    "daily_dlq_transactions": ("dlq", "transactions"),
}


def _daily_table(layer, name):
    def read(spark, sf_dir):
        return _daily_lake(spark, sf_dir).table(layer, name).read()
    return read


for _name, _table in DAILY_TABLES.items():
    register(_name)(_daily_table(*_table))


# ---- gold composites written to the lake -------------------------------------------

def _silver_lake(spark, sf_dir):
    lake = L.Lake.scratch(spark)
    lake.table("silver", "transactions").write_snapshot(
        _silver_dirty(spark, sf_dir), partition_by="transaction_date")
    return lake


@register("gold_daily_aggregates")
def q_gold_daily_aggregates(spark, sf_dir):
    """Filter the run day, aggregate, replace that day of the gold table."""
    lake = _silver_lake(spark, sf_dir)
    silver = lake.table("silver", "transactions").read()
    lake.table("gold", "daily_aggregates").replace_partitions(
        marts.daily_aggregates(silver, D.RUN_TS, D.DAY), "transaction_date", days=[D.DAY])
    return lake.table("gold", "daily_aggregates").read()


@register("gold_regulatory_report")
def q_gold_regulatory_report(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    silver = lake.table("silver", "transactions").read()
    lake.table("gold", "regulatory_reports").replace_partitions(
        marts.regulatory_report(silver, D.DAY, D.RUN_TS), "report_date", days=[D.DAY])
    return lake.table("gold", "regulatory_reports").read()
