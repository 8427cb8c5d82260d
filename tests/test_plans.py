"""Plan-shape checks for the scale claims in the README."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlake.operators import clean, erasure, profiling
from ledgerlake.plans import defaults as D, registry as R
from ledgerlake.sources import lake as L
from ledgerlake.streaming import fraud_stream as FS, velocity


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_window_and_partial_aggregates(spark):
    p = plan(E.queries()["gold_customer_360"](spark, SF_SMALL))
    assert "Window" not in p and "Expand" not in p
    assert "partial_max" in p and "partial_count" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedup_collapses_hot_key_map_side(spark):
    rows = [(None if i % 3 == 0 else i, float(i)) for i in range(3000)]  # a third null
    df = spark.createDataFrame(rows, "transaction_id long, amount double")
    out = clean.dedup_by_key(df, "transaction_id", ["amount"])
    p = plan(out)
    assert "Window" not in p and "partial_max" in p
    assert out.count() == 2001
    assert out.filter(F.col("transaction_id").isNull()).first()["amount"] == 2997.0


def test_profile_has_no_expand(spark):
    p = plan(profiling.profile_columns(R.bronze_tables(spark, SF_SMALL)["transactions"], "t"))
    assert "Expand" not in p


def test_day_scan_lists_and_reads_one_day(spark):
    lake = R.seed_bronze(spark, SF_SMALL)
    root = lake.bronze_path("transactions")
    df = L.scan_parquet_day(spark, root, D.DAY).select("amount")
    assert "ReadSchema: struct<amount:double>" in df._jdf.queryExecution().executedPlan().toString()
    files = df.inputFiles()
    assert files and all(L.day_folder("", D.DAY) in f for f in files)
    assert len(files) < len(spark.read.parquet(root).inputFiles())


def test_erasure_leaves_the_join_to_spark(spark):
    big = spark.range(10000).select(F.col("id").alias("customer_id"))
    keys = spark.range(0, 10000, 7).select(F.col("id").alias("customer_id"))
    out = erasure.anti_join_delete(big, keys)
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == big.count() - keys.count()


def test_erasure_reads_only_the_days_that_hold_the_keys(spark):
    lake = R.own_lake(spark, SF_SMALL)
    t = lake.table("silver", "transactions")
    one = t.read().filter("customer_id is not null").select("customer_id", "transaction_date") \
        .first()
    days = {r[0] for r in t.read().filter(F.col("customer_id") == one[0])
            .select("transaction_date").distinct().collect()}
    files = {r[0]: r[1] for r in t.read().select(F.input_file_name(), "transaction_date")
             .distinct().collect()}
    erasure.erase_table(t, spark.createDataFrame([(one[0],)], "customer_id bigint"))
    after = {r[0] for r in t.read().select(F.input_file_name()).distinct().collect()}
    assert {f for f, d in files.items() if d not in days} == after.intersection(files)


def test_a_record_is_parsed_once_whatever_is_filtered(spark):
    """A filter on the error must not be moved below the parse, which it would repeat."""
    records = R.landed_records(spark, SF_SMALL)
    decided = FS.decisions(FS.score_decoded(FS.decode_records(records)), D.RUN_TS)
    for df in (decided, velocity.event_rows(FS.decode_records(records))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1


def test_rewrite_delete_builds_only_the_table_it_rewrites(spark, monkeypatch):
    monkeypatch.setattr(R, "_FIXTURES", {})
    left = R.q_rewrite_delete(spark, SF_SMALL)
    assert left.count() > 0
    assert {k[2] for k in R._FIXTURES} == {"silver_transactions"}
    held = R.own_lake(spark, SF_SMALL)  # the larger seed takes that table over
    assert held.table("silver", "transactions").read().count() > left.count()
