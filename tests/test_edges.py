"""Edge frames (FIXTURES C) and metamorphic checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import scoring
from ledgerlake.functions.scalars import hour_of, money_sum, ratio_pct
from ledgerlake.operators import clean, erasure, marts, quality
from ledgerlake.plans import pipeline
from ledgerlake.sources import lake as L
from ledgerlake.streaming import fraud_stream as FS

RUN_DATE = dt.date(2024, 1, 15)
RUN_TS = dt.datetime(2024, 1, 16, 1, 0, 0)
TXN_SCHEMA = ("transaction_id string, customer_id string, amount double, merchant string, "
              "category string, timestamp timestamp_ntz, transaction_date date, device_id string, "
              "location_lat double, location_lng double, is_fraud int, currency string")


def txn(spark, rows):
    base = dict(transaction_id="t", customer_id="c", amount=10.0, merchant="m", category="x",
                timestamp=dt.datetime(2024, 1, 15, 12, 0), transaction_date=RUN_DATE,
                device_id="device-1", location_lat=20.0, location_lng=70.0, is_fraud=0,
                currency="INR")
    cols = [c.split()[0] for c in TXN_SCHEMA.split(", ")]
    data = [tuple({**base, **r}[c] for c in cols) for r in rows]
    return spark.createDataFrame(data, TXN_SCHEMA)


def test_null_key_dedup_keeps_one(spark):
    df = txn(spark, [{"transaction_id": None, "amount": 1.0}, {"transaction_id": None,
                                                                "amount": 2.0}])
    out = clean.dedup_by_key(df, "transaction_id", ["timestamp"]).collect()
    assert len(out) == 1 and out[0]["amount"] == 2.0  # greatest row wins


def test_dedup_is_deterministic_on_copies(spark):
    df = txn(spark, [{"transaction_id": "a", "amount": 5.0}, {"transaction_id": "a",
                                                               "amount": 7.0}])
    df = df.withColumn("copy", F.when(F.col("amount") == 7.0, 2).otherwise(1))
    out = clean.dedup_by_key(df, "transaction_id", ["timestamp", "copy"]).collect()
    assert [r["amount"] for r in out] == [7.0]


def test_nan_amount_passes_unless_rejected(spark):
    df = txn(spark, [{"amount": float("nan")}])
    assert clean.validate_transactions(df)[0].count() == 1
    assert clean.validate_transactions(df, reject_nan=True)[0].count() == 0


def test_zero_negative_null_amounts_go_to_dlq(spark):
    df = txn(spark, [{"transaction_id": "a", "amount": 0.0}, {"transaction_id": "b",
                                                               "amount": -1.0},
                     {"transaction_id": "c", "amount": None}])
    good, bad = clean.validate_transactions(df)
    assert good.count() == 0 and bad.count() == 3


def test_good_and_bad_partition_the_deduped_input(spark):
    df = txn(spark, [{"transaction_id": str(i), "amount": float(i - 3)} for i in range(10)]
             + [{"transaction_id": None}])
    deduped = clean.dedup_by_key(df, "transaction_id", ["timestamp"])
    good, bad = clean.validate_transactions(deduped)
    assert good.count() + bad.count() == deduped.count()
    assert good.unionByName(bad).subtract(deduped).count() == 0


def test_pii_mask_keeps_null(spark):
    df = spark.createDataFrame([("c1", None, "p", "n", "a")],
                               "customer_id string, email string, phone string, name string, "
                               "address string")
    out = clean.mask_pii(df).collect()[0]
    assert out["email_masked"] is None and len(out["phone_masked"]) == 64
    assert "email" not in clean.mask_pii(df).columns


def test_rounding_half_up(spark):
    row = spark.range(1).select(ratio_pct(F.lit(201), F.lit(20000)).alias("r")).first()
    assert row["r"] == 1.01


def test_all_ids_null_group_gives_null_ratios(spark):
    df = txn(spark, [{"transaction_id": None, "customer_id": "c"}])
    s = marts.transaction_summary(df).first()
    assert s["total_transactions"] == 0 and s["fraud_rate"] is None


def test_is_fraud_null_counts_in_neither(spark):
    df = txn(spark, [{"is_fraud": None}])
    s = marts.transaction_summary(df).first()
    assert s["fraud_txn_count"] == 0 and s["normal_txn_count"] == 0


def test_empty_day_regulatory_report_has_one_row(spark):
    df = txn(spark, [{}]).filter(F.lit(False))
    rows = marts.regulatory_report(df, RUN_DATE, RUN_TS).collect()
    assert len(rows) == 1
    assert rows[0]["total_transactions"] == 0 and rows[0]["fraud_rate_pct"] is None


def test_money_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3] * 1000
    a = spark.createDataFrame([(v,) for v in vals], "amount double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "amount double").coalesce(1)
    assert a.agg(money_sum("amount")).first()[0] == b.agg(money_sum("amount")).first()[0] == 600.0


@pytest.mark.parametrize("amount,expected", [
    (20000.0, 0), (20000.01, 15), (50000.0, 15), (50000.01, 30), (100000.0, 30),
    (100000.01, 50)])
def test_amount_tiers_are_strict(spark, amount, expected):
    df = txn(spark, [{"amount": amount, "timestamp": dt.datetime(2024, 1, 15, 12),
                      "device_id": "device-1", "location_lat": 20.0}])
    s = scoring.score_columns(df, hour_of("timestamp", False)).first()["fraud_score"]
    assert s == expected


@pytest.mark.parametrize("hour,expected", [(4, 25), (5, 10), (6, 10), (7, 0)])
def test_hour_rules(spark, hour, expected):
    df = txn(spark, [{"timestamp": dt.datetime(2024, 1, 15, hour), "amount": 10.0}])
    assert scoring.score_columns(df, hour_of("timestamp", False)).first()["fraud_score"] == expected


@pytest.mark.parametrize("lat,expected", [(10.0, 0), (30.0, 0), (9.99, 10), (30.01, 10)])
def test_location_rule(spark, lat, expected):
    df = txn(spark, [{"location_lat": lat}])
    assert scoring.score_columns(df, hour_of("timestamp", False)).first()["fraud_score"] == expected


@pytest.mark.parametrize("score,decision", [(39, "ALLOW"), (40, "FLAG"), (69, "FLAG"),
                                            (70, "BLOCK")])
def test_decision_boundaries(spark, score, decision):
    assert spark.range(1).select(scoring.fraud_decision(F.lit(score))).first()[0] == decision


def test_score_is_capped(spark):
    df = txn(spark, [{"amount": 200000.0, "timestamp": dt.datetime(2024, 1, 15, 1),
                      "device_id": "x", "location_lat": 40.0}])
    row = scoring.score_columns(df, hour_of("timestamp", False)).first()
    assert row["fraud_score"] == 100 and len(row["reasons"]) == 6


@pytest.mark.parametrize("ts", [None, "2024-01", "2024-01-15Tab:00:00"])
def test_bad_timestamp_text_gives_hour_12(spark, ts):
    df = spark.createDataFrame([(ts,)], "ts string")
    assert df.select(hour_of("ts", True)).first()[0] == 12


def _envelope(spark, docs):
    import base64
    rows = [({"data": d if raw else base64.b64encode(d.encode()).decode(),
              "sequenceNumber": str(i)},) for i, (d, raw) in enumerate(docs)]
    return spark.createDataFrame(rows, FS.ENVELOPE_SCHEMA)


def test_stream_record_errors(spark):
    ok = '"transaction_id": "t{0}", "customer_id": "c", "timestamp": "2024-01-15T12:00:00"'
    docs = [("!!not-base64", True), ("not json", False),
            ('{' + ok.format(1) + ', "amount": "12"}', False),
            ('{' + ok.format(2) + ', "amount": null}', False),
            ('{' + ok.format(3) + '}', False),
            ('{' + ok.format(4) + ', "amount": 5, "device_id": null}', False),
            ('{' + ok.format(5) + ', "amount": 5}', False)]
    out = FS.score_decoded(FS.decode_records(_envelope(spark, docs))).orderBy("seq").collect()
    assert [r["error"] is not None for r in out] == [True] * 6 + [False]
    last = out[-1]  # device absent scores as unknown; lat absent is 0 -> unusual
    assert "unknown_device" in last["reasons"] and last["fraud_score"] == 30


def test_null_customer_is_kept_by_erasure(spark):
    df = txn(spark, [{"customer_id": None}, {"customer_id": "1"}]).withColumn(
        "customer_id", F.col("customer_id").cast("bigint"))
    keys = spark.createDataFrame([(1,)], "customer_id bigint")
    assert erasure.anti_join_delete(df, keys).count() == 1


def test_quality_suite_pass_and_fail(spark):
    good = txn(spark, [{"transaction_id": str(i), "is_fraud": int(i % 10 == 0)}
                       for i in range(120)])
    res = quality.run_suite(spark, "bronze", good, quality.bronze_transactions_rules(100))
    assert res.filter(~F.col("passed")).count() == 0 and res.count() == 16
    bad = good.unionByName(txn(spark, [{"transaction_id": "1", "amount": -5.0}]))
    res = quality.run_suite(spark, "bronze", bad, quality.bronze_transactions_rules(100))
    failed = {r["check"] for r in res.filter(~F.col("passed")).collect()}
    assert failed == {"Amount always positive", "No duplicate transaction_ids"}
    with pytest.raises(quality.QualityGateError):
        quality.gate(res)


def test_missing_dataset_skips_checks(spark):
    res = quality.run_suite(spark, "x", None, quality.silver_customers_rules())
    assert res.count() == 1 and res.first()["passed"] is False
    empty = txn(spark, [{}]).filter(F.lit(False))
    res = quality.run_suite(spark, "x", empty, quality.bronze_transactions_rules())
    assert res.count() == 1


def test_default_run_date_is_yesterday():
    assert pipeline.default_run_date(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


# ---- lake behaviour --------------------------------------------------------------

def test_same_day_twice_gives_identical_table(spark):
    lake = L.Lake.scratch(spark, "t")
    t = lake.table("silver", "transactions")
    df = txn(spark, [{"transaction_id": str(i)} for i in range(5)])
    t.replace_partitions(df, "transaction_date", days=[RUN_DATE])
    first = sorted(map(tuple, t.read().collect()))
    t.replace_partitions(df, "transaction_date", days=[RUN_DATE])
    assert sorted(map(tuple, t.read().collect())) == first


def test_emptied_day_disappears(spark):
    lake = L.Lake.scratch(spark, "t")
    t = lake.table("silver", "transactions")
    other = dt.date(2024, 1, 14)
    df = txn(spark, [{"transaction_id": "a"}, {"transaction_id": "b", "transaction_date": other}])
    t.write_snapshot(df, "transaction_date")
    t.replace_partitions(df.filter(F.lit(False)), "transaction_date", days=[RUN_DATE])
    assert [r["transaction_id"] for r in t.read().collect()] == ["b"]


def test_delete_twice_deletes_nothing_the_second_time(spark):
    lake = L.Lake.scratch(spark, "t")
    df = txn(spark, [{"customer_id": "1"}, {"customer_id": "2"}, {"customer_id": None}]) \
        .withColumn("customer_id", F.col("customer_id").cast("bigint"))
    lake.table("silver", "transactions").write_snapshot(df, "transaction_date")
    keys = spark.createDataFrame([(1,)], "customer_id bigint")
    targets = [("silver", "transactions", "silver_transactions")]
    first = erasure.erase_from_lake(lake, keys, targets)
    assert first[0][4] == "OK", first
    second = erasure.erase_from_lake(lake, keys, targets)
    assert first[0][2] == 1 and second[0][2] == 0 and second[0][3] == 2


def test_table_survives_reopen_and_keeps_one_copy(spark):
    lake = L.Lake.scratch(spark, "t")
    lake.table("gold", "x").write_snapshot(txn(spark, [{}]))
    lake.table("gold", "x").write_snapshot(txn(spark, [{}, {"transaction_id": "b"}]))
    reopened = L.Lake(spark, lake.root)
    assert reopened.table("gold", "x").read().count() == 2
    assert spark.read.option("recursiveFileLookup", "true") \
        .parquet(f"{lake.root}/gold/x").count() == 2  # the replaced folder is gone


def test_absent_day_touches_nothing(spark):
    t = L.Lake.scratch(spark, "t").table("silver", "transactions")
    df = txn(spark, [{"transaction_id": "a"}])
    t.write_snapshot(df, "transaction_date")
    before = sorted(r[0] for r in t.read().select(F.input_file_name()).collect())
    t.replace_partitions(df.filter(F.lit(False)), "transaction_date",
                         days=[dt.date(2031, 1, 1)])
    assert sorted(r[0] for r in t.read().select(F.input_file_name()).collect()) == before


def test_later_columns_reach_silver_and_day_scans(spark):
    lake = L.Lake.scratch(spark, "t")
    later = txn(spark, [{"transaction_id": "b", "transaction_date": dt.date(2024, 1, 16)}]) \
        .withColumn("channel", F.lit("app"))
    t = lake.table("silver", "transactions")
    t.replace_partitions(txn(spark, [{"transaction_id": "a"}]), "transaction_date")
    t.replace_partitions(later, "transaction_date")
    assert {r["transaction_id"]: r["channel"] for r in t.read().collect()} == \
        {"a": None, "b": "app"}
    with pytest.raises(L.SchemaConflict):
        t.replace_partitions(later.withColumn("channel", F.lit(1)), "transaction_date")
    path = lake.bronze_path("transactions")
    L.write_bronze_days(txn(spark, [{"transaction_id": "a"}]), path)
    day2 = txn(spark, [{"transaction_id": "b", "timestamp": dt.datetime(2024, 1, 16, 9)}])
    folder = L.day_folder(path, dt.date(2024, 1, 16))
    day2.withColumn("channel", F.lit("app")).write.parquet(folder)
    day2.write.mode("append").parquet(folder)
    assert L.scan_parquet_day(spark, path, dt.date(2024, 1, 16)).filter(
        "channel = 'app'").count() == 1
    assert "channel" in L.scan_day_range(spark, path, RUN_DATE, dt.date(2024, 1, 16)).columns
    one = L.scan_parquet_day(spark, path, dt.date(2024, 1, 16))
    assert len(one.inputFiles()) == len(spark.read.parquet(folder).inputFiles())
    assert L.scan_parquet_day(spark, path, dt.date(2031, 1, 1)).count() == 0


def test_rerun_without_bad_rows_clears_the_dead_letters(spark):
    t = L.Lake.scratch(spark, "t").table("dlq", "transactions")
    bad = txn(spark, [{"transaction_id": "a"}])
    assert L.write_dlq(bad, t, RUN_DATE) == 1
    assert L.write_dlq(bad.filter(F.lit(False)), t, RUN_DATE) == 0
    assert t.read().count() == 0


def text_lake(spark):
    """A lake of text ids CUST0001..CUST0004, a dead letter and a decision log."""
    lake = L.Lake.scratch(spark, "t")
    ids = [f"CUST{i:04d}" for i in range(1, 5)]
    rows = txn(spark, [{"transaction_id": f"{i}-{d}", "customer_id": i,
                        "transaction_date": dt.date(2024, 1, 10 + d)}
                       for d, i in enumerate(ids)])
    entity = spark.createDataFrame([(i, "x") for i in ids], "customer_id string, v string")
    for layer, name, _ in erasure.ERASURE_TARGETS:
        if "transactions" in name or name.startswith("txn_"):  # by day
            lake.table(layer, name).write_snapshot(rows, "transaction_date")
        else:
            lake.table(layer, name).write_snapshot(entity)
    L.write_dlq(rows, lake.table("dlq", "transactions"), RUN_DATE)
    log = f"{lake.root}/decisions"
    entity.withColumn("batch_id", F.expr("int(substring(customer_id, 8, 1)) % 2")) \
        .write.partitionBy("batch_id").parquet(log)
    return lake, log


def text_requests(spark, *ids):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 20, 1, n), "PENDING", f"R{n}", None, None)
         for n, i in enumerate(ids)],
        "customer_id string, requested_at timestamp_ntz, status string, request_id string, "
        "sla_deadline timestamp_ntz, completed_at timestamp_ntz")


def test_erasure_of_text_ids_leaves_no_copy_on_disk(spark):
    lake, log = text_lake(spark)
    asked = text_requests(spark, "CUST0002", "USER0003", "")
    t = lake.table("silver", "transactions")
    kept_day = [r[0] for r in t.read().filter("customer_id = 'CUST0001'")
                .select(F.input_file_name()).collect()]
    out = pipeline.run_erasure(spark, lake, asked, RUN_TS, logs={"decisions": log})
    assert out["status"] == erasure.STATUS_COMPLETE, out["summary"]
    status = {r["customer_id"]: r["status"] for r in
              lake.table("control", "deletion_requests").read().collect()}
    assert status == {"CUST0002": "COMPLETE", "USER0003": "REJECTED", "": "REJECTED"}
    # other days keep their files; no file of any target holds the id
    assert kept_day == [r[0] for r in t.read().filter("customer_id = 'CUST0001'")
                        .select(F.input_file_name()).collect()]
    for layer in ("silver", "gold", "dlq", "decisions"):
        for name in (L.file_system(spark, f"{lake.root}/{layer}")[0].listStatus(
                L.file_system(spark, f"{lake.root}/{layer}")[1])):
            ids = {r[0] for r in spark.read.option("recursiveFileLookup", "true")
                   .schema("customer_id string").option("pathGlobFilter", "*.parquet")
                   .parquet(name.getPath().toString()).collect()}
            assert "CUST0002" not in ids and ids <= {"CUST0001", "CUST0003", "CUST0004"}
    assert spark.read.parquet(log).count() == 3
    notices = spark.read.parquet(lake.outbox_path())
    assert [r["subject"] for r in notices.collect()] == ["GDPR Deletion Complete: R0"]
    # a rerun finds nothing pending and changes nothing
    again = pipeline.run_erasure(spark, lake, asked, RUN_TS, logs={"decisions": log})
    assert again["batch_id"] is None
    assert spark.read.parquet(lake.outbox_path()).count() == 1


def test_missing_target_makes_the_batch_partial(spark):
    lake, _ = text_lake(spark)
    spark.sql(f"DROP TABLE {lake.table('gold', 'customer_360').name}")
    out = pipeline.run_erasure(spark, lake, text_requests(spark, "CUST0001"), RUN_TS)
    assert out["status"] == erasure.STATUS_PARTIAL
    assert {r[0]: r[4] for r in out["summary"]}["gold_customer_360"] == "MISSING"
    assert [r["status"] for r in out["requests"].collect()] == ["PENDING"]
    header = spark.read.schema(erasure.AUDIT_SCHEMA).json(f"{out['audit_key']}/header").first()
    assert "gold_customer_360" in header["errors"]
    assert not L.path_exists(spark, lake.outbox_path())


def unwritable(monkeypatch, name):
    """Writes to the days of the tables called ``name`` fail from here on."""
    real = L.LakeTable.replace_partitions

    def write(table, *args, **kwargs):
        if table.name.endswith(name):
            raise OSError("No space left on device")
        return real(table, *args, **kwargs)

    monkeypatch.setattr(L.LakeTable, "replace_partitions", write)


def test_rewrite_delete_that_fails_gives_no_rows(spark, monkeypatch):
    from ledgerlake.plans import registry as R
    seed, _ = text_lake(spark)
    keys = spark.createDataFrame([("CUST0002",)], "customer_id string")
    monkeypatch.setattr(R, "seed_silver_transactions", lambda spark, sf_dir: seed)
    monkeypatch.setattr(R, "_erasure_keys", lambda spark, sf_dir: keys)
    left = [r["customer_id"] for r in R.q_rewrite_delete(spark, "").collect()]
    assert sorted(left) == ["CUST0001", "CUST0003", "CUST0004"]
    unwritable(monkeypatch, "silver_transactions")
    with pytest.raises(erasure.ErasureFailed, match="silver_transactions: OSError: No space"):
        R.q_rewrite_delete(spark, "")


def test_erasure_that_fails_does_the_other_targets_and_raises(spark, monkeypatch):
    lake, _ = text_lake(spark)
    spark.sql(f"DROP TABLE {lake.table('gold', 'customer_360').name}")
    unwritable(monkeypatch, "silver_transactions")
    keys = spark.createDataFrame([("CUST0002",)], "customer_id string")
    with pytest.raises(erasure.ErasureFailed, match="gold_customer_360: no table") as e:
        erasure.erase_from_lake(lake, keys)
    assert isinstance(e.value.__cause__, OSError)
    status = {r[0]: r[4] for r in e.value.rows}
    assert status.pop("silver_transactions") == "FAILED"
    assert status.pop("gold_customer_360") == "MISSING" and set(status.values()) == {"OK"}
    left = {r["customer_id"] for r in lake.table("silver", "customers").read().collect()}
    assert left == {"CUST0001", "CUST0003", "CUST0004"}
    # who asks for it gets the summary; nothing but the failed target is left to erase
    again = {r[0]: r for r in erasure.erase_from_lake(lake, keys, partial=True)}
    assert again["silver_transactions"][4] == "FAILED"
    assert {r[2] for r in again.values()} == {0}


def test_failed_target_makes_the_batch_partial(spark, monkeypatch):
    lake, _ = text_lake(spark)
    with monkeypatch.context() as m:
        unwritable(m, "silver_transactions")
        out = pipeline.run_erasure(spark, lake, text_requests(spark, "CUST0001"), RUN_TS)
    assert out["status"] == erasure.STATUS_PARTIAL
    assert {r[0] for r in out["summary"] if r[4] == "FAILED"} == {"silver_transactions"}
    assert [r["status"] for r in out["requests"].collect()] == ["PENDING"]
    out = pipeline.run_erasure(spark, lake, None, RUN_TS + dt.timedelta(hours=1))
    assert out["status"] == erasure.STATUS_COMPLETE, out["summary"]
    assert "CUST0001" not in {r["customer_id"] for r in
                              lake.table("silver", "transactions").read().collect()}


def test_compaction_keeps_the_decisions_and_truncates_the_log(spark):
    path = f"{L.Lake.scratch(spark, 't').root}/log"
    for b in range(3):
        pipeline.append_decisions(spark.createDataFrame(
            [("a", f"{b}", b), (f"only{b}", None, b)],
            "transaction_id string, seq string, v int"), path, b)
    want = sorted(map(tuple, pipeline.current_decisions(spark, path).collect()))
    assert pipeline.compact_decisions(spark, path) == 4
    assert sorted(map(tuple, pipeline.current_decisions(spark, path).collect())) == want
    assert spark.read.parquet(path).count() == 4


def test_gate_lists_every_failure(spark):
    res = spark.createDataFrame([("s", i, f"check {i}", False) for i in range(30)],
                                "suite string, check_id int, check string, passed boolean")
    with pytest.raises(quality.QualityGateError) as e:
        quality.gate(res)
    assert all(f"check {i}" in str(e.value) for i in range(30))


def test_huge_amounts_keep_their_reason_and_text(spark):
    from ledgerlake.functions import scoring
    df = txn(spark, [{"amount": 1e17}, {"amount": 1e40}])
    got = scoring.score_columns(df, F.lit(12)).select("reasons", "amount").collect()
    assert got[0]["reasons"][0] == "very_high_amount:100000000000000000.00"
    assert any(r.startswith("very_high_amount:1.0E40") for r in got[1]["reasons"])


def test_profile_keeps_whole_numbers_exact(spark):
    from ledgerlake.operators import profiling
    df = spark.createDataFrame([(2 ** 53 + 1, 1e30), (5, 2e30)], "k bigint, d double")
    got = {r["column_name"]: r for r in profiling.profile_columns(df, "t").collect()}
    assert int(got["k"]["max_exact"]) == 2 ** 53 + 1 and got["d"]["mean"] == pytest.approx(1.5e30)


def test_summary_distinct_strategies_agree(spark):
    from conftest import SF_SMALL
    from ledgerlake.plans import registry as R
    txn = R._silver_dirty(spark, SF_SMALL)
    a = marts.transaction_summary(txn, "expand")
    b = marts.transaction_summary(txn, "narrow")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog_picks_up_new_days_and_columns(spark):
    lake = L.Lake.scratch(spark, "t")
    path = lake.bronze_path("transactions")
    first = txn(spark, [{"transaction_id": "a"}])
    L.write_bronze_days(first, path)
    name = pipeline.refresh_catalog(spark, lake) + ".transactions"
    assert spark.table(name).count() == 1
    later = txn(spark, [{"transaction_id": "b", "timestamp": dt.datetime(2024, 1, 16, 9)}]) \
        .withColumn("channel", F.lit("app"))
    later.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp")) \
        .withColumn("day", F.dayofmonth("timestamp")).write.mode("append") \
        .partitionBy("year", "month", "day").parquet(path)
    pipeline.refresh_catalog(spark, lake)
    spark.catalog.refreshTable(name)
    rows = spark.table(name).orderBy("transaction_id").collect()
    assert [r["transaction_id"] for r in rows] == ["a", "b"]
    assert "channel" in spark.table(name).columns


def test_hot_customer_summary_matches_brute_force(spark):
    """One customer holds a third of all rows; results stay whole and exact."""
    import collections
    rows = []
    for i in range(3000):
        cust = "hot" if i % 3 == 0 else f"c{i % 97}"
        rows.append({"transaction_id": f"t{i}", "customer_id": cust,
                     "amount": float(i % 500) + 0.25, "merchant": f"m{i % 12}",
                     "device_id": f"device-{i % 41}", "is_fraud": int(i % 20 == 0),
                     "transaction_date": RUN_DATE - dt.timedelta(days=i % 9)})
    df = txn(spark, rows)
    expect = collections.defaultdict(lambda: {"n": 0, "spend": 0.0, "m": set(), "d": set(),
                                              "days": set(), "fraud": 0})
    for r in rows:
        e = expect[r["customer_id"]]
        e["n"] += 1
        e["spend"] += r["amount"]
        e["m"].add(r["merchant"])
        e["d"].add(r["device_id"])
        e["days"].add(r["transaction_date"])
        e["fraud"] += r["is_fraud"]
    for mode in ("expand", "narrow"):
        got = {r["customer_id"]: r for r in marts.transaction_summary(df, mode).collect()}
        assert set(got) == set(expect)
        for cust, e in expect.items():
            g = got[cust]
            assert g["total_transactions"] == e["n"] and g["fraud_txn_count"] == e["fraud"]
            assert g["total_spend"] == round(e["spend"], 2)
            assert (g["unique_merchants"], g["unique_devices"], g["active_days"]) == \
                (len(e["m"]), len(e["d"]), len(e["days"]))
    deduped = clean.dedup_by_key(df.unionByName(df), "transaction_id", ["timestamp"])
    assert deduped.count() == 3000


def test_incremental_customer_360_equals_full_recompute(spark):
    """Days loaded one by one into the summary state give the same gold
    table as recomputing from the whole silver history."""
    from conftest import SF_SMALL
    from ledgerlake.plans import registry as R
    lake = L.Lake.scratch(spark, "t")
    silver = R._silver_dirty(spark, SF_SMALL)
    days = sorted(r[0] for r in silver.select("transaction_date").distinct().collect())[:4]
    t = lake.table("silver", "transactions")
    for name, fn in (("customers", R.silver_customers), ("kyc", R.silver_kyc),
                     ("support_tickets", R.silver_tickets)):
        lake.table("silver", name).write_snapshot(fn(spark, SF_SMALL))
    for i, day in enumerate(days):
        t.replace_partitions(silver.filter(F.col("transaction_date") == day),
                             "transaction_date", days=[day])
        pipeline.update_summary_state(lake, day if i else None)
    # rerun of a middle day must not double count
    pipeline.update_summary_state(lake, days[1])
    inc = marts.summary_from_state(lake.table(*pipeline.STATE_TABLES[0]).read(),
                                   lake.table(*pipeline.STATE_TABLES[1]).read())
    full = marts.transaction_summary(t.read())
    assert sorted(inc.columns) == sorted(full.columns)
    inc, full = inc.select(*full.columns), full
    assert inc.count() == full.count() > 0
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_totals_merge_days_and_survive_reruns(spark):
    """Days merged one by one equal the full recompute, after reruns of the newest and of a
    middle day too; a daily step reads one day of state and one day's totals."""
    from conftest import SF_SMALL
    from ledgerlake.plans import registry as R
    lake = L.Lake.scratch(spark, "t")
    silver = R._silver_dirty(spark, SF_SMALL)
    days = sorted(r[0] for r in silver.select("transaction_date").distinct().collect()
                  if r[0])[:4]
    t = lake.table("silver", "transactions")

    def load(day, rows=None):
        t.replace_partitions(silver.filter(F.col("transaction_date") == day) if rows is None
                             else rows, "transaction_date", days=[day])
        pipeline.update_summary_state(lake, day)
        return pipeline.update_totals(lake, day)

    def check():
        got = marts.summary_from_totals(lake.table(*pipeline.TOTAL_TABLE).read()
                                        .filter(F.col("as_of") == F.lit(days[-1])))
        full = marts.transaction_summary(t.read())
        got = got.select(*full.columns)
        assert got.count() == full.count() > 0
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0

    assert [load(d) for d in days] == days
    check()
    load(days[-1])
    check()
    # a middle day comes again with fewer rows
    load(days[1], silver.filter(F.col("transaction_date") == days[1]).limit(3))
    check()
    totals, _ = pipeline.day_step(lake, days[-1], days[-1])
    files = totals.inputFiles()
    for table in pipeline.STATE_TABLES:
        own = [f for f in files if "/".join(table) + "/" in f]
        assert own and all(f"transaction_date={days[-1]}" in f for f in own)
    assert not [f for f in files if "/silver/" in f]


def test_daily_catalog_refresh_adds_only_the_run_day(spark):
    lake = L.Lake.scratch(spark, "t")
    path = lake.bronze_path("transactions")
    days = [dt.date(2024, 1, 14), RUN_DATE]
    L.write_bronze_days(txn(spark, [{"transaction_id": str(d), "timestamp":
                                     dt.datetime.combine(d, dt.time(9))} for d in days]), path)
    name = pipeline.refresh_catalog(spark, lake, RUN_DATE) + ".transactions"
    assert [r["transaction_id"] for r in spark.table(name).collect()] == [str(RUN_DATE)]


def test_erased_customers_stay_erased_after_reload(spark):
    from conftest import SF_MID
    from ledgerlake.plans import defaults as D, registry as R
    from ledgerlake.sources import bindings as B
    bronze = R.seed_bronze(spark, SF_MID)
    lake = L.Lake.scratch(spark, "t", bronze_root=bronze.bronze_path(""))
    pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS, min_rows=100)
    requests = B.deletion_requests(spark, SF_MID)
    erased = {r[0] for r in erasure.erasure_keys(erasure.pending_requests(requests),
                                                 B.customer_key).collect()}
    out = pipeline.run_erasure(spark, lake, requests, D.RUN_TS, B.customer_key)
    assert out["status"] == erasure.STATUS_COMPLETE
    pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS, min_rows=100)  # reload from raw
    for layer, name in (("silver", "customers"), ("silver", "transactions"),
                        ("silver", "kyc"), ("silver", "support_tickets"),
                        ("gold", "customer_360"), ("gold", "txn_customer_day")):
        ids = {r[0] for r in lake.table(layer, name).read().select("customer_id").collect()}
        assert ids and not (ids & erased), (layer, name)
    done = out["requests"].filter(F.col("status") == "COMPLETE").count()
    assert done == len(erased) + requests.filter(F.col("status") == "COMPLETE").count()


def test_listing_scan_of_missing_prefix_is_a_no_data_verdict(spark):
    lake = L.Lake.scratch(spark, "t")
    df = L.scan_parquet_listing(spark, lake.bronze_path("nothing_here"))
    assert df is None
    res = quality.run_suite(spark, "bronze", df, quality.bronze_transactions_rules())
    row = res.collect()
    assert len(row) == 1 and row[0]["check"] == "Data exists for date" and not row[0]["passed"]


def test_quality_alert_lists_failed_suites(spark):
    from ledgerlake.operators import notify
    verdicts = spark.createDataFrame(
        [("silver_customers", False), ("bronze_transactions", False), ("gold", True)],
        "suite string, passed boolean")
    msg = notify.quality_failure(verdicts, RUN_DATE, RUN_TS).collect()
    assert len(msg) == 1 and msg[0]["subject"] == "DATA QUALITY ALERT"
    assert "Failed checks: ['bronze_transactions', 'silver_customers']" in msg[0]["message"]
    ok = spark.createDataFrame([("gold", True)], "suite string, passed boolean")
    assert notify.quality_failure(ok, RUN_DATE, RUN_TS).count() == 0
