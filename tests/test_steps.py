"""Erasure batches that are stopped and taken up again; sketches of daily state."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import erasure, marts, sketches
from ledgerlake.plans import pipeline
from ledgerlake.sources import lake as L

TS = dt.datetime(2024, 6, 1, 12)
TARGETS = (("silver", "customers", "silver_customers"), ("silver", "transactions", "silver_txn"),
           ("gold", "state", "gold_state"))
ALL_STEPS = [(t[2], s) for t in TARGETS for s in ("STARTED", "OK")] + [("finish", "OK")]


class Stopped(BaseException):
    pass


@pytest.fixture
def lake(spark, monkeypatch):
    monkeypatch.setattr(erasure, "ERASURE_TARGETS", TARGETS)
    monkeypatch.setattr(erasure.erase_from_lake, "__defaults__",
                        (TARGETS, (), None, None, 4))
    lake = L.Lake.scratch(spark, "steps")
    ids = spark.createDataFrame([(f"CUST{i:04d}", i) for i in range(20)], "customer_id string, n int")
    lake.table("silver", "customers").write_snapshot(ids)
    days = ids.withColumn("d", F.explode(F.array(*[F.lit(dt.date(2024, 5, x)) for x in (1, 2, 3)])))
    lake.table("silver", "transactions").write_snapshot(days, "d")
    lake.table("gold", "state").write_snapshot(days.limit(30))
    return lake


def requests(spark, *ids, at=TS):
    rows = [(i, at, "PENDING", f"R-{i}", at + dt.timedelta(hours=24), None) for i in ids]
    return spark.createDataFrame(
        rows, "customer_id string, requested_at timestamp_ntz, status string, request_id string, "
              "sla_deadline timestamp_ntz, completed_at timestamp_ntz")


def state(lake):
    tables = {t[1]: sorted(map(tuple, lake.table(t[0], t[1]).read().collect())) for t in TARGETS}
    status = sorted((r.customer_id, r.status) for r in
                    lake.table("control", "deletion_requests").read().collect())
    steps = sorted((r.step, r.status, r.rows_before, r.rows_deleted) for r in
                   erasure.stored_steps(lake.spark, lake.steps_path()).collect())
    return tables, status, steps


def run(spark, lake, reqs=None):
    return pipeline.run_erasure(spark, lake, reqs, TS, parallel=1)


@pytest.fixture(scope="module")
def want():
    return {}


@pytest.mark.parametrize("stop_at", [None, *ALL_STEPS])
def test_stopped_batch_ends_in_the_same_state(spark, lake, monkeypatch, want, stop_at):
    """Stopped before each step is noted, a rerun ends as one that was not stopped."""
    reqs = requests(spark, "CUST0003", "CUST0005", "bad")
    if stop_at:
        real = erasure.StepLedger.write

        def write(self, step, status, *args, **kwargs):
            if (step, status) == stop_at:
                raise Stopped
            real(self, step, status, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(erasure.StepLedger, "write", write)
            with pytest.raises(Stopped):
                run(spark, lake, reqs)
    late = requests(spark, "CUST0007") if stop_at else None  # comes while the batch is open
    run(spark, lake, reqs if stop_at is None else late)
    got = state(lake)
    if stop_at is None:
        want["state"] = got
        assert [x for x in got[2] if x[0] != "gold_state"] == [
            ("finish", "OK", 0, 0), ("silver_customers", "OK", 20, 2), ("silver_txn", "OK", 60, 6)]
        assert dict(got[1]) == {"CUST0003": "COMPLETE", "CUST0005": "COMPLETE", "bad": "REJECTED"}
    else:
        assert got[0] == want["state"][0] and got[2] == want["state"][2]
        assert [r for r in got[1] if r[0] != "CUST0007"] == want["state"][1]
        assert ("CUST0007", "PENDING") in got[1]  # waits for a batch of its own
        run(spark, lake)
        assert ("CUST0007", "COMPLETE") in state(lake)[1]


def test_finished_steps_are_not_read_again(spark, lake, monkeypatch):
    real, read = erasure.erase_table, []

    def erase(table, *args, **kwargs):
        read.append(table.name.rsplit("_", 1)[-1])
        if len(read) == 2:
            raise Stopped
        return real(table, *args, **kwargs)

    monkeypatch.setattr(erasure, "erase_table", erase)
    with pytest.raises(Stopped):
        run(spark, lake, requests(spark, "CUST0001"))
    run(spark, lake)
    assert read == ["customers", "transactions", "transactions", "state"]
    assert pipeline.open_batch(spark, lake) is None


def test_sla(spark):
    day = dt.timedelta(days=1)
    rows = [("a", "COMPLETE", TS, TS), ("b", "COMPLETE", TS, TS + day), ("c", "PENDING", TS, None),
            ("d", "PENDING", TS - day, None), ("e", "REJECTED", TS, None)]
    df = spark.createDataFrame(rows, "customer_id string, status string, "
                                     "sla_deadline timestamp_ntz, completed_at timestamp_ntz")
    got = {r.customer_id: r.sla for r in erasure.sla_status(df, F.lit(TS)).collect()}
    assert got == {"a": "MET", "b": "LATE", "c": "OPEN", "d": "OVERDUE", "e": None}


# ---- sketches -----------------------------------------------------------------------------

def txn_rows(spark, n, customers=3):
    return spark.range(n).select(
        F.col("id").alias("transaction_id"), (F.col("id") % customers).alias("customer_id"),
        F.lit(5.25).alias("amount"), F.concat(F.lit("m"), F.col("id") * 7 % 9000).alias("merchant"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("category"),
        F.concat(F.lit("d"), F.col("id") % 4).alias("device_id"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("timestamp"),
        F.timestamp_seconds(F.col("id") * 60).cast("date").alias("transaction_date"),
        F.lit(1.0).alias("location_lat"), F.lit(2.0).alias("location_lng"),
        (F.col("id") % 9 == 0).cast("int").alias("is_fraud"))


def test_merged_sketches_are_those_of_all_days(spark):
    """Totals are exact; counts within 2 %, however the days are merged."""
    txn = txn_rows(spark, 60_000)
    exact = {r.customer_id: r for r in marts.transaction_summary(txn).collect()}
    cut = dt.date(1970, 1, 15)
    parts = [sketches.state_of(txn.filter(F.col("transaction_date") < F.lit(cut))),
             sketches.state_of(txn.filter(F.col("transaction_date") >= F.lit(cut)))]
    merged = sketches.summary_from_state(sketches.add_state(*parts))
    for r in merged.collect():
        e = exact[r.customer_id]
        for c in ("total_transactions", "total_spend", "active_days", "fraud_rate",
                  "last_transaction_date", "latest_location_lat"):
            assert r[c] == e[c], c
        for c in ("unique_merchants", "unique_categories", "unique_devices"):
            assert abs(r[c] - e[c]) <= 0.02 * e[c], (c, r[c], e[c])
    assert exact[0].unique_categories > 10_000  # far beyond what a sketch lists exactly


def test_daily_run_by_sketches(spark):
    lake = L.Lake.scratch(spark, "sketch-run")
    txn = txn_rows(spark, 6000, 5)
    days = sorted(r[0] for r in txn.select("transaction_date").distinct().collect())
    table = lake.table("silver", "transactions")
    for d in days:
        day = txn.filter(F.col("transaction_date") == F.lit(d))
        if table.exists():
            table.replace_partitions(day, "transaction_date", days=[d])
        else:
            table.write_snapshot(day, "transaction_date")
        assert pipeline.update_sketches(lake, d) == d
    state = lambda: sorted(
        (r.customer_id, r.total_transactions, r.total_spend, r.unique_merchants, r.active_days)
        for r in sketches.summary_from_state(lake.table(*pipeline.SKETCH_TABLE).read().filter(
            F.col("as_of") == F.lit(days[-1])).drop("as_of")).collect())
    want = sorted((r.customer_id, r.total_transactions, r.total_spend, r.unique_merchants,
                   r.active_days) for r in marts.transaction_summary(txn).collect())
    close = lambda a, b: [x[:3] + x[4:] for x in a] == [x[:3] + x[4:] for x in b] and all(
        abs(x[3] - y[3]) <= 0.02 * y[3] for x, y in zip(a, b))
    assert close(state(), want)
    once = state()
    pipeline.update_sketches(lake, days[-1])          # the newest day again
    assert state() == once
    assert pipeline.update_sketches(lake, days[0]) == days[-1]  # an earlier day: all anew
    assert close(state(), want)
    assert {r[0] for r in lake.table(*pipeline.SKETCH_TABLE).read().select("as_of").collect()} \
        <= {days[-1], days[-2]}
    with pytest.raises(ValueError):
        pipeline.run_gold_customer_360(spark, lake, days[0], TS, True, "guess")
