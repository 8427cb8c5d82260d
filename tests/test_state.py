"""Keyed stream state, event-time windows and late records on small record files."""
import base64
import datetime as dt
import json
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.streaming import enrich as EN
from ledgerlake.streaming import velocity as V
from ledgerlake.streaming import windows as W

T0 = dt.datetime(2024, 3, 1)
HOUR = 3_600_000


def record(tid, customer, hours, amount, seq=None):
    at = T0 + dt.timedelta(hours=hours)
    doc = {"transaction_id": tid, "customer_id": customer, "amount": amount,
           "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S"), "device_id": "device-1",
           "location_lat": 20.0, "category": "food", "is_fraud": 0}
    data = base64.b64encode(json.dumps(doc).encode()).decode()
    return json.dumps({"kinesis": {"data": data, "sequenceNumber": seq or str(tid)}})


class Feed:
    """A watched folder; each call lands records and runs the stream until it has read them."""

    def __init__(self, spark, start):
        self.spark, self.start, self.root = spark, start, scratch_path(spark, "feed")

    def __call__(self, *records):
        self.spark.createDataFrame([(r,) for r in records], "value string").coalesce(1) \
            .write.mode("append").text(f"{self.root}/in")
        q = self.start(self.root)
        q.awaitTermination()
        return q


@pytest.fixture
def velocity(spark):
    return Feed(spark, lambda root: V.start_velocity_stream(
        spark, f"{root}/in", f"{root}/out", f"{root}/ck", "2 hours"))


def features(feed):
    rows = feed.spark.read.parquet(f"{feed.root}/out").collect()
    return {(r.transaction_id, r.batch_id): (r.late, r.n_1h, r.sum_1h, r.n_24h, r.sum_24h)
            for r in rows}


def held_hours(feed):
    return feed.spark.read.format("statestore").option("stateVarName", "hours") \
        .load(f"{feed.root}/ck").count()


def test_velocity_over_restarts_redelivery_and_late_rows(velocity):
    velocity(record("a", "c1", 0, 10.0), record("b", "c1", 0.5, 5.5), record("x", "c2", 0.1, 1.0))
    velocity(record("b", "c1", 0.5, 7.5, "99"),      # again, with another amount
             record("c", "c1", 1.25, 2.0))
    first = features(velocity)
    assert first["a", 0] == (False, 1, 10.0, 1, 10.0)
    assert first["b", 0] == (False, 2, 15.5, 2, 15.5)
    assert first["x", 0] == (False, 1, 1.0, 1, 1.0)
    again = {k[0]: v for k, v in features(velocity).items() if k[1] > 0}
    assert again["b"] == (False, 2, 17.5, 2, 17.5)
    assert again["c"] == (False, 2, 9.5, 3, 19.5)
    velocity(record("d", "c1", 30, 1.0))
    velocity(record("e", "c1", 27, 4.0), record("f", "c1", 29, 3.0))  # e is behind 28 h
    last = {k[0]: v for k, v in features(velocity).items()}
    assert last["e"] == (True, None, None, None, None)
    assert last["f"] == (False, 1, 3.0, 1, 3.0)  # sees neither d, which is later, nor e
    assert len(features(velocity)) == 8  # no record is lost


def test_velocity_state_expires(velocity):
    """Hours behind the horizon are removed, also of customers who never come back."""
    velocity(*[record(f"t{i}", f"c{i % 5}", i * 0.7, 1.0) for i in range(20)])
    assert held_hours(velocity) > 5
    velocity(record("late but in time", "c9", 15, 1.0))
    some = held_hours(velocity)
    velocity(record("far", "far", 24 * 30, 2.0))
    assert held_hours(velocity) == 1 < some  # the far customer's own hour
    velocity(record("far2", "far", 24 * 30 + 0.5, 3.0))
    assert [v for k, v in features(velocity).items() if k[0] == "far2"] == [(False, 2, 5.0, 2, 5.0)]


def test_velocity_history_equals_brute_force(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice([None] + [rng.randrange(5 * 24 * HOUR)] * 9),
             rng.randrange(1, 100)) for i in range(400)]
    data += [(900, 3, 24 * HOUR, 5), (901, 3, 48 * HOUR, 6), (902, 3, 48 * HOUR, 7)]
    got = V.batch_features(spark.createDataFrame(
        data, "id int, customer_id int, event_ms long, cents long")).collect()
    assert len(got) == len(data)
    for r in got:
        for h in (1, 24):
            own = [c for _, k, t, c in data if None not in (k, t, r.customer_id, r.event_ms)
                   and k == r.customer_id and r.event_ms - h * HOUR <= t <= r.event_ms]
            known = r.customer_id is not None and r.event_ms is not None
            assert (r[f"n_{h}h"], r[f"cents_{h}h"]) == ((len(own), sum(own)) if known else (None, None))


def test_window_ends_of_a_record(spark):
    at = [0, 1, HOUR - 1, HOUR, 5 * HOUR + 7]
    rows = spark.createDataFrame([(x,) for x in at], "event_ms long")
    ends = lambda w: [r[0] for r in rows.select(w.first_end_ms()).collect()]
    assert ends(W.Windows("tumbling", HOUR)) == [HOUR, HOUR, HOUR, 2 * HOUR, 6 * HOUR]
    sliding = W.Windows("sliding", 3 * HOUR, HOUR)
    assert sliding.per_record() == 3
    assert ends(sliding) == [HOUR, HOUR, HOUR, 2 * HOUR, 6 * HOUR]
    assert ends(W.Windows("session", HOUR)) == [x + HOUR for x in at]


@pytest.mark.parametrize("kind", ["tumbling", "session"])
def test_windows_and_late_records(spark, kind):
    w = W.Windows(kind, HOUR)
    feed = Feed(spark, lambda root: W.start_window_stream(
        spark, f"{root}/in", f"{root}/w", f"{root}/l", f"{root}/ck", w, "category", "2 hours"))
    feed(record("a", "c", 0.2, 1.0), record("b", "c", 0.9, 2.0), record("c", "c", 3.5, 4.0))
    feed(record("b", "c", 0.9, 9.0, "77"),            # its window is closed by now
         record("d", "c", 1.6, 8.0), record("e", "c", 9.5, 1.0))
    closed = {(r.window_start.hour + r.window_start.minute / 60, r.n, r.total_amount)
              for r in W.closed_windows(spark, f"{feed.root}/w").collect()}
    late = [(r.transaction_id, r.n_missed) for r in W.late_table(spark, f"{feed.root}/l").collect()]
    if kind == "tumbling":
        assert closed == {(0.0, 2, 3.0), (1.0, 1, 8.0), (3.0, 1, 4.0)}
        assert late == [("b", 1)]
    else:  # at the mark of 1.5 h the session of b (until 1.9 h) still takes records
        assert closed == {(0.2, 3, 11.0), (3.5, 1, 4.0)} and late == []


def test_velocity_state_is_paid_per_group_not_per_customer(velocity):
    """Many customers share a group's state, and each gets the features of its own rows."""
    n = V.GROUPS + 300
    velocity(*[record(f"t{i}-{j}", f"c{i}", 0.2 + 0.1 * j, i + 1.0) for i in range(n) for j in (0, 1)])
    assert held_hours(velocity) <= V.GROUPS
    got = {k[0]: v for k, v in features(velocity).items()}
    assert got == {f"t{i}-{j}": (False, *[j + 1, (j + 1) * (i + 1.0)] * 2)
                   for i in range(n) for j in (0, 1)}


def test_state_partitions_follow_the_cores(spark):
    """However many shuffle partitions a session has; the session's own setting stays."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    feed = Feed(spark, lambda root: W.start_window_stream(
        spark, f"{root}/in", f"{root}/w", f"{root}/l", f"{root}/ck", W.Windows("sliding", 2 * HOUR, HOUR),
        "category", "2 hours"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        feed(record("a", "c", 0.2, 1.0))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    stores = spark.read.format("state-metadata").load(f"{feed.root}/ck").collect()
    assert stores and {r.numPartitions for r in stores} == {
        max(8, V.PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)}


def test_a_batch_joined_with_a_history_is_decoded_once(spark, monkeypatch):
    kyc = spark.createDataFrame([("c1", "OK", dt.date(2024, 1, 1), dt.date(9999, 12, 31))],
                                "customer_id string, kyc string, valid_from date, valid_to date")
    levels, enrich = [], EN.enrich

    def seen(batch, *args):
        levels.append(batch.storageLevel.useMemory)
        return enrich(batch, *args)

    monkeypatch.setattr(EN, "enrich", seen)
    feed = Feed(spark, lambda root: EN.start_enriched_stream(
        spark, f"{root}/in", lambda: kyc, ["kyc"], f"{root}/out", f"{root}/ck",
        dt.datetime(2024, 3, 2), as_of=True))
    feed(record("a", "c1", 0.2, 1.0), record("b", "c2", 0.2, 1.0))
    assert levels == [True]
    assert sorted(map(tuple, spark.read.parquet(f"{feed.root}/out").select(
        "transaction_id", "kyc").collect())) == [("a", "OK"), ("b", None)]
