"""Type-2 history and point-in-time joins on small frames."""
import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.operators import history as H
from ledgerlake.sources import lake as L

D1, D2, D3 = (dt.date(2024, 5, d) for d in (1, 5, 9))
SNAP = "customer_id long, tier string, note string, processed_date date"


@pytest.fixture
def table(spark):
    return L.Lake.scratch(spark, "history-test").table("gold", "history")


def snap(spark, rows, day=D1):
    return spark.createDataFrame([(i, t, n, day) for i, t, n in rows], SNAP)


def chains(table):
    return sorted(((r.customer_id, r.tier, r.note, r.valid_from, r.valid_to, r.is_current)
                   for r in table.read().collect()), key=lambda r: (r[0], r[3]))


def load(spark, table, rows, day):
    H.load_history(table, snap(spark, rows, day), "customer_id", day)


def test_three_loads_make_a_chain(spark, table):
    load(spark, table, [(1, "LOW", "a"), (2, "LOW", None), (3, "LOW", "x")], D1)
    load(spark, table, [(1, "HIGH", "a"), (2, "LOW", None)], D2)       # 3 is gone
    load(spark, table, [(1, "HIGH", "a"), (2, "LOW", ""), (3, "LOW", "x"), (4, "MID", "n")], D3)
    end = H.OPEN_END
    assert chains(table) == [
        (1, "LOW", "a", D1, D2, False), (1, "HIGH", "a", D2, end, True),
        (2, "LOW", None, D1, D3, False), (2, "LOW", "", D3, end, True),  # null is not empty
        (3, "LOW", "x", D1, D2, False), (3, "LOW", "x", D3, end, True),  # back: a new version
        (4, "MID", "n", D3, end, True)]
    assert {r.customer_id for r in H.valid_at(table.read(), dt.date(2024, 5, 6)).collect()} == {1, 2}


def test_rerun_changes_nothing_and_a_corrected_one_replaces(spark, table):
    load(spark, table, [(1, "LOW", "a"), (2, "LOW", "b")], D1)
    load(spark, table, [(1, "HIGH", "a")], D2)
    once = chains(table)
    load(spark, table, [(1, "HIGH", "a")], D2)
    assert chains(table) == once
    load(spark, table, [(1, "LOW", "a"), (2, "MID", "b")], D2)  # the day's data were wrong
    assert chains(table) == [(1, "LOW", "a", D1, H.OPEN_END, True),
                             (2, "LOW", "b", D1, D2, False), (2, "MID", "b", D2, H.OPEN_END, True)]
    load(spark, table, [(1, "LOW", "a"), (2, "LOW", "b")], D2)  # nothing changed after all
    assert chains(table) == [(1, "LOW", "a", D1, H.OPEN_END, True),
                             (2, "LOW", "b", D1, H.OPEN_END, True)]


def test_older_load_is_refused(spark, table):
    load(spark, table, [(1, "LOW", "a"), (2, "LOW", "b")], D1)
    load(spark, table, [(1, "HIGH", "a"), (2, "LOW", "b")], D3)
    before = chains(table)
    with pytest.raises(H.OutOfOrder):
        load(spark, table, [(1, "LOW", "a")], D2)
    only_closed = [(2, "LOW", "b")]
    load(spark, table, only_closed, dt.date(2024, 5, 12))  # closes 1, opens nothing
    with pytest.raises(H.OutOfOrder):
        load(spark, table, only_closed, dt.date(2024, 5, 11))
    assert [r for r in chains(table) if r[0] == 1][-1][4] == dt.date(2024, 5, 12)
    assert len(before) == 3


def test_later_column_and_empty_load(spark, table):
    load(spark, table, [(1, "LOW", "a")], D1)
    wide = snap(spark, [(1, "LOW", "a")], D2).withColumn("score", F.lit(7))
    H.load_history(table, wide, "customer_id", D2)
    got = {(r.valid_from, r.score) for r in table.read().collect()}
    assert got == {(D1, None), (D2, 7)}
    H.load_history(table, wide.limit(0), "customer_id", D3)  # everyone is gone
    assert not [r for r in table.read().collect() if r.is_current]


def test_closed_past_is_not_rewritten(spark, table):
    """A load touches the open versions and those it closes; older files stay."""
    load(spark, table, [(1, "LOW", "a"), (2, "LOW", "b")], D1)
    load(spark, table, [(1, "MID", "a"), (2, "LOW", "b")], D2)
    files = lambda: {r[0] for r in table.read().filter(F.col("valid_to") == F.lit(D2))
                     .select(F.input_file_name()).collect()}
    before = files()
    load(spark, table, [(1, "HIGH", "a"), (2, "LOW", "b")], D3)
    assert files() == before and before


# ---- as-of join ------------------------------------------------------------------------

def ts(day, hour=0):
    return dt.datetime(2024, 5, 1) + dt.timedelta(days=day, hours=hour)


def brute(facts, versions):
    out = []
    for f, k, t in facts:
        own = [v for v in versions if k is not None and t is not None and v[0] == k
               and v[1] is not None and v[1] <= t]
        best = max(own, key=lambda v: (v[1], v[2] or "", v[3] or ts(0)), default=None)
        out.append((f, k, t, best[2] if best and not (best[3] and best[3] <= t) else None))
    return Counter(out)


def asof(spark, facts, versions):
    f = spark.createDataFrame(facts, "id long, k long, t timestamp_ntz")
    v = spark.createDataFrame(versions, "k long, since timestamp_ntz, tier string, "
                                        "till timestamp_ntz")
    got = H.asof_join(f, v, "k", "t", "since", ["tier"], "till")
    return Counter((r.id, r.k, r.t, r.tier) for r in got.collect())


def test_asof_equals_brute_force(spark):
    rng = random.Random(4)
    versions = []
    for k in range(6):
        cuts = sorted(rng.sample(range(0, 240), 6))
        for a, b in zip(cuts, cuts[1:] + [None]):
            if rng.random() < .8:
                versions.append((k, ts(0, a), f"v{a}", ts(0, b) if b and rng.random() < .7 else None))
    versions += [(2, ts(3), "at midnight", None), (None, ts(1), "no key", None), (4, None, "no time", None)]
    facts = [(i, rng.choice([0, 1, 2, 2, 2, 2, 3, 4, 5, 9, None]),
              rng.choice([ts(0, rng.randrange(-10, 260)), ts(rng.randrange(0, 9)), None]))
             for i in range(600)]
    facts += facts[:5]  # repeated rows stay
    assert asof(spark, facts, versions) == brute(facts, versions)


def test_asof_edges(spark):
    facts = [(1, 7, ts(2)), (2, 7, ts(1, 23)), (3, None, ts(2)), (4, 7, None), (5, 8, ts(2))]
    assert asof(spark, facts, [(7, ts(2), "starts", None)]) == Counter(
        [(1, 7, ts(2), "starts"), (2, 7, ts(1, 23), None), (3, None, ts(2), None),
         (4, 7, None, None), (5, 8, ts(2), None)])
    assert sum(asof(spark, facts, []).values()) == 5
    assert asof(spark, [], [(7, ts(2), "starts", None)]) == Counter()
    with pytest.raises(ValueError):
        one = spark.createDataFrame([(1, 2, ts(0))], "id long, k long, tier timestamp_ntz")
        H.asof_join(one, one, "k", "tier", "tier", ["tier"])


def test_asof_never_sorts_all_of_a_key(spark):
    """Facts meet versions per key and day; only one row per key and day is sorted per key."""
    f = spark.range(1000).select("id", F.lit(1).cast("long").alias("k"), F.timestamp_seconds(
        F.col("id") * 3600).cast("timestamp_ntz").alias("t"))
    v = f.limit(3).select("k", F.col("t").alias("since"), F.lit("x").alias("tier"))
    joined = H.asof_join(f, v, "k", "t", "since", ["tier"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"\[(_k#\d+L?(?:, _day#\d+)?)\], \[", plan)  # partitions of the windows
    assert sorted("_day" in s for s in specs) == [False, True]
    # the window over all of a key is fed by distinct days and versions
    below = plan[[m.start() for m in re.finditer(r"\[_k#\d+L?\], \[", plan)][0]:]
    assert "Aggregate [" in below
    assert joined.count() == 1000


def test_history_loads_read_stored_silver(spark, monkeypatch):
    """Transactions and tickets are cleaned once, not by every load that reads them."""
    from ledgerlake.plans import history_queries as H
    plans = []
    load = H.history.load_history
    monkeypatch.setattr(H.history, "load_history", lambda table, df, *args: (
        plans.append(df._jdf.queryExecution().analyzed().toString()), load(table, df, *args)))
    H.q_customer_360_history(spark, SF_SMALL).count()
    assert len(plans) == len(H.LOADS) + 1
    for p in plans:
        assert "events.parquet" not in p and "props" not in p and "silver_transactions" in p
        assert "o_orderkey" not in p and "silver_support_tickets" in p
