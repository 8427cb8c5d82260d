"""The decision log when a run is stopped between any two of its steps."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import erasure
from ledgerlake.plans import pipeline
from ledgerlake.session import scratch_path
from ledgerlake.sources import lake as L

DECISION = "transaction_id string, customer_id string, seq string, score int"


class Stopped(Exception):
    pass


def steps(monkeypatch, stop_at):
    """Raise before the folder operation number ``stop_at`` (counted over all of them)."""
    count = [0]
    for name in ("delete", "rename", "touch", "make_folder"):
        def step(*args, _real=getattr(L, name)):
            count[0] += 1
            if count[0] == stop_at:
                raise Stopped
            return _real(*args)
        monkeypatch.setattr(L, name, step)
    return count


def write(spark, path, batch, rows):
    pipeline.append_decisions(spark.createDataFrame(rows, DECISION), path, batch)


def latest(spark, path):
    return {(r.transaction_id, r.customer_id, r.score)
            for r in pipeline.current_decisions(spark, path).collect()}


def a_log(spark):
    path = scratch_path(spark, "log")
    write(spark, path, 0, [("a", "c1", "1", 10), ("b", "c2", "2", 20), ("x", "c3", "5", 1)])
    write(spark, path, 1, [("a", "c1", "3", 11), ("d", "c1", "4", 40)])
    write(spark, path, 2, [("e", "c2", "6", 50)])
    return path


def test_compaction_keeps_the_latest_decisions(spark):
    path = a_log(spark)
    want = latest(spark, path)
    assert pipeline.compact_decisions(spark, path) == 5
    assert len(L.folders(spark, path)) == 1 and latest(spark, path) == want
    assert pipeline.compact_decisions(spark, path) == 5  # nothing to do
    write(spark, path, 2, [("e", "c2", "6", 50)])         # the stream replays a folded batch
    write(spark, path, 3, [("b", "c2", "9", 21), ("f", "c9", "8", 60)])
    want = (want - {("b", "c2", 20)}) | {("b", "c2", 21), ("f", "c9", 60)}
    assert latest(spark, path) == want
    assert pipeline.compact_decisions(spark, path) == 6 and latest(spark, path) == want
    assert len(L.folders(spark, path)) == 1


@pytest.mark.parametrize("stop_at", range(1, 8))
def test_compaction_stopped_anywhere_loses_nothing(spark, monkeypatch, stop_at):
    path = a_log(spark)
    pipeline.compact_decisions(spark, path)
    write(spark, path, 3, [("a", "c1", "91", 12)])
    write(spark, path, 4, [("g", "c4", "92", 70)])
    want = latest(spark, path)
    with monkeypatch.context() as m:
        steps(m, stop_at)
        try:
            pipeline.compact_decisions(spark, path)
        except Stopped:
            pass
    assert latest(spark, path) == want
    assert pipeline.compact_decisions(spark, path) == len(want)  # the rerun finishes
    assert latest(spark, path) == want and len(L.folders(spark, path)) == 1


@pytest.mark.parametrize("stop_at", range(1, 13))
def test_log_erasure_stopped_anywhere_loses_nothing(spark, monkeypatch, stop_at):
    path, stage = a_log(spark), scratch_path(spark, "stage")
    keys = spark.createDataFrame([("c2",), ("zz",)], "customer_id string")
    keep = {r for r in latest(spark, path) if r[1] != "c2"}
    with monkeypatch.context() as m:
        steps(m, stop_at)
        try:
            erasure.erase_from_log(spark, path, keys, stage)
        except Stopped:
            pass
    if not L.path_exists(spark, f"{stage}/{erasure.READY}"):
        assert keep <= latest(spark, path)
    erasure.erase_from_log(spark, path, keys, stage)  # the rerun finishes
    assert latest(spark, path) == keep
    assert not L.path_exists(spark, stage)


def test_log_erasure_counts_and_leaves_other_batches(spark):
    path, stage = a_log(spark), scratch_path(spark, "stage")
    files = lambda b: {r[0] for r in spark.read.parquet(path).filter(F.col("batch_id") == b)
                       .select(F.input_file_name()).collect()}
    before = files(1)
    keys = spark.createDataFrame([("c2",)], "customer_id string")
    assert erasure.erase_from_log(spark, path, keys, stage) == (6, 2)
    assert files(1) == before and files(2) == set()
    assert erasure.erase_from_log(spark, path, keys, stage) == (4, 0)
