"""Every registered query against its DuckDB twin."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from parity import compare, duck_conn

from ledgerlake.plans.registry import DAILY_TABLES, QUERIES as OWN

QUERIES = {k: v for k, v in E.queries().items() if k in OWN}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


# At sf0.001 a day holds ~33 transactions, under the daily gate's 100 rows,
# so the daily run halts there by design; it is checked at sf0.01 below.
GATED = {"daily_run", *DAILY_TABLES}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - GATED))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert r.get("ok") is True, r
    assert "types" not in r, r


@pytest.mark.parametrize("name", sorted(GATED))
def test_daily_run_matches_oracle_at_sf001(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_MID, duck_conn(SF_MID))
    assert r.get("ok") is True, r


def test_reference_gate_halts_a_day_under_1000_rows(spark):
    """The registered run gates at 100 rows; with the default of 1000 the same day halts."""
    from ledgerlake.operators.quality import DAILY_MIN_ROWS, QualityGateError
    from ledgerlake.plans import defaults as D, pipeline, registry as R
    from ledgerlake.sources.lake import Lake
    assert DAILY_MIN_ROWS == 1000
    lake = Lake.scratch(spark, bronze_root=R.seed_bronze(spark, SF_MID).bronze_path(""))
    with pytest.raises(QualityGateError, match="Minimum row count"):
        pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS)


def test_daily_run_gate_halts_small_day(spark):
    from ledgerlake.operators.quality import QualityGateError
    from ledgerlake.plans import defaults as D, registry as R
    from ledgerlake.plans import pipeline
    from ledgerlake.sources.lake import Lake
    lake = Lake.scratch(spark, bronze_root=R.seed_bronze(spark, SF_SMALL).bronze_path(""))
    with pytest.raises(QualityGateError):
        pipeline.run_daily(spark, lake, D.DAY, D.RUN_TS, min_rows=R.DAILY_RUN_MIN_ROWS)
    notes = spark.read.parquet(lake.outbox_path()).collect()
    assert [n["subject"] for n in notes] == ["ALERT: daily_pipeline failed on quality_gate"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_id" in df.columns and "fraud_rate" in df.columns
