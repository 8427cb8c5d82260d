"""Mergeable state per customer: totals and HyperLogLog sketches of the distinct counts.

A sketch stands for a set of values; the sketch of several days is the union of
theirs, so the state of a day is the state of the day before merged with what one day
brought. The exact state (``marts.first_seen``) keeps every value ever seen and is
joined with in full each day; this one reads a row per customer.

Counts are exact while a customer's sketch is small enough to list its values, and
have a relative standard error of 1.04 / sqrt(2 ** LG_K), 0.8 %, beyond.
Active days need no sketch: each day counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import marts

LG_K = 14
# (dimension, sketch column, exact count's column in the totals)
SKETCHES = tuple((c, f"s{i}", f"u{i}") for i, (c, _) in enumerate(marts.DISTINCT_DIMENSIONS)
                 if i > 0)


def customer_sketches(txn: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One row per customer: a sketch of each dimension's values; nulls do not count."""
    return txn.groupBy("customer_id").agg(*[
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(s) for c, s, _ in SKETCHES])


def state_of(txn: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Totals and sketches per customer of some days' transactions.

    Both are grouped on the customer; a null customer's rows are a group of their own.
    """
    no_values = txn.limit(0).select("customer_id", F.lit(0).alias("d"), F.lit("").alias("v"))
    totals = marts.customer_totals(marts.customer_day_partials(txn), no_values)
    sketches = customer_sketches(txn, lg_k).withColumnRenamed("customer_id", "_id")
    return totals.join(sketches, F.col("customer_id").eqNullSafe(F.col("_id"))).drop("_id")


def add_state(before: DataFrame, day: DataFrame) -> DataFrame:
    """The state up to the day before, and that of the day, as one: a single aggregate."""
    rows = before.select(*day.columns).unionByName(day)
    return rows.groupBy("customer_id").agg(
        *marts.merge_columns(),
        *[F.hll_union_agg(s).alias(s) for _, s, _ in SKETCHES])


def summary_from_state(state: DataFrame) -> DataFrame:
    """The transaction summary, with the distinct counts estimated from the sketches."""
    counted = state.select(*[
        F.hll_sketch_estimate(dict((u, s) for _, s, u in SKETCHES)[c]).cast("long").alias(c)
        if c.startswith("u") else F.col(c)
        for c in state.columns if c not in {s for _, s, _ in SKETCHES}])
    return marts.summary_from_totals(counted)
