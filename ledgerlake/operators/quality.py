"""Declarative data-quality checks.

A suite is a list of rules. Schema rules (column present/absent) are decided
from the DataFrame schema; data rules become aggregate expressions that run in
ONE pass over the data, and the single result row is unpivoted into one row
per check: (suite, check_id, check, passed, actual, expected).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = ("suite STRING, check_id INT, check STRING, passed BOOLEAN, "
                 "actual STRING, expected STRING")


@dataclass(frozen=True)
class Rule:
    """A declarative check. ``kind`` is one of: exists, column_present,
    column_absent, min_rows, no_nulls, all_positive, unique_key,
    mean_pct_in_open_range, values_in_range."""
    kind: str
    check: str
    column: str | None = None
    lo: float | None = None
    hi: float | None = None

    @property
    def expected(self) -> str | None:
        k = self.kind
        if k == "min_rows":
            return f">={self.lo:g}"
        if k in ("mean_pct_in_open_range", "values_in_range"):
            return f"{self.lo:g}-{self.hi:g}" + ("%" if k == "mean_pct_in_open_range" else "")
        return {"no_nulls": "0", "all_positive": "0 negative",
                "unique_key": "0 duplicates"}.get(k)


SCHEMA_KINDS = ("column_present", "column_absent")


def _fixed(x: Column, places: int) -> Column:
    """Half-up rounded decimal text, e.g. 5.27."""
    return F.round(x, places).cast(f"decimal(38,{places})").cast("string")


def rule_columns(rule: Rule) -> tuple[Column, Column]:
    """(passed, actual text) aggregate expressions of a data rule."""
    k = rule.kind
    if k == "exists":
        return F.count(F.lit(1)) > 0, F.lit(None).cast("string")
    if k == "min_rows":
        n = F.count(F.lit(1))
        return n >= F.lit(int(rule.lo)), n.cast("string")
    c = F.col(rule.column)
    if k == "no_nulls":
        nulls = F.count_if(c.isNull())
        return nulls == 0, nulls.cast("string")
    if k == "all_positive":
        # null and NaN fail the check; the reported count covers values <= 0
        failing = F.count_if(~F.coalesce((c > 0) & ~F.isnan(c), F.lit(False)))
        return failing == 0, F.concat(F.count_if(c <= 0).cast("string"), F.lit(" negative"))
    if k == "unique_key":
        # count(distinct) skips nulls, so a null key counts as a duplicate
        dup = F.count(F.lit(1)) - F.countDistinct(c)
        return dup == 0, dup.cast("string")
    if k == "mean_pct_in_open_range":
        pct = F.avg(c.cast("double")) * 100
        ok = F.coalesce((pct > rule.lo) & (pct < rule.hi), F.lit(False))
        return ok, F.concat(_fixed(pct, 2), F.lit("%"))
    if k == "values_in_range":
        out = F.count_if(~F.coalesce(c.between(rule.lo, rule.hi) & ~F.isnan(c), F.lit(False)))
        actual = F.concat(F.lit("min="), _fixed(F.min(c), 1), F.lit(" max="),
                          _fixed(F.max(c), 1))
        return out == 0, actual
    raise ValueError(f"unknown rule kind {k}")


def run_suite(spark: SparkSession, suite: str, df: DataFrame | None,
              rules: list[Rule]) -> DataFrame:
    """Evaluate ``rules`` in one aggregate pass; the first rule is the
    existence check, and when it fails the other checks are skipped."""
    if df is None:
        return spark.createDataFrame([(suite, 1, rules[0].check, False, None, None)],
                                     RESULT_SCHEMA)
    cols = df.columns
    entries: list[Column] = []
    aggs: list[Column] = []
    for i, rule in enumerate(rules, start=1):
        if rule.kind in SCHEMA_KINDS:
            present = rule.column in cols
            passed = F.lit(present if rule.kind == "column_present" else not present)
            actual = F.lit(None).cast("string")
        else:
            p, a = rule_columns(rule)
            aggs += [p.alias(f"p{i}"), a.alias(f"a{i}")]
            passed, actual = F.col(f"p{i}"), F.col(f"a{i}")
        entries.append(F.struct(
            F.lit(suite).alias("suite"), F.lit(i).alias("check_id"),
            F.lit(rule.check).alias("check"), passed.alias("passed"),
            actual.alias("actual"), F.lit(rule.expected).cast("string").alias("expected")))
    one = df.agg(*aggs)
    rows = one.select(F.inline(F.array(*entries)), F.col("p1").alias("_exists"))
    return rows.filter(F.col("_exists") | (F.col("check_id") == 1)).drop("_exists")


def suite_verdicts(results: DataFrame) -> DataFrame:
    """One row per suite: passed iff no check failed."""
    return results.groupBy("suite").agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Raise QualityGateError if any check failed; else return the results."""
    # one row per check of the rule lists, never per data row
    failed = results.filter(~F.col("passed")).select("suite", "check_id", "check").collect()
    if failed:
        listing = "; ".join(f"{r['suite']}: {r['check']}" for r in
                            sorted(failed, key=lambda r: (r["suite"], r["check_id"])))
        raise QualityGateError(f"quality gate failed ({len(failed)} checks): {listing}")
    return results


# ---- the four suites -----------------------------------------------------------
# Check labels, required columns and thresholds of each suite.

BRONZE_REQUIRED = ("transaction_id", "customer_id", "amount", "merchant", "category",
                   "timestamp", "is_fraud", "currency")
PII = ("email", "phone", "name", "address")
MASKED = ("email_masked", "phone_masked", "name_masked")
GOLD_REQUIRED = ("customer_id", "kyc_status", "risk_tier", "total_transactions",
                 "total_spend", "fraud_rate", "total_tickets", "updated_at")
GOLD_PII = ("email", "phone", "name")
DAILY_MIN_ROWS = 1000
ENTITY_MIN_ROWS = 100


def bronze_transactions_rules(min_count: int = DAILY_MIN_ROWS) -> list[Rule]:
    return [
        Rule("exists", "Data exists for date"),
        *[Rule("column_present", f"Column exists: {c}", c) for c in BRONZE_REQUIRED],
        Rule("min_rows", "Minimum row count", lo=min_count),
        Rule("no_nulls", "No nulls on transaction_id", "transaction_id"),
        Rule("no_nulls", "No nulls on customer_id", "customer_id"),
        Rule("no_nulls", "No nulls on amount", "amount"),
        Rule("all_positive", "Amount always positive", "amount"),
        Rule("unique_key", "No duplicate transaction_ids", "transaction_id"),
        Rule("mean_pct_in_open_range", "Fraud rate within expected range", "is_fraud", 0, 20),
    ]


def silver_transactions_rules(min_count: int = DAILY_MIN_ROWS) -> list[Rule]:
    return [
        Rule("exists", "Silver data exists for date"),
        Rule("min_rows", "Minimum row count in Silver", lo=min_count),
        *[Rule("column_absent", f"PII column removed: {c}", c) for c in PII],
        Rule("no_nulls", "No nulls on transaction_id in Silver", "transaction_id"),
        Rule("column_present", "processed_date column exists", "processed_date"),
        Rule("column_present", "silver_timestamp column exists", "silver_timestamp"),
    ]


def silver_customers_rules(min_count: int = ENTITY_MIN_ROWS) -> list[Rule]:
    return [
        Rule("exists", "Customer data exists in Silver"),
        Rule("min_rows", "Minimum customer count", lo=min_count),
        *[Rule("column_absent", f"PII column removed: {c}", c) for c in PII],
        *[Rule("column_present", f"Masked column exists: {c}", c) for c in MASKED],
        Rule("unique_key", "No duplicate customer_ids", "customer_id"),
    ]


def gold_customer_360_rules(min_count: int = ENTITY_MIN_ROWS) -> list[Rule]:
    return [
        Rule("exists", "Customer 360 exists in Gold"),
        Rule("min_rows", "Minimum customer count in Gold", lo=min_count),
        *[Rule("column_present", f"Required column exists: {c}", c) for c in GOLD_REQUIRED],
        *[Rule("column_absent", f"No PII in Gold: {c}", c) for c in GOLD_PII],
        Rule("unique_key", "No duplicate customers in Gold", "customer_id"),
        Rule("values_in_range", "Fraud rate between 0-100%", "fraud_rate", 0, 100),
    ]


def gate_rules(min_count: int = DAILY_MIN_ROWS) -> list[Rule]:
    """The in-pipeline gate on the day's silver rows."""
    return [
        Rule("exists", "Silver data exists for date"),
        Rule("min_rows", "Minimum row count in Silver", lo=min_count),
        Rule("no_nulls", "No nulls on transaction_id in Silver", "transaction_id"),
        Rule("column_absent", "PII column removed: email", "email"),
    ]
