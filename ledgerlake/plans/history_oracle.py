"""DuckDB twins of ``history_queries``: versions as islands of equal loads, no state."""

from __future__ import annotations

from ledgerlake.plans.oracle import (
    _ERASED, _ERASED_FROM, RUN_STAMP, TS, UPDATED, cte, q, txn_summary_sql)

DAYS = ("2024-01-10", "2024-01-20", "2024-01-31")
ENDS = (*DAYS[1:], "9999-12-31")
LOADS = "(VALUES " + ", ".join(
    f"({i}, DATE '{d}', DATE '{e}')" for i, (d, e) in enumerate(zip(DAYS, ENDS))) \
    + ") AS loads(load, day, next_day)"


def versions(src: str, picked: str) -> str:
    """Versions of a table of (load, customer_id, columns): neighbouring equal loads are one."""
    return f"""
SELECT {picked}, min(day) AS valid_from, max(next_day) AS valid_to,
       max(next_day) = DATE '9999-12-31' AS is_current
FROM (SELECT *, sum(begins) OVER (PARTITION BY customer_id ORDER BY load) AS island FROM (
  SELECT *, CASE WHEN lag(load) OVER w = load - 1 AND lag(content) OVER w = content
                 THEN 0 ELSE 1 END AS begins
  FROM (SELECT *, CAST(row(*COLUMNS(* EXCLUDE (load))) AS VARCHAR) AS content FROM {src})
  JOIN {LOADS} USING (load) WINDOW w AS (PARTITION BY customer_id ORDER BY load)))
GROUP BY {picked}, island"""


cte("kyc_loads", ("silver_kyc",), """
SELECT load, customer_id,
       CASE WHEN load >= 2 AND customer_id % 11 = 0 THEN 'REJECTED' ELSE kyc_status END
         AS kyc_status,
       CASE WHEN load >= 1 AND customer_id % 7 = 0 THEN 'HIGH' ELSE risk_tier END AS risk_tier
FROM silver_kyc, range(3) AS l(load) WHERE NOT (load = 1 AND customer_id % 13 = 0)""")
for _i, _day in enumerate(DAYS):
    cte(f"txn_until_{_i}", ("silver_transactions",),
        f"SELECT * FROM silver_transactions WHERE transaction_date <= DATE '{_day}'")
    cte(f"summary_{_i}", (f"txn_until_{_i}",), txn_summary_sql(f"txn_until_{_i}"))
cte("txn_loads", tuple(f"summary_{i}" for i in range(3)), " UNION ALL ".join(
    f"SELECT {i} AS load, * FROM summary_{i}" for i in range(3)))
# all tracked columns take part; constant ones of customers and tickets cannot change a version
cte("customer_loads", ("silver_customers", "kyc_loads", "txn_loads"), """
SELECT load, customer_id, email_masked, kyc_status, risk_tier,
       coalesce(total_transactions, 0) AS total_transactions,
       coalesce(total_spend, 0.0) AS total_spend, coalesce(fraud_rate, 0.0) AS fraud_rate,
       unique_merchants,
       t.* EXCLUDE (load, customer_id, total_transactions, total_spend, fraud_rate,
                    unique_merchants)
FROM (SELECT * FROM silver_customers, range(3) AS l(load)
      WHERE NOT (load = 1 AND customer_id % 97 = 0)) c
LEFT JOIN kyc_loads USING (load, customer_id) LEFT JOIN txn_loads t USING (load, customer_id)""")
q("customer_360_history", ["customer_loads"], versions(
    "customer_loads", "customer_id, kyc_status, risk_tier, total_transactions, total_spend, "
                      "fraud_rate, unique_merchants, email_masked"))
cte("kyc_versions", ("kyc_loads",), versions("kyc_loads", "customer_id, kyc_status, risk_tier"))
q("asof_transactions", ["silver_transactions", "kyc_versions"], """
SELECT transaction_id, t.customer_id, "timestamp", amount, kyc_status, risk_tier
FROM silver_transactions t LEFT JOIN kyc_versions v
  ON v.customer_id = t.customer_id AND v.valid_from <= t."timestamp"
     AND v.valid_to > t."timestamp\"""")
q("valid_at_day", ["kyc_versions"], """
SELECT customer_id, kyc_status, risk_tier, valid_from, valid_to FROM kyc_versions
WHERE valid_from <= DATE '2024-01-20' AND valid_to > DATE '2024-01-20'""")
q("customer_sketches", ["txn_summary"], """
SELECT customer_id, total_transactions, total_spend, active_days, fraud_rate, latest_location_lat,
       unique_merchants AS exact_unique_merchants, unique_categories AS exact_unique_categories,
       unique_devices AS exact_unique_devices, TRUE AS unique_merchants_close,
       TRUE AS unique_categories_close, TRUE AS unique_devices_close
FROM txn_summary""")
q("erasure_steps", _ERASED_FROM, f"""
SELECT 'GDPR-BATCH-{RUN_STAMP}' AS batch_id, table_name AS step, status, rows_before, rows_deleted,
       {TS} AS at FROM ({_ERASED})
UNION ALL SELECT 'GDPR-BATCH-{RUN_STAMP}', 'finish', 'OK', 0, 0, {TS}""")
q("erasure_sla", ["deletion_requests", "valid"], f"""
SELECT customer_id, requested_at, status, sla_deadline, completed_at,
       CASE status WHEN 'COMPLETE' THEN CASE WHEN completed_at <= sla_deadline THEN 'MET'
                                             ELSE 'LATE' END
                   WHEN 'PENDING' THEN CASE WHEN {TS} <= sla_deadline THEN 'OPEN'
                                            ELSE 'OVERDUE' END END AS sla
FROM ({UPDATED})""")
