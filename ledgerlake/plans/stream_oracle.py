"""DuckDB twins of ``stream_queries``: plain joins over the arrivals, without any state."""

from __future__ import annotations

from ledgerlake.plans import history_oracle  # noqa: F401  (kyc_loads, kyc_versions)
from ledgerlake.plans.oracle import cte, decision_sql, q

LATENESS = "INTERVAL 72 HOURS"

cte("arriving", ("stream_decoded",), """
SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS own_arrival
FROM (SELECT transaction_id, customer_id, seq, merchant, category, is_fraud, amount,
             strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS ts,
             coalesce(seq LIKE '2%', FALSE) AS again
      FROM stream_decoded WHERE error IS NULL AND "timestamp" IS NOT NULL)""")
cte("arrived", ("arriving",), """
SELECT * EXCLUDE (own_arrival, again), own_arrival + again::INTEGER AS arrival
FROM arriving""")
# the watermark of each arrival: by the newest event time of those before
cte("marks", ("arrived",), f"""
SELECT a.arrival, max(b.ts) - {LATENESS} AS mark
FROM (SELECT DISTINCT arrival FROM arrived) a LEFT JOIN arrived b ON b.arrival < a.arrival
GROUP BY a.arrival""")
cte("timed", ("arrived", "marks"), """
SELECT a.*, mark FROM arrived a JOIN marks USING (arrival)""")
cte("on_time", ("timed",), "SELECT * FROM timed WHERE mark IS NULL OR ts > mark")
_SPANS = {"1h": "INTERVAL 1 HOUR", "24h": "INTERVAL 24 HOURS"}
_FEATURES = ", ".join(
    f"count(*) FILTER (ts >= own_ts - {span}) AS n_{h}, "
    f"CAST(sum(cents) FILTER (ts >= own_ts - {span}) AS BIGINT) / 100.0::DOUBLE AS sum_{h}"
    for h, span in _SPANS.items())
# of a transaction that came several times, the last that had come by then counts
q("stream_velocity", ["on_time", "timed"], f"""
SELECT transaction_id, customer_id, seq, ts AS event_time, amount, FALSE AS late,
       n_1h, sum_1h, n_24h, sum_24h
FROM on_time JOIN (
  SELECT transaction_id, arrival, {_FEATURES}
  FROM (SELECT r.transaction_id, r.arrival, r.ts AS own_ts, s.transaction_id AS other, s.ts,
               arg_max(CAST(CAST(s.amount AS DECIMAL(18,2)) * 100 AS BIGINT), s.arrival) AS cents
        FROM on_time r JOIN on_time s ON s.customer_id = r.customer_id
             AND s.arrival <= r.arrival AND s.ts BETWEEN r.ts - INTERVAL 24 HOURS AND r.ts
        GROUP BY ALL)
  GROUP BY transaction_id, arrival) USING (transaction_id, arrival)
UNION ALL
SELECT transaction_id, customer_id, seq, ts, amount, TRUE, NULL, NULL, NULL, NULL
FROM timed WHERE ts <= mark""")
_OVER = ("OVER (PARTITION BY customer_id ORDER BY \"timestamp\" "
         "RANGE BETWEEN INTERVAL {} PRECEDING AND CURRENT ROW)")
q("velocity_history", ["transactions"], f"""
SELECT transaction_id, customer_id, "timestamp" AS event_time,
       count(*) {_OVER.format("1 HOUR")} AS n_1h,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) {_OVER.format("1 HOUR")} AS DOUBLE) AS sum_1h,
       count(*) {_OVER.format("24 HOURS")} AS n_24h,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) {_OVER.format("24 HOURS")} AS DOUBLE) AS sum_24h
FROM transactions""")

# ---- windows ------------------------------------------------------------------------------
cte("final_mark", ("arrived",), f"SELECT max(ts) - {LATENESS} AS closed FROM arrived")
_MEASURES = ("count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, "
             "count(*) FILTER (is_fraud = 1) AS n_fraud")
# a transaction counts with its first record that is not late
cte("record_windows", ("timed",), "SELECT *, epoch_ms(ts) AS ms FROM timed")


def _windows(name: str, size_h: int, slide_h: int, group: str) -> str:
    size, slide = size_h * 3_600_000, slide_h * 3_600_000
    return f"""
SELECT make_timestamp(start_ms * 1000) AS window_start,
       make_timestamp((start_ms + {size}) * 1000) AS window_end, {group}, {_MEASURES}
FROM (SELECT *, unnest(range((ms // {slide}) * {slide}, ms - {size}, -{slide})) AS start_ms
      FROM first_records), final_mark
WHERE make_timestamp((start_ms + {size}) * 1000) <= closed
  AND (mark IS NULL OR make_timestamp((start_ms + {size}) * 1000) > mark)
GROUP BY ALL"""


cte("first_records", ("record_windows",), """
SELECT * FROM record_windows WHERE mark IS NULL OR ts > mark
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY arrival) = 1""")
q("stream_tumbling_windows", ["first_records", "final_mark"], _windows("t", 6, 6, "category"))
q("stream_sliding_windows", ["first_records", "final_mark"], _windows("s", 12, 4, "merchant"))
q("stream_session_windows", ["first_records", "final_mark"], f"""
SELECT min(ts) AS window_start, max(ts) + INTERVAL 3 HOURS AS window_end, customer_id,
       {_MEASURES}
FROM (SELECT *, sum(begins) OVER (PARTITION BY customer_id ORDER BY ts, transaction_id) AS k
      FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY customer_id
                                                   ORDER BY ts, transaction_id)
                                     + INTERVAL 3 HOURS THEN 0 ELSE 1 END AS begins
            FROM first_records)), final_mark
GROUP BY customer_id, k, closed HAVING max(ts) + INTERVAL 3 HOURS <= closed""")
q("stream_late_records", ["record_windows"], """
SELECT merchant, transaction_id, seq, ts AS event_time, count(*) AS n_missed
FROM (SELECT *, unnest(range((ms // 14400000) * 14400000, ms - 43200000, -14400000)) AS start_ms
      FROM record_windows)
WHERE make_timestamp((start_ms + 43200000) * 1000) <= mark GROUP BY ALL""")

# ---- enrichment ---------------------------------------------------------------------------
cte("decided", ("stream_scored",), f"""
SELECT transaction_id, seq, customer_id, {decision_sql('fraud_score')} AS decision, fraud_score,
       strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS event_time,
       coalesce(seq LIKE '2%', FALSE) AS again
FROM stream_scored WHERE error IS NULL""")
# a record's arrival goes by its transaction's time, which its text may lack
cte("decided_arrivals", ("decided", "transactions"), """
SELECT d.*, CASE WHEN t."timestamp" < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END
            + again::INTEGER AS arrival
FROM decided d JOIN transactions t ON CAST(t.transaction_id AS VARCHAR) = d.transaction_id""")
q("stream_enriched", ["decided_arrivals", "kyc_loads"], """
SELECT transaction_id, seq, d.customer_id, decision, fraud_score, kyc_status, risk_tier
FROM decided_arrivals d LEFT JOIN kyc_loads k
  ON CAST(k.customer_id AS VARCHAR) = d.customer_id AND k.load = d.arrival - 1""")
q("stream_enriched_as_of", ["decided", "kyc_versions"], """
SELECT transaction_id, seq, d.customer_id, decision, kyc_status, risk_tier
FROM decided d LEFT JOIN kyc_versions k
  ON CAST(k.customer_id AS VARCHAR) = d.customer_id
     AND k.valid_from <= d.event_time::DATE AND k.valid_to > d.event_time::DATE""")
q("stream_labels", ["decided", "transactions"], """
SELECT d.transaction_id, d.customer_id, event_time, fraud_score, decision,
       label_time, label
FROM decided d LEFT JOIN (
  SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, is_fraud AS label,
         date_trunc('second', "timestamp") + to_hours(CAST(transaction_id % 120 AS INTEGER))
           AS label_time
  FROM transactions WHERE transaction_id % 3 = 0) l
  ON l.transaction_id = d.transaction_id
     AND label_time BETWEEN event_time AND event_time + INTERVAL 72 HOURS
WHERE NOT again AND event_time IS NOT NULL""")
