"""DuckDB SQL twins of the registered queries.

The driver tables are views with their own names; the payment bindings are
common table expressions built here, and ``with_ctes`` emits just the ones a
query needs, in dependency order. Money sums and rounding follow the same
exact forms as the Spark side (decimal sums, rounding of the shortest decimal
text), so both engines give identical doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

from ledgerlake.plans import defaults as D


def msum(x: str) -> str:
    """Money sum: decimal(18,2) sum as double, non-finite values passed on."""
    exact = f"CAST(SUM(TRY_CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"
    rest = (f"SUM(CASE WHEN ({x}) IS NOT NULL AND TRY_CAST({x} AS DECIMAL(18,2)) "
            f"IS NULL THEN {x} END)")
    return f"COALESCE({rest} + COALESCE({exact}, 0.0), {exact})"


def mavg(x: str) -> str:
    return f"({msum(x)} / NULLIF(COUNT({x}), 0))"


def rnd(x: str, places: int = 2) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    return (f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {places}) "
            f"AS DOUBLE)")


def pct(num: str, den: str, places: int = 2) -> str:
    return rnd(f"CAST({num} AS DOUBLE) / NULLIF({den}, 0) * 100", places)


def cnt_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


TS = f"TIMESTAMP '{D.RUN_TS_TEXT}'"
RUN_DATE = f"DATE '{D.RUN_DATE.isoformat()}'"
DAY = f"DATE '{D.DAY.isoformat()}'"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_ctes(names, body: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---- bindings -------------------------------------------------------------

cte("transactions", (), """
SELECT event_id AS transaction_id, user_id AS customer_id,
       CAST(CAST(value AS DECIMAL(18,2)) * 500 AS DOUBLE) AS amount,
       'm' || CAST(k % 12 AS VARCHAR) AS merchant,
       event_type AS category, ts AS "timestamp",
       CAST(ts AS DATE) AS transaction_date,
       CASE WHEN k % 10 = 0 THEN 'x-' || CAST(event_id AS VARCHAR)
            ELSE 'device-' || CAST(user_id AS VARCHAR) END AS device_id,
       CAST(8 + k * 0.3 AS DOUBLE) AS location_lat,
       CAST(68 + k * 0.29 AS DOUBLE) AS location_lng,
       CASE WHEN k < 5 THEN 1 ELSE 0 END AS is_fraud,
       'INR' AS currency
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")

cte("dirty_transactions", ("transactions",), """
SELECT CASE WHEN transaction_id % 97 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
       CASE WHEN transaction_id % 89 = 0 THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN transaction_id % 83 = 0 THEN NULL
            WHEN transaction_id % 79 = 0 THEN -amount
            WHEN transaction_id % 73 = 0 THEN 0.0
            ELSE amount END AS amount,
       merchant, category, "timestamp", transaction_date, device_id,
       location_lat, location_lng, is_fraud, currency, 1 AS copy
FROM transactions
UNION ALL
SELECT transaction_id, customer_id, amount, merchant, category, "timestamp",
       transaction_date, device_id, location_lat, location_lng, is_fraud, currency,
       2 AS copy
FROM transactions WHERE transaction_id % 50 = 1 AND transaction_id % 97 <> 0""")

cte("customers", (), """
SELECT c_custkey AS customer_id, c_name AS name,
       'user' || CAST(c_custkey AS VARCHAR) || '@mail.example' AS email,
       '+91-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
       CAST(c_custkey AS VARCHAR) || ' Market Road' AS address,
       c_mktsegment AS city, CAST(c_nationkey AS VARCHAR) AS state,
       lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS pincode,
       DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date,
       c_acctbal AS avg_spend,
       CAST(8 + (c_custkey % 100) * 0.3 AS DOUBLE) AS home_lat,
       CAST(68 + (c_custkey % 100) * 0.29 AS DOUBLE) AS home_lng,
       'device-' || CAST(c_custkey AS VARCHAR) AS device_id,
       CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS is_active
FROM customer""")

cte("kyc", (), """
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 10 < 7 THEN 'VERIFIED' WHEN c_custkey % 10 < 9 THEN 'PENDING'
            ELSE 'REJECTED' END AS kyc_status,
       CASE WHEN c_custkey % 20 < 12 THEN 'LOW' WHEN c_custkey % 20 < 18 THEN 'MEDIUM'
            ELSE 'HIGH' END AS risk_tier,
       c_custkey % 3 <> 0 AS pan_verified,
       c_custkey % 4 <> 0 AS aadhar_verified,
       DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) + 7 AS kyc_date,
       DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) + 3657 AS kyc_expiry
FROM customer""")

cte("support_tickets", (), """
SELECT o_orderkey AS ticket_id, o_custkey AS customer_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'fraud_report'
            WHEN '2-HIGH' THEN 'transaction_dispute' WHEN '3-MEDIUM' THEN 'account_blocked'
            WHEN '4-NOT SPECIFIED' THEN 'payment_failed' WHEN '5-LOW' THEN 'refund_request'
       END AS category,
       CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'PENDING'
       END AS status,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS priority,
       CAST(o_orderdate AS DATE) AS created_date,
       'order ' || CAST(o_orderkey AS VARCHAR) AS description
FROM orders""")

cte("deletion_requests", (), """
SELECT customer_id, requested_at, status,
       'GDPR-' || customer_id || '-' || strftime(requested_at, '%Y%m%d%H%M%S') AS request_id,
       requested_at + INTERVAL 24 HOUR AS sla_deadline,
       CASE WHEN status = 'COMPLETE' THEN requested_at + INTERVAL 1 HOUR END AS completed_at
FROM (
  SELECT 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
         TIMESTAMP '2024-02-01 00:00:00' + c_custkey * INTERVAL 1 SECOND AS requested_at,
         'PENDING' AS status
  FROM customer WHERE c_custkey % 50 = 0
  UNION ALL
  SELECT x.customer_id, TIMESTAMP '2024-02-01 00:00:00' + c_custkey * INTERVAL 1 SECOND,
         x.status
  FROM customer,
       (VALUES ('COMPLETE', 0), ('PENDING', 1), ('PENDING', 2)) v(status, n),
       LATERAL (SELECT CASE v.n WHEN 0 THEN 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
                                WHEN 1 THEN ''
                                ELSE 'USER' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END
                       AS customer_id, v.status AS status) x
  WHERE c_custkey = 1
)""")


# ---- silver ---------------------------------------------------------------

def _dedup(src: str, key: str, cols: list[str], order: list[str]) -> str:
    rest = [c for c in cols if c != key and c not in order]
    by = ", ".join(f'"{c}" DESC NULLS LAST' for c in (*order, *rest))
    sel = ", ".join(f'"{c}"' for c in cols)
    return (f"SELECT {sel} FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY \"{key}\" ORDER BY {by}) = 1")


TXN_COLS = ["transaction_id", "customer_id", "amount", "merchant", "category",
            "timestamp", "transaction_date", "device_id", "location_lat",
            "location_lng", "is_fraud", "currency"]
CUST_COLS = ["customer_id", "name", "email", "phone", "address", "city", "state",
             "pincode", "signup_date", "avg_spend", "home_lat", "home_lng",
             "device_id", "is_active"]
KYC_COLS = ["customer_id", "kyc_status", "risk_tier", "pan_verified",
            "aadhar_verified", "kyc_date", "kyc_expiry"]
TICKET_COLS = ["ticket_id", "customer_id", "category", "status", "priority",
               "created_date", "description"]
TXN_RULE = ("transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount IS NOT NULL "
            "AND amount > 0 AND \"timestamp\" IS NOT NULL")
STAMPS = f"{RUN_DATE} AS processed_date, {TS} AS silver_timestamp"
MASKED = ("sha256(email) AS email_masked, sha256(phone) AS phone_masked, "
          "sha256(name) AS name_masked, sha256(address) AS address_masked")
CUST_KEEP = ("customer_id, city, state, pincode, signup_date, avg_spend, home_lat, "
             "home_lng, device_id, is_active")

cte("txn_dedup", ("transactions",), _dedup("transactions", "transaction_id", TXN_COLS,
                                           ["timestamp"]))
cte("silver_transactions", ("txn_dedup",),
    f"SELECT *, {STAMPS} FROM txn_dedup WHERE {TXN_RULE}")
cte("dirty_dedup", ("dirty_transactions",),
    _dedup("dirty_transactions", "transaction_id", TXN_COLS + ["copy"], ["timestamp", "copy"]))
cte("cust_masked", ("customers",),
    f"SELECT {CUST_KEEP}, {MASKED} FROM ("
    + _dedup("customers", "customer_id", CUST_COLS, []) + ")")
cte("silver_customers", ("cust_masked",),
    f"SELECT *, {STAMPS} FROM cust_masked "
    "WHERE customer_id IS NOT NULL AND signup_date IS NOT NULL")
cte("silver_kyc", ("kyc",),
    f"SELECT *, {STAMPS} FROM (" + _dedup("kyc", "customer_id", KYC_COLS, []) + ") "
    "WHERE customer_id IS NOT NULL AND kyc_status IS NOT NULL")
cte("silver_tickets", ("support_tickets",),
    f"SELECT *, {STAMPS} FROM ("
    + _dedup("support_tickets", "ticket_id", TICKET_COLS, ["created_date"]) + ") "
    "WHERE ticket_id IS NOT NULL AND customer_id IS NOT NULL")


# ---- gold -----------------------------------------------------------------

TXN_SUMMARY_BODY = f"""
SELECT customer_id,
       COUNT(transaction_id) AS total_transactions,
       {msum('amount')} AS total_spend,
       {mavg('amount')} AS avg_transaction,
       MAX(amount) AS max_transaction, MIN(amount) AS min_transaction,
       MIN(transaction_date) AS first_transaction_date,
       MAX(transaction_date) AS last_transaction_date,
       COUNT(DISTINCT transaction_date) AS active_days,
       {cnt_if('is_fraud = 1')} AS fraud_txn_count,
       {cnt_if('is_fraud = 0')} AS normal_txn_count,
       COUNT(DISTINCT merchant) AS unique_merchants,
       COUNT(DISTINCT category) AS unique_categories,
       COUNT(DISTINCT device_id) AS unique_devices,
       MAX(location_lat) AS last_location_lat,
       MAX(location_lng) AS last_location_lng,
       arg_max(location_lat, {{'t': "timestamp", 'i': transaction_id}}) AS latest_location_lat,
       arg_max(location_lng, {{'t': "timestamp", 'i': transaction_id}}) AS latest_location_lng
FROM {{src}} GROUP BY customer_id"""


def txn_summary_sql(src: str) -> str:
    inner = TXN_SUMMARY_BODY.replace("{src}", src)
    return (f"SELECT * EXCLUDE (latest_location_lat, latest_location_lng), "
            f"{pct('fraud_txn_count', 'total_transactions')} AS fraud_rate, "
            f"{rnd('CAST(total_transactions AS DOUBLE) / NULLIF(active_days, 0)')} "
            f"AS txn_per_active_day, latest_location_lat, latest_location_lng "
            f"FROM ({inner})")


TICKET_SUMMARY = f"""
SELECT customer_id, COUNT(ticket_id) AS total_tickets,
       {cnt_if("status = 'OPEN'")} AS open_tickets,
       {cnt_if("status = 'CLOSED'")} AS closed_tickets,
       {cnt_if("status = 'PENDING'")} AS pending_tickets,
       {cnt_if("category = 'fraud_report'")} AS fraud_reports,
       {cnt_if("category = 'transaction_dispute'")} AS dispute_count
FROM silver_tickets GROUP BY customer_id"""

cte("txn_summary", ("silver_transactions",), txn_summary_sql("silver_transactions"))
cte("ticket_summary", ("silver_tickets",), TICKET_SUMMARY)

CUSTOMER_360 = f"""
SELECT c.*, k.kyc_status, k.risk_tier, k.pan_verified, k.aadhar_verified, k.kyc_date,
       k.kyc_expiry,
       COALESCE(t.total_transactions, 0) AS total_transactions,
       COALESCE(t.total_spend, 0.0) AS total_spend,
       t.avg_transaction, t.max_transaction, t.min_transaction, t.first_transaction_date,
       t.last_transaction_date, t.active_days,
       COALESCE(t.fraud_txn_count, 0) AS fraud_txn_count, t.normal_txn_count,
       t.unique_merchants, t.unique_categories, t.unique_devices, t.last_location_lat,
       t.last_location_lng, COALESCE(t.fraud_rate, 0.0) AS fraud_rate,
       t.txn_per_active_day, t.latest_location_lat, t.latest_location_lng,
       COALESCE(s.total_tickets, 0) AS total_tickets,
       COALESCE(s.open_tickets, 0) AS open_tickets,
       s.closed_tickets, s.pending_tickets, s.fraud_reports, s.dispute_count,
       {TS} AS updated_at, {RUN_DATE} AS batch_date, TRUE AS is_current,
       {RUN_DATE} AS valid_from, DATE '9999-12-31' AS valid_to
FROM silver_customers c
LEFT JOIN (SELECT customer_id, kyc_status, risk_tier, pan_verified, aadhar_verified,
                  kyc_date, kyc_expiry FROM silver_kyc) k USING (customer_id)
LEFT JOIN txn_summary t USING (customer_id)
LEFT JOIN ticket_summary s USING (customer_id)"""

cte("customer_360", ("silver_customers", "silver_kyc", "txn_summary", "ticket_summary"),
    CUSTOMER_360)

ORACLE: dict[str, str] = {}


def q(name: str, deps, body: str) -> None:
    ORACLE[name] = with_ctes(deps, body)


q("gold_customer_360", ["customer_360"], "SELECT * FROM customer_360")
q("gold_customer_360_raw", ["customer_360"], "SELECT * FROM customer_360")
q("agg_transaction_summary", ["txn_summary"], "SELECT * FROM txn_summary")
q("agg_ticket_summary", ["ticket_summary"], "SELECT * FROM ticket_summary")

JOIN_KYC = """SELECT c.*, k.kyc_status, k.risk_tier, k.pan_verified, k.aadhar_verified,
       k.kyc_date, k.kyc_expiry
FROM silver_customers c LEFT JOIN silver_kyc k USING (customer_id)"""
cte("join_kyc", ("silver_customers", "silver_kyc"), JOIN_KYC)
cte("join_txn", ("join_kyc", "txn_summary"),
    "SELECT * FROM join_kyc LEFT JOIN txn_summary USING (customer_id)")
cte("join_all", ("join_txn", "ticket_summary"),
    "SELECT * FROM join_txn LEFT JOIN ticket_summary USING (customer_id)")

q("join_left_kyc", ["join_kyc"], "SELECT * FROM join_kyc")
q("join_left_txn_summary", ["join_txn"], "SELECT * FROM join_txn")
q("join_left_ticket_summary", ["join_all"], "SELECT * FROM join_all")
q("select_columns", ["silver_kyc"], "SELECT " + ", ".join(KYC_COLS) + " FROM silver_kyc")
q("scd2_stamp", ["join_all"],
  f"SELECT *, {TS} AS updated_at, {RUN_DATE} AS batch_date, TRUE AS is_current, "
  f"{RUN_DATE} AS valid_from, DATE '9999-12-31' AS valid_to FROM join_all")
q("fill_defaults", ["join_all"],
  "SELECT * REPLACE (COALESCE(total_transactions, 0) AS total_transactions, "
  "COALESCE(total_spend, 0.0) AS total_spend, COALESCE(fraud_txn_count, 0) AS fraud_txn_count, "
  "COALESCE(total_tickets, 0) AS total_tickets, COALESCE(open_tickets, 0) AS open_tickets, "
  "COALESCE(fraud_rate, 0.0) AS fraud_rate) FROM join_all")

DAILY = f"""
SELECT *, {pct('fraud_count', 'transaction_count')} AS fraud_rate, {TS} AS processed_at FROM (
  SELECT transaction_date, category, merchant,
         COUNT(transaction_id) AS transaction_count,
         {msum('amount')} AS total_amount,
         {mavg('amount')} AS avg_amount,
         {cnt_if('is_fraud = 1')} AS fraud_count,
         {msum('CASE WHEN is_fraud = 1 THEN amount ELSE 0.0 END')} AS fraud_amount
  FROM silver_transactions GROUP BY transaction_date, category, merchant)"""
q("agg_daily", ["silver_transactions"], DAILY)


def regulatory_sql(where: str, group: str, report_date: str) -> str:
    return f"""
SELECT *, {pct('flagged_transactions', 'total_transactions')} AS fraud_rate_pct,
       {TS} AS generated_at, 'COMPLETE' AS report_status FROM (
  SELECT COUNT(transaction_id) AS total_transactions,
         {msum('amount')} AS total_amount,
         {cnt_if('is_fraud = 1')} AS flagged_transactions,
         {msum('CASE WHEN is_fraud = 1 THEN amount ELSE 0.0 END')} AS fraud_amount,
         COUNT(DISTINCT customer_id) AS unique_customers,
         COUNT(DISTINCT merchant) AS unique_merchants,
         {mavg('amount')} AS avg_transaction_amount,
         MAX(amount) AS max_transaction_amount,
         {report_date} AS report_date
  FROM silver_transactions {where} {group})"""


q("agg_regulatory", ["silver_transactions"],
  regulatory_sql("", "GROUP BY transaction_date", "transaction_date"))
q("report_stamp", ["silver_transactions"],
  regulatory_sql(f"WHERE transaction_date = {DAY}", "", DAY))
q("filter_day", ["silver_transactions"],
  f"SELECT * FROM silver_transactions WHERE transaction_date = {DAY}")

DAILY_FRAUD = f"""
SELECT transaction_date, COUNT(transaction_id) AS total_transactions,
       CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
       {cnt_if('is_fraud = 1')} AS fraud_count,
       {rnd('CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT(amount), 0)')}
         AS avg_amount,
       {pct(cnt_if('is_fraud = 1'), 'COUNT(transaction_id)')} AS fraud_rate_pct
FROM silver_transactions GROUP BY transaction_date ORDER BY transaction_date DESC"""
q("sql_daily_fraud_summary", ["silver_transactions"], DAILY_FRAUD)
q("order_desc", ["silver_transactions"], DAILY_FRAUD)

TOP_MERCHANTS = f"""
SELECT merchant, category, COUNT(transaction_id) AS transaction_count,
       {rnd(msum('amount'))} AS total_amount,
       {rnd(mavg('amount'))} AS avg_amount,
       {cnt_if('is_fraud = 1')} AS fraud_count
FROM silver_transactions GROUP BY merchant, category
ORDER BY total_amount DESC NULLS LAST, merchant, category LIMIT 10"""
q("sql_top_merchants", ["silver_transactions"], TOP_MERCHANTS)
q("topk_merchants", ["silver_transactions"], TOP_MERCHANTS)

HIGH_RISK_COLS = ("customer_id, total_transactions, total_spend, fraud_txn_count, fraud_rate, "
                  "risk_tier, kyc_status, total_tickets")
q("topk_high_risk", ["customer_360"],
  f"SELECT {HIGH_RISK_COLS} FROM customer_360 WHERE risk_tier = 'HIGH' OR fraud_rate > 10 "
  "ORDER BY fraud_rate DESC NULLS LAST, customer_id LIMIT 100")
q("filter_or", ["customer_360"],
  f"SELECT {HIGH_RISK_COLS} FROM customer_360 WHERE risk_tier = 'HIGH' OR fraud_rate > 10")

# ---- cleaning ---------------------------------------------------------------

q("dedup_by_key", ["dirty_dedup"], "SELECT * FROM dirty_dedup")
q("validate_transactions", ["dirty_dedup"], f"SELECT * FROM dirty_dedup WHERE {TXN_RULE}")
q("except_distinct", ["dirty_dedup"],
  f"SELECT DISTINCT * FROM dirty_dedup WHERE NOT COALESCE({TXN_RULE}, FALSE)")
q("validate_customers", ["customers"],
  "SELECT * FROM customers WHERE customer_id IS NOT NULL AND signup_date IS NOT NULL")
q("validate_kyc", ["kyc"],
  "SELECT * FROM kyc WHERE customer_id IS NOT NULL AND kyc_status IS NOT NULL")
q("validate_tickets", ["support_tickets"],
  "SELECT * FROM support_tickets WHERE ticket_id IS NOT NULL AND customer_id IS NOT NULL")
q("mask_pii", ["customers"], f"SELECT {CUST_KEEP}, {MASKED} FROM customers")
q("stamp_silver", ["transactions"], f"SELECT *, {STAMPS} FROM transactions")
q("silver_transactions", ["dirty_dedup"],
  f"SELECT *, {STAMPS} FROM dirty_dedup WHERE {TXN_RULE}")
q("silver_customers", ["silver_customers"], "SELECT * FROM silver_customers")
q("silver_kyc", ["silver_kyc"], "SELECT * FROM silver_kyc")
q("silver_support_tickets", ["silver_tickets"], "SELECT * FROM silver_tickets")
q("row_count_metrics", ["dirty_transactions", "dirty_dedup"], f"""
SELECT (SELECT COUNT(*) FROM dirty_transactions) AS rows_in,
       COUNT(*) AS rows_deduped,
       (SELECT COUNT(*) FROM dirty_transactions) - COUNT(*) AS duplicates_removed,
       COUNT(*) FILTER (WHERE COALESCE({TXN_RULE}, FALSE)) AS good_rows,
       COUNT(*) FILTER (WHERE NOT COALESCE({TXN_RULE}, FALSE)) AS bad_rows
FROM dirty_dedup""")

# ---- fraud scoring ------------------------------------------------------------


def score_sql(amount: str, hour: str, device: str, lat: str) -> tuple[str, str]:
    """(score, reasons JSON text) with the same rules as the Spark columns."""
    a = f"(CASE WHEN NOT isnan({amount}) THEN {amount} END)"
    la = f"(CASE WHEN NOT isnan({lat}) THEN {lat} END)"
    known = f"COALESCE(starts_with({device}, 'device-'), FALSE)"
    amt = f"CAST(TRY_CAST({a} AS DECIMAL(18,2)) AS VARCHAR)"
    h = f"CAST({hour} AS VARCHAR)"
    rules = [
        (f"{a} > 100000", 50, f"'very_high_amount:' || {amt}"),
        (f"{a} <= 100000 AND {a} > 50000", 30, f"'high_amount:' || {amt}"),
        (f"{a} <= 50000 AND {a} > 20000", 15, f"'elevated_amount:' || {amt}"),
        (f"{hour} < 5", 25, f"'midnight_transaction:hour_' || {h}"),
        (f"{hour} >= 5 AND {hour} < 7", 10, f"'early_morning:hour_' || {h}"),
        (f"NOT {known}", 20, "'unknown_device'"),
        (f"{la} > 30 OR {la} < 10", 10, f"'unusual_location:' || CAST({la} AS VARCHAR)"),
        (f"{a} > 50000 AND NOT {known}", 15, "'high_amount_unknown_device'"),
        (f"{a} > 20000 AND {hour} < 5", 15, "'high_amount_midnight'"),
    ]
    score = "LEAST(" + " + ".join(f"(CASE WHEN {c} THEN {p} ELSE 0 END)"
                                  for c, p, _ in rules) + ", 100)"
    arr = "[" + ", ".join(f"(CASE WHEN {c} THEN {t} END)" for c, _, t in rules) + "]"
    reasons = ("'[' || array_to_string(list_transform(list_filter(" + arr +
               ", lambda x: x IS NOT NULL), lambda x: '\"' || x || '\"'), ', ') || ']'")
    return score, reasons


def decision_sql(score: str) -> str:
    return (f"CASE WHEN {score} >= 70 THEN 'BLOCK' WHEN {score} >= 40 THEN 'FLAG' "
            "ELSE 'ALLOW' END")


_S, _R = score_sql("amount", "COALESCE(hour(\"timestamp\"), 12)", "device_id", "location_lat")
cte("scored", ("silver_transactions",),
    f"SELECT *, CAST({_S} AS INTEGER) AS fraud_score, {_R} AS reasons_json "
    "FROM silver_transactions")
q("fraud_score", ["scored"],
  "SELECT transaction_id, fraud_score, reasons_json AS reasons FROM scored")
q("fraud_decision", ["scored"],
  f"SELECT transaction_id, fraud_score, {decision_sql('fraud_score')} AS decision FROM scored")
q("fraud_result_row", ["scored"], f"""
SELECT transaction_id, customer_id, CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amount,
       merchant, fraud_score,
       {decision_sql('fraud_score')} AS decision, reasons_json AS reasons,
       CAST(is_fraud AS INTEGER) AS actual_fraud,
       strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
       {TS} AS processed_at, 'rule-engine-v1' AS model_version
FROM scored""")

# ---- quality ---------------------------------------------------------------------

@dataclass(frozen=True)
class R:
    """A check as the twin states it."""
    kind: str
    check: str
    column: str | None = None
    lo: float | None = None
    hi: float | None = None

    @property
    def expected(self) -> str | None:
        if self.kind == "min_rows":
            return f">={self.lo:g}"
        if self.kind == "mean_pct_in_open_range":
            return f"{self.lo:g}-{self.hi:g}%"
        if self.kind == "values_in_range":
            return f"{self.lo:g}-{self.hi:g}"
        return {"no_nulls": "0", "all_positive": "0 negative",
                "unique_key": "0 duplicates"}.get(self.kind)


# Labels and thresholds of the checks, stated here anew so that the twin
# proves those of the operator.
BRONZE_CHECKS = [
    R("exists", "Data exists for date"),
    R("column_present", "Column exists: transaction_id", column="transaction_id"),
    R("column_present", "Column exists: customer_id", column="customer_id"),
    R("column_present", "Column exists: amount", column="amount"),
    R("column_present", "Column exists: merchant", column="merchant"),
    R("column_present", "Column exists: category", column="category"),
    R("column_present", "Column exists: timestamp", column="timestamp"),
    R("column_present", "Column exists: is_fraud", column="is_fraud"),
    R("column_present", "Column exists: currency", column="currency"),
    R("min_rows", "Minimum row count", lo=1000),
    R("no_nulls", "No nulls on transaction_id", column="transaction_id"),
    R("no_nulls", "No nulls on customer_id", column="customer_id"),
    R("no_nulls", "No nulls on amount", column="amount"),
    R("all_positive", "Amount always positive", column="amount"),
    R("unique_key", "No duplicate transaction_ids", column="transaction_id"),
    R("mean_pct_in_open_range",
      "Fraud rate within expected range", column="is_fraud", lo=0, hi=20),
]
SILVER_CHECKS = [
    R("exists", "Silver data exists for date"),
    R("min_rows", "Minimum row count in Silver", lo=1000),
    R("column_absent", "PII column removed: email", column="email"),
    R("column_absent", "PII column removed: phone", column="phone"),
    R("column_absent", "PII column removed: name", column="name"),
    R("column_absent", "PII column removed: address", column="address"),
    R("no_nulls", "No nulls on transaction_id in Silver", column="transaction_id"),
    R("column_present", "processed_date column exists", column="processed_date"),
    R("column_present", "silver_timestamp column exists", column="silver_timestamp"),
]
CUSTOMER_CHECKS = [
    R("exists", "Customer data exists in Silver"),
    R("min_rows", "Minimum customer count", lo=100),
    R("column_absent", "PII column removed: email", column="email"),
    R("column_absent", "PII column removed: phone", column="phone"),
    R("column_absent", "PII column removed: name", column="name"),
    R("column_absent", "PII column removed: address", column="address"),
    R("column_present", "Masked column exists: email_masked", column="email_masked"),
    R("column_present", "Masked column exists: phone_masked", column="phone_masked"),
    R("column_present", "Masked column exists: name_masked", column="name_masked"),
    R("unique_key", "No duplicate customer_ids", column="customer_id"),
]
GOLD_CHECKS = [
    R("exists", "Customer 360 exists in Gold"),
    R("min_rows", "Minimum customer count in Gold", lo=100),
    R("column_present", "Required column exists: customer_id", column="customer_id"),
    R("column_present", "Required column exists: kyc_status", column="kyc_status"),
    R("column_present", "Required column exists: risk_tier", column="risk_tier"),
    R("column_present", "Required column exists: total_transactions", column="total_transactions"),
    R("column_present", "Required column exists: total_spend", column="total_spend"),
    R("column_present", "Required column exists: fraud_rate", column="fraud_rate"),
    R("column_present", "Required column exists: total_tickets", column="total_tickets"),
    R("column_present", "Required column exists: updated_at", column="updated_at"),
    R("column_absent", "No PII in Gold: email", column="email"),
    R("column_absent", "No PII in Gold: phone", column="phone"),
    R("column_absent", "No PII in Gold: name", column="name"),
    R("unique_key", "No duplicate customers in Gold", column="customer_id"),
    R("values_in_range", "Fraud rate between 0-100%", column="fraud_rate", lo=0, hi=100),
]
GATE_CHECKS = [
    R("exists", "Silver data exists for date"),
    R("min_rows", "Minimum row count in Silver", lo=1000),
    R("no_nulls", "No nulls on transaction_id in Silver", column="transaction_id"),
    R("column_absent", "PII column removed: email", column="email"),
]



def _rule_sql(rule) -> tuple[str, str]:
    k, c = rule.kind, f'"{rule.column}"' if rule.column else None
    if k == "exists":
        return "COUNT(*) > 0", "CAST(NULL AS VARCHAR)"
    if k == "min_rows":
        return f"COUNT(*) >= {int(rule.lo)}", "CAST(COUNT(*) AS VARCHAR)"
    if k == "no_nulls":
        n = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        return f"{n} = 0", f"CAST({n} AS VARCHAR)"
    if k == "all_positive":
        bad = f"COUNT(*) FILTER (WHERE NOT COALESCE({c} > 0 AND NOT isnan(CAST({c} AS DOUBLE)), FALSE))"
        return f"{bad} = 0", f"CAST(COUNT(*) FILTER (WHERE {c} <= 0) AS VARCHAR) || ' negative'"
    if k == "unique_key":
        dup = f"(COUNT(*) - COUNT(DISTINCT {c}))"
        return f"{dup} = 0", f"CAST({dup} AS VARCHAR)"
    if k == "mean_pct_in_open_range":
        p = f"(AVG(CAST({c} AS DOUBLE)) * 100)"
        return (f"COALESCE({p} > {rule.lo} AND {p} < {rule.hi}, FALSE)",
                f"CAST(CAST({rnd(p)} AS DECIMAL(38,2)) AS VARCHAR) || '%'")
    if k == "values_in_range":
        out = (f"COUNT(*) FILTER (WHERE NOT COALESCE({c} BETWEEN {rule.lo} AND {rule.hi} "
               f"AND NOT isnan(CAST({c} AS DOUBLE)), FALSE))")
        return (f"{out} = 0",
                f"'min=' || CAST(CAST({rnd(f'MIN({c})', 1)} AS DECIMAL(38,1)) AS VARCHAR) || "
                f"' max=' || CAST(CAST({rnd(f'MAX({c})', 1)} AS DECIMAL(38,1)) AS VARCHAR)")
    raise ValueError(k)


def _lit(v) -> str:
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + str(v).replace("'", "''") + "'"


def suite_sql(suite: str, src: str, cols: list[str], rules) -> str:
    """One aggregate row over ``src``, unpivoted to one row per check."""
    aggs, selects = [], []
    for i, rule in enumerate(rules, start=1):
        if rule.kind in ("column_present", "column_absent"):
            present = rule.column in cols
            passed = "TRUE" if present == (rule.kind == "column_present") else "FALSE"
            actual = "CAST(NULL AS VARCHAR)"
        else:
            p, a = _rule_sql(rule)
            aggs += [f"{p} AS p{i}", f"{a} AS a{i}"]
            passed, actual = f"p{i}", f"a{i}"
        selects.append(f"SELECT {_lit(suite)} AS suite, {i} AS check_id, {_lit(rule.check)} "
                       f"AS \"check\", {passed} AS passed, {actual} AS actual, "
                       f"{_lit(rule.expected)} AS expected, p1 AS _exists FROM agg_{suite}")
    agg = f"agg_{suite} AS (SELECT {', '.join(aggs)} FROM {src})"
    body = " UNION ALL ".join(selects)
    return agg, (f"SELECT suite, check_id, \"check\", passed, actual, expected FROM ({body}) "
                 "WHERE _exists OR check_id = 1")


SILVER_TXN_COLS = TXN_COLS + ["copy", "processed_date", "silver_timestamp"]
SILVER_CUST_COLS = (CUST_KEEP.replace(" ", "").split(",")
                    + ["email_masked", "phone_masked", "name_masked", "address_masked",
                       "processed_date", "silver_timestamp"])
C360_COLS = SILVER_CUST_COLS + KYC_COLS[1:] + [
    "total_transactions", "total_spend", "avg_transaction", "fraud_rate", "total_tickets",
    "open_tickets", "updated_at", "batch_date", "is_current", "valid_from", "valid_to"]

cte("bronze_day", ("dirty_transactions",),
    f"SELECT * FROM dirty_transactions WHERE transaction_date = {DAY}")
cte("silver_day", ("dirty_dedup",),
    f"SELECT *, {STAMPS} FROM dirty_dedup WHERE {TXN_RULE} AND transaction_date = {DAY}")

SUITES = [
    ("bronze_transactions", "bronze_day", TXN_COLS + ["copy"], BRONZE_CHECKS),
    ("silver_transactions", "silver_day", SILVER_TXN_COLS, SILVER_CHECKS),
    ("silver_customers", "silver_customers", SILVER_CUST_COLS, CUSTOMER_CHECKS),
    ("gold_customer_360", "customer_360", C360_COLS, GOLD_CHECKS),
]


def suites_sql(which) -> str:
    deps, aggs, bodies = [], [], []
    for suite, src, cols, rules in SUITES:
        if suite in which:
            a, b = suite_sql(suite, src, cols, rules)
            deps.append(src)
            aggs.append(a)
            bodies.append(f"({b})")
    base = with_ctes(deps, "SELECT 1")
    head = base[:-len("SELECT 1")].rstrip()
    head = (head + ",\n" if head.startswith("WITH") else "WITH ") + ",\n".join(aggs)
    return head + "\n" + " UNION ALL ".join(bodies)


for _s in SUITES:
    ORACLE[f"dq_{_s[0]}"] = suites_sql([_s[0]])
ORACLE["dq_engine"] = suites_sql([s[0] for s in SUITES])
ORACLE["dq_report"] = (
    "SELECT suite, bool_and(passed) AS passed, COUNT(*) AS checks, "
    "COUNT(*) FILTER (WHERE NOT passed) AS failed FROM (" + ORACLE["dq_engine"].replace(
        "WITH ", "SELECT * FROM (WITH ", 1) + ")) GROUP BY suite")
_ga, _gb = suite_sql("gate", "silver_day", SILVER_TXN_COLS, GATE_CHECKS)
ORACLE["dq_gate"] = with_ctes(["silver_day"], "SELECT 1")[:-len("SELECT 1")].rstrip() + \
    ",\n" + _ga + "\n" + _gb

# ---- profiling -------------------------------------------------------------------

PROFILE_TABLES = [
    ("transactions", "dirty_transactions",
     [("transaction_id", True), ("customer_id", True), ("amount", True), ("merchant", False),
      ("category", False), ("timestamp", False), ("transaction_date", False),
      ("device_id", False), ("location_lat", True), ("location_lng", True),
      ("is_fraud", True), ("currency", False), ("copy", True)]),
    ("customers", "customers",
     [(c, c in ("customer_id", "avg_spend", "home_lat", "home_lng", "is_active"))
      for c in CUST_COLS]),
    ("kyc", "kyc", [(c, c == "customer_id") for c in KYC_COLS]),
    ("support_tickets", "support_tickets",
     [(c, c in ("ticket_id", "customer_id")) for c in TICKET_COLS]),
]


PROFILE_DOUBLES = {"amount", "location_lat", "location_lng", "avg_spend", "home_lat", "home_lng"}


def profile_sql(table: str, src: str, cols) -> str:
    parts = []
    for c, numeric in cols:
        q_ = f'"{c}"'
        null_pct = pct(f"COUNT(*) FILTER (WHERE {q_} IS NULL)", "COUNT(*)", 1)
        if numeric:
            dec = f"TRY_CAST({q_} AS DECIMAL(38,10))"
            whole = ("CAST(NULL AS DECIMAL(38,4))" if c in PROFILE_DOUBLES
                     else f"CAST({{}}({q_}) AS DECIMAL(38,4))")
            stats = (f"CAST(MIN({q_}) AS DOUBLE) AS min, CAST(MAX({q_}) AS DOUBLE) AS max, "
                     f"{whole.format('MIN')} AS min_exact, {whole.format('MAX')} AS max_exact, "
                     f"{rnd(f'CAST(SUM({dec}) AS DOUBLE) / NULLIF(COUNT({dec}), 0)')} AS mean, "
                     "CAST(NULL AS VARCHAR) AS sample")
        else:
            stats = ("CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
                     "CAST(NULL AS DECIMAL(38,4)) AS min_exact, "
                     "CAST(NULL AS DECIMAL(38,4)) AS max_exact, "
                     "CAST(NULL AS DOUBLE) AS mean, "
                     f"substring(CAST(MIN({q_}) AS VARCHAR), 1, 20) AS sample")
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, {null_pct} AS "
                     f"null_pct, COUNT(DISTINCT {q_}) AS n_distinct, {stats} FROM {src}")
    return " UNION ALL ".join(parts)


q("profile_columns", [t[1] for t in PROFILE_TABLES],
  " UNION ALL ".join(f"({profile_sql(*t)})" for t in PROFILE_TABLES))

_DUP_KEYS = [("transactions", "dirty_transactions", "transaction_id"),
             ("customers", "customers", "customer_id"), ("kyc", "kyc", "customer_id"),
             ("support_tickets", "support_tickets", "ticket_id")]
q("profile_duplicates", [d[1] for d in _DUP_KEYS], " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, COUNT(*) - (COUNT(DISTINCT {k}) + "
    f"CASE WHEN COUNT(*) FILTER (WHERE {k} IS NULL) > 0 THEN 1 ELSE 0 END) AS duplicates "
    f"FROM {src}" for t, src, k in _DUP_KEYS))


def dist_sql(table: str, src: str, col: str, value: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, value, count, "
            f"{pct('count', f'(SELECT COUNT(*) FROM {src})', 1)} AS pct FROM ("
            f"SELECT {value} AS value, COUNT(*) AS count FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY 1)")


q("profile_distribution", ["dirty_transactions", "kyc", "support_tickets"], " UNION ALL ".join([
    dist_sql("transactions", "dirty_transactions", "is_fraud",
             "CASE WHEN is_fraud = 1 THEN 'FRAUD' ELSE 'NORMAL' END"),
    dist_sql("kyc", "kyc", "kyc_status", "kyc_status"),
    dist_sql("kyc", "kyc", "risk_tier", "risk_tier"),
    dist_sql("support_tickets", "support_tickets", "category", "category"),
]))
q("profile_layer_totals", ["dirty_transactions", "customers", "kyc", "support_tickets"], """
SELECT table_name, rows FROM (
  SELECT 'transactions' AS table_name, COUNT(*) AS rows FROM dirty_transactions
  UNION ALL SELECT 'customers', COUNT(*) FROM customers
  UNION ALL SELECT 'kyc', COUNT(*) FROM kyc
  UNION ALL SELECT 'support_tickets', COUNT(*) FROM support_tickets)
UNION ALL
SELECT 'TOTAL', (SELECT COUNT(*) FROM dirty_transactions) + (SELECT COUNT(*) FROM customers)
  + (SELECT COUNT(*) FROM kyc) + (SELECT COUNT(*) FROM support_tickets)""")

# ---- lake read-backs ----------------------------------------------------------------

WEEK = f"transaction_date BETWEEN {DAY} - INTERVAL 6 DAY AND {DAY}"
q("scan_parquet_day", ["dirty_transactions"],
  f"SELECT * FROM dirty_transactions WHERE transaction_date = {DAY}")
q("scan_parquet", ["customers"], "SELECT * FROM customers")
q("scan_parquet_listing", ["dirty_transactions"], "SELECT * FROM dirty_transactions")
q("scan_multi_day_union", ["dirty_transactions"],
  f"SELECT * FROM dirty_transactions WHERE {WEEK}")
q("union_files", ["dirty_transactions"], f"SELECT * FROM dirty_transactions WHERE {WEEK}")
q("scan_lake_table", ["silver_customers"], "SELECT * FROM silver_customers")
q("write_silver_append", ["dirty_dedup"],
  f"SELECT *, {STAMPS} FROM dirty_dedup WHERE {TXN_RULE}")
ORACLE["write_gold_overwrite"] = ORACLE["agg_daily"]
q("write_dlq", ["dirty_dedup"],
  f"SELECT *, 'transactions' AS source, 'validation_failed' AS reason, {TS} AS dlq_timestamp, "
  f"{RUN_DATE} AS run_date FROM dirty_dedup WHERE NOT COALESCE({TXN_RULE}, FALSE)")

# ---- erasure ------------------------------------------------------------------------

cte("pending", ("deletion_requests",),
    "SELECT * FROM deletion_requests WHERE status = 'PENDING'")
cte("erase_keys", ("pending",), """
SELECT DISTINCT TRY_CAST(substring(customer_id, 5) AS BIGINT) AS customer_id FROM pending
WHERE starts_with(customer_id, 'CUST') AND TRY_CAST(substring(customer_id, 5) AS BIGINT) IS NOT NULL""")
RUN_STAMP = D.RUN_TS.strftime("%Y%m%d%H%M%S")
q("scan_pending_requests", ["pending"], "SELECT * FROM pending")
q("validate_request", ["deletion_requests"], f"""
SELECT customer_id,
       CASE WHEN ok THEN 'GDPR-' || customer_id || '-{RUN_STAMP}' END AS request_id,
       CASE WHEN ok THEN 'VALIDATED' ELSE 'REJECTED' END AS status,
       CASE WHEN empty THEN 'customer_id is required!'
            WHEN NOT ok THEN 'Invalid customer_id format: ' || customer_id END AS error,
       {TS} AS validated_at
FROM (SELECT customer_id, (customer_id IS NULL OR customer_id = '') AS empty,
             COALESCE(starts_with(customer_id, 'CUST'), FALSE)
               AND NOT (customer_id IS NULL OR customer_id = '') AS ok
      FROM deletion_requests)""")
INTAKE = """
SELECT customer_id, requested_at,
       CASE WHEN empty THEN NULL ELSE 'PENDING' END AS status,
       CASE WHEN NOT empty THEN 'GDPR-' || customer_id || '-' ||
            strftime(requested_at, '%Y%m%d%H%M%S') END AS request_id,
       CASE WHEN NOT empty THEN requested_at + INTERVAL 24 HOUR END AS sla_deadline,
       CAST(NULL AS TIMESTAMP) AS completed_at,
       CASE WHEN empty THEN 400 ELSE 200 END AS status_code
FROM (SELECT customer_id, requested_at, (customer_id IS NULL OR customer_id = '') AS empty
      FROM deletion_requests)"""
cte("intake", ("deletion_requests",), INTAKE)
q("intake_request", ["intake"], "SELECT * FROM intake")
q("insert_request", ["intake"], "SELECT * EXCLUDE (status_code) FROM intake WHERE status_code = 200")
q("filter_not_in", ["silver_customers", "erase_keys"],
  "SELECT * FROM silver_customers s WHERE NOT EXISTS "
  "(SELECT 1 FROM erase_keys k WHERE k.customer_id = s.customer_id)")
cte("silver_dirty", ("dirty_dedup",), f"SELECT *, {STAMPS} FROM dirty_dedup WHERE {TXN_RULE}")
ANTI_TXN = ("SELECT * FROM silver_dirty s WHERE NOT EXISTS "
            "(SELECT 1 FROM erase_keys k WHERE k.customer_id = s.customer_id)")
q("anti_join_delete", ["silver_dirty", "erase_keys"], ANTI_TXN)
q("rewrite_delete", ["silver_dirty", "erase_keys"], ANTI_TXN)
cte("valid", ("pending",), "SELECT * FROM pending WHERE starts_with(customer_id, 'CUST') "
    "AND TRY_CAST(substring(customer_id, 5) AS BIGINT) IS NOT NULL")
UPDATED = f"""
SELECT r.customer_id, r.requested_at, r.request_id, r.sla_deadline,
       CASE WHEN v.customer_id IS NOT NULL THEN 'COMPLETE'
            WHEN r.status = 'PENDING' THEN 'REJECTED' ELSE r.status END AS status,
       CASE WHEN v.customer_id IS NOT NULL THEN {TS} ELSE r.completed_at END AS completed_at,
       CASE WHEN v.customer_id IS NOT NULL THEN '{D.AUDIT_KEY}' END AS audit_log_key
FROM deletion_requests r
LEFT JOIN (SELECT DISTINCT customer_id, requested_at FROM valid) v
  ON r.customer_id = v.customer_id AND r.requested_at = v.requested_at"""
q("update_by_key", ["deletion_requests", "valid"], UPDATED)
q("update_request_status", ["deletion_requests", "valid"], UPDATED)
q("gdpr_run", ["deletion_requests", "valid"],
  f"SELECT * EXCLUDE (audit_log_key) FROM ({UPDATED})")


def _erase_count(label: str, src: str) -> str:
    return (f"SELECT '{label}' AS table_name, COUNT(*) AS rows_before, "
            f"COUNT(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM erase_keys)) "
            f"AS rows_deleted, COUNT(*) FILTER (WHERE customer_id IS NULL OR customer_id NOT IN "
            f"(SELECT customer_id FROM erase_keys)) AS rows_kept, 'OK' AS status, "
            f"CAST(NULL AS VARCHAR) AS error FROM {src}")


cte("state_days", ("silver_dirty",),
    "SELECT customer_id FROM silver_dirty GROUP BY customer_id, transaction_date")
cte("state_values", ("silver_dirty",), """
SELECT DISTINCT customer_id, transaction_date, d, v FROM (
  SELECT customer_id, transaction_date, 1 AS d, merchant AS v FROM silver_dirty
  UNION ALL SELECT customer_id, transaction_date, 2, category FROM silver_dirty
  UNION ALL SELECT customer_id, transaction_date, 3, device_id FROM silver_dirty)
WHERE v IS NOT NULL""")
_ERASED = " UNION ALL ".join([
    _erase_count("silver_customers", "silver_customers"),
    _erase_count("silver_transactions", "silver_dirty"),
    _erase_count("silver_kyc", "silver_kyc"),
    _erase_count("silver_tickets", "silver_tickets"),
    _erase_count("gold_customer_360", "customer_360"),
    _erase_count("gold_txn_customer_day", "state_days"),
    _erase_count("gold_txn_customer_values", "state_values"),
    _erase_count("gold_txn_customer_total",
                 "(SELECT DISTINCT customer_id FROM silver_dirty)"),
    _erase_count("gold_txn_customer_seen",
                 "(SELECT DISTINCT customer_id, d, v FROM state_values)")])
_ERASED_FROM = ["silver_customers", "silver_dirty", "silver_kyc", "silver_tickets",
                "customer_360", "state_days", "state_values", "erase_keys"]
q("gdpr_delete_batch", _ERASED_FROM, _ERASED)

ISO_TS = D.RUN_TS.strftime("%Y-%m-%dT%H:%M:%S")
q("render_notification", ["intake", "valid"], f"""
SELECT 'erasure' AS topic, 'GDPR Request Received: ' || request_id AS subject,
       'GDPR deletion request received!' || chr(10) || 'Customer: ' || customer_id || chr(10) ||
       'Request ID: ' || request_id || chr(10) || 'SLA deadline: ' ||
       strftime(sla_deadline, '%Y-%m-%dT%H:%M:%S') || chr(10) ||
       'Will complete within 24 hours.' AS message, {TS} AS created_at
FROM intake WHERE request_id IS NOT NULL
UNION ALL
SELECT 'erasure', 'GDPR Deletion Complete: ' || request_id,
       'Your data deletion is complete!' || chr(10) || 'Request ID: ' || request_id || chr(10) ||
       'Customer: ' || customer_id || chr(10) || 'Completed: {ISO_TS}' || chr(10) ||
       'All your data has been permanently deleted.', {TS}
FROM valid
UNION ALL
SELECT 'alerts', 'ALERT: daily_pipeline failed on silver',
       'PIPELINE FAILURE ALERT' || chr(10) || 'Pipeline: daily_pipeline' || chr(10) ||
       'Step: silver' || chr(10) || 'Date: {D.DAY.isoformat()}' || chr(10) || 'Time: {ISO_TS}' ||
       chr(10) || 'Action: Check the job logs.', {TS}
UNION ALL
SELECT 'alerts', 'SUCCESS: daily_pipeline',
       'Daily pipeline succeeded.' || chr(10) || 'Date: {D.DAY.isoformat()}' || chr(10) ||
       'Time: {ISO_TS}' || chr(10) || 'Gold tables updated.', {TS}""")

# ---- streaming ------------------------------------------------------------------------

cte("stream_rows", ("transactions",), """
SELECT 1 AS delivery, t.*,
       CASE WHEN transaction_id % 211 = 0 THEN 'not_base64'
            WHEN transaction_id % 223 = 0 THEN 'not_json'
            WHEN transaction_id % 227 = 0 THEN 'amount_text'
            WHEN transaction_id % 229 = 0 THEN 'amount_null'
            WHEN transaction_id % 233 = 0 THEN 'amount_absent'
            WHEN transaction_id % 239 = 0 THEN 'device_null'
            WHEN transaction_id % 241 = 0 THEN 'device_absent'
            WHEN transaction_id % 251 = 0 THEN 'timestamp_null' END AS fault
FROM transactions t
UNION ALL
SELECT 2, t.* REPLACE (amount * 2 AS amount), NULL FROM transactions t
WHERE transaction_id % 50 = 7""")
cte("stream_decoded", ("stream_rows",), """
SELECT CASE WHEN NOT (delivery = 1 AND transaction_id % 257 = 0)
            THEN CAST(delivery AS VARCHAR) || lpad(CAST(transaction_id AS VARCHAR), 55, '0')
       END AS seq,
       CASE WHEN broken THEN NULL ELSE CAST(transaction_id AS VARCHAR) END AS transaction_id,
       CASE WHEN broken THEN NULL ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
       CASE WHEN broken OR fault IN ('amount_text', 'amount_null', 'amount_absent') THEN NULL
            ELSE amount END AS amount,
       CASE WHEN broken THEN '' ELSE merchant END AS merchant,
       CASE WHEN broken THEN NULL ELSE category END AS category,
       CASE WHEN broken THEN '' WHEN fault = 'timestamp_null' THEN NULL
            ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S') END AS "timestamp",
       CASE WHEN broken OR fault = 'device_absent' THEN '' WHEN fault = 'device_null' THEN NULL
            ELSE device_id END AS device_id,
       CASE WHEN broken THEN 0.0 ELSE location_lat END AS location_lat,
       CASE WHEN broken THEN NULL ELSE location_lng END AS location_lng,
       CASE WHEN broken THEN 0 ELSE is_fraud END AS is_fraud,
       CASE WHEN broken THEN NULL ELSE currency END AS currency,
       CASE fault WHEN 'not_base64' THEN 'not_base64' WHEN 'not_json' THEN 'not_json_object'
            WHEN 'amount_text' THEN 'bad_amount' WHEN 'amount_null' THEN 'bad_amount'
            WHEN 'amount_absent' THEN 'bad_amount' WHEN 'device_null' THEN 'bad_device_id'
       END AS error
FROM (SELECT *, COALESCE(fault IN ('not_base64', 'not_json'), FALSE) AS broken FROM stream_rows)""")
q("stream_decode", ["stream_decoded"], "SELECT * FROM stream_decoded")
q("stream_error_split", ["stream_decoded"],
  f"SELECT seq, transaction_id, 'fraud_stream' AS source, error AS reason, {TS} AS dlq_timestamp "
  "FROM stream_decoded WHERE error IS NOT NULL")
_HS = "COALESCE(TRY_CAST(substring(\"timestamp\", 12, 2) AS INTEGER), 12)"
_SS, _SR = score_sql("amount", _HS, "device_id", "location_lat")
cte("stream_scored", ("stream_decoded",),
    f"SELECT *, CASE WHEN error IS NULL THEN CAST({_SS} AS INTEGER) END AS fraud_score, "
    f"CASE WHEN error IS NULL THEN {_SR} END AS reasons_json FROM stream_decoded")
q("batch_metrics", ["stream_scored"], f"""
SELECT COUNT(*) FILTER (WHERE error IS NULL) AS processed,
       COUNT(*) FILTER (WHERE error IS NULL AND fraud_score < 40) AS allowed,
       COUNT(*) FILTER (WHERE error IS NULL AND fraud_score >= 40 AND fraud_score < 70) AS flagged,
       COUNT(*) FILTER (WHERE error IS NULL AND fraud_score >= 70) AS blocked,
       COUNT(*) FILTER (WHERE error IS NOT NULL) AS errors
FROM stream_scored""")
STREAM_DECISIONS = f"""
SELECT transaction_id, customer_id,
       CAST(TRY_CAST(amount AS DECIMAL(38,2)) AS VARCHAR) AS amount, merchant, fraud_score,
       {decision_sql('fraud_score')} AS decision, reasons_json AS reasons,
       CAST(is_fraud AS INTEGER) AS actual_fraud, "timestamp", {TS} AS processed_at,
       'rule-engine-v1' AS model_version
FROM stream_scored WHERE error IS NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY coalesce(length(seq), 0) DESC,
                           seq DESC NULLS LAST) = 1"""
for _k in ("stream_upsert", "upsert_decisions", "stream_json_source"):
    q(_k, ["stream_scored"], STREAM_DECISIONS)

# ---- scalar function families ------------------------------------------------------

q("f_text", ["transactions"], """
SELECT transaction_id, sha256(device_id) AS device_hash,
       starts_with(device_id, 'device-') AS known_device,
       substring(CAST(transaction_date AS VARCHAR), 1, 4) AS txn_year,
       substring(CAST(transaction_date AS VARCHAR), 6, 2) AS txn_month,
       substring(CAST(transaction_date AS VARCHAR), 9, 2) AS txn_day,
       CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amount_text,
       substring(CAST(transaction_date AS VARCHAR), 1, 7) AS month_sample,
       CASE WHEN is_fraud = 1 THEN 'FRAUD' ELSE 'NORMAL' END AS fraud_label,
       'TXN-' || CAST(transaction_id AS VARCHAR) || '-' || strftime("timestamp", '%Y%m%d') AS txn_ref
FROM transactions""")
q("f_numeric", ["transactions"], f"""
SELECT transaction_id, {rnd('amount / 3')} AS amount_third,
       amount / NULLIF(location_lat - 8, 0) AS amount_per_lat,
       CASE WHEN amount > 100000 THEN 'very_high' WHEN amount > 50000 THEN 'high'
            WHEN amount > 20000 THEN 'elevated' ELSE 'normal' END AS amount_tier,
       LEAST(amount / 1000, 100.0) AS capped_thousands,
       COALESCE(CASE WHEN merchant <> 'm0' THEN merchant END, 'unknown') AS merchant_or_unknown,
       category IN ('click', 'purchase') AS low_touch,
       device_id IS NULL AS device_missing
FROM transactions""")
q("f_time", ["transactions"], f"""
SELECT transaction_id,
       COALESCE(TRY_CAST(substring(strftime("timestamp", '%Y-%m-%dT%H:%M:%S'), 12, 2) AS INTEGER), 12)
         AS hour_from_text,
       transaction_date - 1 AS previous_day,
       "timestamp" + INTERVAL 24 HOUR AS deadline,
       strftime("timestamp", '%Y%m%d%H%M%S') AS stamp,
       strftime("timestamp", '%Y%m%d') AS day_key,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS iso_ts,
       DATE '9999-12-31' AS open_end, {TS} AS run_ts
FROM transactions""")
q("f_codec", ["transactions"], """
SELECT transaction_id, to_base64(encode(merchant)) AS merchant_b64,
       decode(from_base64(to_base64(encode(merchant)))) AS merchant_decoded,
       CAST(NULL AS VARCHAR) AS junk_decoded,
       merchant AS merchant_from_json,
       array_to_string(list_filter([CASE WHEN is_fraud = 1 THEN 'fraud' END,
                                    CASE WHEN amount > 50000 THEN 'big' END],
                                   lambda x: x IS NOT NULL), ',') AS tags,
       CAST(len(list_filter([CASE WHEN is_fraud = 1 THEN 'fraud' END,
                        CASE WHEN amount > 50000 THEN 'big' END], lambda x: x IS NOT NULL))
            AS INTEGER) AS n_tags,
       map_extract_value(MAP(['merchant', 'category'], [merchant, category]), 'category')
         AS category_from_map
FROM transactions""")

# ---- catalog and the daily run ---------------------------------------------------

q("catalog_register", ["dirty_transactions", "customers", "kyc", "support_tickets"],
  "SELECT *, CAST(year(\"timestamp\") AS INTEGER) AS year, "
  "CAST(month(\"timestamp\") AS INTEGER) AS month, "
  "CAST(day(\"timestamp\") AS INTEGER) AS day, "
  "(SELECT COUNT(*) FROM customers) AS n_customers, (SELECT COUNT(*) FROM kyc) AS n_kyc, "
  "(SELECT COUNT(*) FROM support_tickets) AS n_support_tickets FROM dirty_transactions")
ORACLE["daily_run"] = with_ctes(["silver_day"], "SELECT 1")[:-len("SELECT 1")] + \
    regulatory_sql("", "", DAY).replace("FROM silver_transactions", "FROM silver_day").replace(
        "SELECT *, ", "SELECT * REPLACE (CAST(total_transactions AS BIGINT) AS total_transactions), ", 0)

# The tables that the daily run writes, for its one day.
cte("txn_summary_day", ("silver_day",), txn_summary_sql("silver_day"))
q("daily_silver_transactions", ["silver_day"],
  f"SELECT * REPLACE ({DAY} AS processed_date) FROM silver_day")
for _t, _c in (("daily_silver_customers", "silver_customers"), ("daily_silver_kyc", "silver_kyc"),
               ("daily_silver_support_tickets", "silver_tickets")):
    q(_t, [_c], f"SELECT * REPLACE ({DAY} AS processed_date) FROM {_c}")
q("daily_customer_360", ["silver_customers", "silver_kyc", "txn_summary_day", "ticket_summary"],
  f"SELECT * REPLACE ({DAY} AS processed_date, {DAY} AS batch_date, {DAY} AS valid_from) FROM ("
  + CUSTOMER_360.replace("LEFT JOIN txn_summary t", "LEFT JOIN txn_summary_day t") + ")")
q("daily_aggregates", ["silver_day"],
  DAILY.replace("FROM silver_transactions GROUP BY", "FROM silver_day GROUP BY"))
cte("dirty_day", ("dirty_transactions",),
    f"SELECT * FROM dirty_transactions WHERE transaction_date = {DAY}")
cte("dirty_day_dedup", ("dirty_day",),
    _dedup("dirty_day", "transaction_id", TXN_COLS + ["copy"], ["timestamp", "copy"]))
q("daily_dlq_transactions", ["dirty_day_dedup"],
  f"SELECT *, 'transactions' AS source, 'validation_failed' AS reason, {TS} AS dlq_timestamp, "
  f"{DAY} AS run_date FROM dirty_day_dedup WHERE NOT COALESCE({TXN_RULE}, FALSE)")

# ---- gold composites and the quality alert ------------------------------------------

q("gold_daily_aggregates", ["silver_dirty"],
  DAILY.replace("FROM silver_transactions GROUP BY",
                f"FROM silver_dirty WHERE transaction_date = {DAY} GROUP BY"))
q("gold_regulatory_report", ["silver_dirty"],
  regulatory_sql(f"WHERE transaction_date = {DAY}", "", DAY).replace(
      "FROM silver_transactions", "FROM silver_dirty"))

_ALERT = (f"SELECT 'alerts' AS topic, 'DATA QUALITY ALERT' AS subject, "
          f"'DATA QUALITY FAILURE' || chr(10) || 'Date: {D.DAY.isoformat()}' || chr(10) || "
          "'Failed checks: [' || string_agg('''' || suite || '''', ', ' ORDER BY suite) || ']' "
          "|| chr(10) || 'Action: Investigate before running ETL!' AS message, "
          f"{TS} AS created_at FROM (SELECT suite FROM dq_rows GROUP BY suite "
          "HAVING NOT bool_and(passed)) HAVING COUNT(*) > 0")
_base = ORACLE["render_notification"]
_dq = ORACLE["dq_engine"]
_dq_ctes, _dq_body = _dq.split("\n(SELECT suite", 1)
_dq_body = "(SELECT suite" + _dq_body
_rn_body = _base[len(with_ctes(["intake", "valid"], "")):]
ORACLE["render_notification"] = (
    _dq_ctes.replace("WITH ", "WITH " + with_ctes(["intake", "valid"], "")[5:].rstrip() + ",\n", 1)
    + f",\ndq_rows AS ({_dq_body})\n"
    + f"SELECT * FROM ({_rn_body}) UNION ALL {_ALERT}")

# ---- audit ids and stream progress counters ------------------------------------------

q("write_audit_json", ["valid", *_ERASED_FROM],
  f"SELECT 'GDPR-BATCH-{RUN_STAMP}' AS batch_id, customer_id, request_id, requested_at, "
  f"{TS} AS processed_at, CAST((SELECT COUNT(*) FROM valid) AS INTEGER) AS total_requests, "
  f"'COMPLETE' AS status, 9 AS n_tables, (SELECT CAST(SUM(rows_deleted) AS BIGINT) FROM "
  f"({_ERASED})) AS rows_deleted FROM valid")
ORACLE["stream_metrics"] = ORACLE["batch_metrics"].replace(
    "SELECT COUNT(*) FILTER (WHERE error IS NULL) AS processed,",
    "SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) FILTER (WHERE error IS NULL) AS processed,")
