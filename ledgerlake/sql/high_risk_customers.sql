-- Up to 100 customers that are high-tier or have a fraud rate above 10 %,
-- highest rate first; ties broken by customer_id.
SELECT
  customer_id,
  total_transactions,
  total_spend,
  fraud_txn_count,
  fraud_rate,
  risk_tier,
  kyc_status,
  total_tickets
FROM {customer_360}
WHERE risk_tier = 'HIGH'
   OR fraud_rate > 10
ORDER BY fraud_rate DESC NULLS LAST, customer_id
LIMIT 100
