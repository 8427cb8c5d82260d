-- Top 10 (merchant, category) pairs by total amount; ties broken by key.
SELECT
  merchant,
  category,
  COUNT(transaction_id) AS transaction_count,
  ROUND(CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_amount,
  ROUND(TRY_DIVIDE(CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE),
                   COUNT(amount)), 2) AS avg_amount,
  SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS fraud_count
FROM {transactions}
GROUP BY merchant, category
ORDER BY total_amount DESC NULLS LAST, merchant, category
LIMIT 10
