-- Daily fraud summary over all transactions, newest day first.
-- Money sums run on decimal(18,2); the fraud share divides as double.
SELECT
  transaction_date,
  COUNT(transaction_id) AS total_transactions,
  CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS fraud_count,
  ROUND(TRY_DIVIDE(CAST(SUM(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE),
                   COUNT(amount)), 2) AS avg_amount,
  ROUND(TRY_DIVIDE(CAST(SUM(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS DOUBLE),
                   COUNT(transaction_id)) * 100, 2) AS fraud_rate_pct
FROM {transactions}
GROUP BY transaction_date
ORDER BY transaction_date DESC
