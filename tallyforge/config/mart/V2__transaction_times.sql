SELECT transaction_id, amount_paise, merchant_id, instrument_type, gateway_status, reconciliation_status AS status, bank_ref_id,
  try_to_timestamp(timestamp_utc) AS transacted_at,
  CASE WHEN reconciliation_status = 'MATCHED' THEN amount_paise END AS matched_amount_paise
FROM __SOURCE_TABLE__
