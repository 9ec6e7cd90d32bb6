"""DuckDB twins of the registered queries, written as plain SQL over the same derived ledgers."""

from __future__ import annotations

from ..functions.text import ALIASES
from .derived import AS_OF, INSTRUMENTS, LAG_DAYS, LATE_DAYS, METHODS, NOW, SHIFT_DAYS, SPELLINGS


def _h(tag: str, key: str = "k") -> str:
    return f"(CAST('0x' || substr(sha256('7|{tag}|' || CAST({key} AS VARCHAR)), 1, 4) AS BIGINT) % 100)"


def _pick(names: list[str | None], index: str) -> str:
    quote = lambda n: "NULL" if n is None else "'" + n.replace("'", "''") + "'"
    return f"list_extract([{', '.join(quote(n) for n in names)}], CAST({index} AS INTEGER) + 1)"


def _bps(x: str, bps: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN -((-({x}) * {bps} + 5000) // 10000) ELSE (({x}) * {bps} + 5000) // 10000 END)"


def _mdr(inst: str, merch: str | None) -> str:
    own = f"WHEN {inst} = 'CREDIT_CARD' AND {merch} = 'merch_001' THEN 180 WHEN {inst} = 'CREDIT_CARD' AND {merch} = 'merch_demo' THEN 190" if merch else ""
    return f"(CASE {own} WHEN {inst} = 'UPI' THEN 0 WHEN {inst} = 'CREDIT_CARD' THEN 200 WHEN {inst} = 'DEBIT_CARD' THEN 100 WHEN {inst} = 'INTERNATIONAL' THEN 300 ELSE 150 END)"


def _gst(inst: str) -> str:
    return f"(CASE WHEN {inst} = 'UPI' THEN 0 ELSE 1800 END)"


def _fee(x: str, inst: str, merch: str | None) -> str:
    return _bps(x, _mdr(inst, merch))


def _net(x: str, inst: str, merch: str | None) -> str:
    fee = _fee(x, inst, merch)
    return f"(({x}) - {fee} - {_bps(fee, _gst(inst))})"


_BASE = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS gross, CAST(o_orderdate AS TIMESTAMP) AS od,
    'tx_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS transaction_id,
    CASE WHEN o_custkey % 10 = 0 THEN 'merch_001' WHEN o_custkey % 10 = 1 THEN 'merch_demo' WHEN o_custkey % 10 <> 2 THEN 'm_' || CAST(o_custkey % 50 AS VARCHAR) END AS merchant_id
  FROM orders),
webhooks AS (
  SELECT transaction_id, CASE WHEN {_h("null")} >= 1 THEN CASE WHEN {_h("rev")} < 2 THEN -gross ELSE gross END END AS amount_paise,
    CASE WHEN {_h("rev")} < 2 THEN 'REFUND' ELSE 'CAPTURED' END AS gateway_status,
    CASE WHEN {_h("ts")} < 1 THEN 'not-a-timestamp' ELSE strftime(od + INTERVAL {SHIFT_DAYS} DAY, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp_utc,
    CASE WHEN {_h("ts")} < 1 THEN NULL ELSE CAST(od + INTERVAL {SHIFT_DAYS} DAY AS DATE) END AS day,
    merchant_id, 'run_1' AS processing_run_id,
    CASE WHEN {_h("rev")} < 2 THEN 'EXCEPTION_REVERSAL' WHEN {_h("st")} < 3 THEN 'MATCHED' WHEN {_h("st")} < 4 THEN 'EXCEPTION_MISSING_BANK_STATEMENT'
      WHEN {_h("st")} < 6 THEN 'EXCEPTION_LATE_UNRESOLVED' WHEN {_h("st")} < 8 THEN 'EXCEPTION_MISSING_WEBHOOK' ELSE 'PENDING_RECONCILIATION' END AS reconciliation_status,
    CASE WHEN {_h("wcur")} >= 5 THEN 'INR' END AS currency,
    CASE WHEN {_h("dup")} < 3 THEN {_h("dup")} ELSE 0 END AS duplicate_mutation_count
  FROM base WHERE NOT {_h("fault")} BETWEEN 7 AND 11),
st0 AS (
  SELECT *, CASE WHEN {_h("sd")} < 1 THEN 'not-a-date' ELSE strftime(CAST(od AS DATE) + CAST({SHIFT_DAYS} + {_h("lag")} % 5 AS INTEGER), '%Y-%m-%d') END AS settlement_date,
    {_pick(INSTRUMENTS, _h("inst") + " % 7")} AS instrument_type, {_h("fault")} AS fault, {_pick(["razorpay", "cashfree", "payu", None], _h("prov") + " % 4")} AS provider,
    CASE WHEN {_h("cur")} < 2 THEN 'USD' WHEN {_h("cur")} >= 5 THEN 'INR' END AS currency
  FROM base),
st1 AS (
  SELECT *, {_fee("gross", "instrument_type", "merchant_id")} AS fee_paise,
    {_net("gross", "instrument_type", "merchant_id")} + CASE WHEN fault < 5 THEN 50 + fault WHEN fault = 5 THEN 1 WHEN fault = 6 THEN -1 ELSE 0 END AS net
  FROM st0),
st2 AS (
  SELECT *, net AS a, '' AS r, CASE WHEN fault BETWEEN 12 AND 13 THEN '_1' ELSE '' END AS s FROM st1 WHERE NOT fault BETWEEN 14 AND 15
  UNION ALL SELECT *, net, '', '_2' FROM st1 WHERE fault BETWEEN 12 AND 13
  UNION ALL SELECT *, net // 2, 'a', 'a' FROM st1 WHERE fault BETWEEN 14 AND 15
  UNION ALL SELECT *, net - net // 2, 'b', 'b' FROM st1 WHERE fault BETWEEN 14 AND 15),
settlements AS (
  SELECT 'br_' || k || r AS bank_ref_id, transaction_id, CAST(a AS BIGINT) AS settled_amount_paise, settlement_date, instrument_type, merchant_id, CAST(fee_paise AS BIGINT) AS fee_paise,
    CAST({_bps("fee_paise", _gst("instrument_type"))} AS BIGINT) AS gst_paise, 's_' || k || s AS settlement_id, 'br_' || k || r AS utr, currency, gross AS gross_amount_paise, provider
  FROM st2),
once AS (
  SELECT transaction_id, settled_amount_paise, settlement_date, bank_ref_id, min(settlement_id) AS settlement_id, any_value(instrument_type) AS instrument_type, any_value(merchant_id) AS merchant_id,
    any_value(fee_paise) AS fee_paise, any_value(gst_paise) AS gst_paise, any_value(utr) AS utr, any_value(currency) AS currency, any_value(gross_amount_paise) AS gross_amount_paise, any_value(provider) AS provider
  FROM settlements GROUP BY 1, 2, 3, 4),
folded AS (
  SELECT transaction_id, CAST(sum(settled_amount_paise) AS BIGINT) AS settled_amount_paise, CAST(sum(fee_paise) AS BIGINT) AS fee_paise, CAST(sum(gst_paise) AS BIGINT) AS gst_paise, max(settlement_date) AS settlement_date,
    arg_max(bank_ref_id, settlement_date || '|' || bank_ref_id) AS bank_ref_id, arg_max(settlement_id, settlement_date || '|' || bank_ref_id) AS settlement_id, arg_max(utr, settlement_date || '|' || bank_ref_id) AS utr,
    arg_max(gross_amount_paise, settlement_date || '|' || bank_ref_id) AS gross_amount_paise, max(instrument_type) AS instrument_type, max(merchant_id) AS merchant_id, max(currency) AS currency, max(provider) AS provider, count(*) AS instalments
  FROM once GROUP BY 1),
src AS (SELECT *, coalesce(merchant_id, 'UNKNOWN') AS m FROM folded WHERE settled_amount_paise IS NOT NULL),
decided AS (
  SELECT s.*, t.transaction_id AS tid, t.amount_paise AS t_amount, t.reconciliation_status AS t_status, {_net("t.amount_paise", "s.instrument_type", "s.m")} AS t_net,
    CASE WHEN t.transaction_id IS NULL THEN 'EXCEPTION_MISSING_WEBHOOK'
      WHEN t.reconciliation_status IN ('EXCEPTION_MISSING_WEBHOOK', 'EXCEPTION_LATE_UNRESOLVED') THEN t.reconciliation_status
      WHEN t.amount_paise IS NULL THEN 'EXCEPTION_FEE_MISMATCH'
      WHEN t.reconciliation_status NOT IN ('MATCHED', 'EXCEPTION_MISSING_BANK_STATEMENT') THEN
        CASE WHEN t.currency <> s.currency THEN 'EXCEPTION_CURRENCY_MISMATCH'
          WHEN abs({_net("t.amount_paise", "s.instrument_type", "s.m")} - s.settled_amount_paise) <= 1 THEN 'MATCHED' ELSE 'EXCEPTION_FEE_MISMATCH' END
      ELSE t.reconciliation_status END AS status
  FROM src s LEFT JOIN webhooks t USING (transaction_id)),
merged AS (
  SELECT t.transaction_id, t.amount_paise, t.gateway_status, t.timestamp_utc, t.day, t.merchant_id, coalesce(d.status, t.reconciliation_status) AS reconciliation_status,
    CASE WHEN d.tid IS NOT NULL AND (t.amount_paise IS NULL OR t.reconciliation_status NOT IN ('MATCHED', 'EXCEPTION_MISSING_BANK_STATEMENT')) THEN d.bank_ref_id END AS bank_ref_id,
    CASE WHEN d.tid IS NOT NULL AND (t.amount_paise IS NULL OR t.reconciliation_status NOT IN ('MATCHED', 'EXCEPTION_MISSING_BANK_STATEMENT')) THEN d.instrument_type END AS instrument_type, t.currency, t.duplicate_mutation_count
  FROM webhooks t LEFT JOIN decided d USING (transaction_id)
  UNION ALL
  SELECT transaction_id, settled_amount_paise, 'UNKNOWN', settlement_date, try_strptime(settlement_date, '%Y-%m-%d')::DATE, m, 'EXCEPTION_MISSING_WEBHOOK', bank_ref_id, instrument_type, currency, NULL FROM decided WHERE tid IS NULL),
swept AS (
  SELECT *, CASE WHEN reconciliation_status IN ('EXCEPTION_MISSING_WEBHOOK', 'EXCEPTION_LATE_UNRESOLVED', 'PENDING_RECONCILIATION') AND day < DATE '{AS_OF}' - {LATE_DAYS} THEN 'EXCEPTION_LATE_UNRESOLVED' ELSE reconciliation_status END AS st
  FROM merged),
bs0 AS (
  SELECT transaction_id, CAST(substr(transaction_id, 4) AS BIGINT) AS k, max(settlement_date) AS d, sum(CASE WHEN settlement_id NOT LIKE '%\\_2' ESCAPE '\\' THEN settled_amount_paise END) AS a FROM settlements GROUP BY 1),
statements AS (
  SELECT k AS statement_id, CAST((a + {_h("bamt")} % 3 - 1) * CASE WHEN {_h("bneg")} < 2 THEN -1 ELSE 1 END AS BIGINT) AS amount_paise,
    strftime(try_strptime(d, '%Y-%m-%d')::DATE + CAST({_h("bdate")} % 5 AS INTEGER), '%Y-%m-%d') AS value_date, CASE WHEN {_h("blink")} < 60 THEN transaction_id END AS link_tx
  FROM bs0 WHERE {_h("bs")} < 90),
missing_ev AS (
  SELECT s.transaction_id, s.settled_amount_paise, s.settlement_date FROM folded s WHERE NOT EXISTS (
    SELECT 1 FROM statements b WHERE b.link_tx = s.transaction_id)
  AND NOT EXISTS (SELECT 1 FROM statements b WHERE b.link_tx IS NULL AND abs(b.amount_paise - s.settled_amount_paise) <= 1
    AND abs(datediff('day', try_strptime(s.settlement_date, '%Y-%m-%d')::DATE, try_strptime(b.value_date, '%Y-%m-%d')::DATE)) <= {LAG_DAYS})),
orphan_ev AS (
  SELECT b.statement_id, b.amount_paise, b.value_date, b.link_tx FROM statements b WHERE NOT EXISTS (
    SELECT 1 FROM folded s WHERE b.link_tx = s.transaction_id)
  AND NOT (b.link_tx IS NULL AND EXISTS (SELECT 1 FROM folded s WHERE abs(b.amount_paise - s.settled_amount_paise) <= 1
    AND abs(datediff('day', try_strptime(s.settlement_date, '%Y-%m-%d')::DATE, try_strptime(b.value_date, '%Y-%m-%d')::DATE)) <= {LAG_DAYS}))),
arrivals AS (
  SELECT {_h("dec")} >= 3 AS decodable, CASE WHEN {_h("noid")} >= 2 THEN transaction_id END AS transaction_id,
    CASE WHEN {_h("aamt")} < 4 THEN -gross WHEN {_h("aamt")} < 5 THEN 0 ELSE gross + 1 END AS amount_paise,
    CASE WHEN {_h("aamt")} < 2 THEN ' refund ' WHEN {_h("aamt")} < 3 THEN 'CAPTURED' WHEN {_h("aamt")} < 5 THEN NULL ELSE 'CAPTURED' END AS gateway_status,
    strftime(od + INTERVAL {SHIFT_DAYS + 1} DAY, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc, od + INTERVAL {SHIFT_DAYS + 1} DAY AS came, merchant_id, 'run_2' AS processing_run_id, 'INR' AS currency
  FROM base),
judged AS (
  SELECT *, CASE WHEN decodable AND transaction_id IS NOT NULL AND amount_paise > 0 THEN 'forward'
    WHEN decodable AND transaction_id IS NOT NULL AND amount_paise <= 0 AND upper(trim(gateway_status)) IN ('REFUND', 'REFUNDED', 'REFUND_PENDING', 'PARTIAL_REFUND', 'REVERSED', 'REVERSAL', 'CHARGEBACK', 'DISPUTE') THEN 'reversal'
    ELSE 'rejected' END AS kind
  FROM arrivals),
letters AS (
  SELECT DISTINCT transaction_id, amount_paise, gateway_status, timestamp_utc, merchant_id, processing_run_id,
    sha256(concat_ws(chr(31), coalesce(transaction_id, ''), coalesce(CAST(amount_paise AS VARCHAR), ''), coalesce(gateway_status, ''), timestamp_utc, coalesce(merchant_id, ''), processing_run_id)) AS payload_hash,
    transaction_id IS NOT NULL AND (amount_paise > 0 OR coalesce(upper(trim(gateway_status)) NOT IN ('REFUND', 'REFUNDED', 'REFUND_PENDING', 'PARTIAL_REFUND', 'REVERSED', 'REVERSAL', 'CHARGEBACK', 'DISPUTE'), false)) AS replayable,
    transaction_id IS NOT NULL AND amount_paise <= 0 AND coalesce(upper(trim(gateway_status)) IN ('REFUND', 'REFUNDED', 'REFUND_PENDING', 'PARTIAL_REFUND', 'REVERSED', 'REVERSAL', 'CHARGEBACK', 'DISPUTE'), false) AS stranded
  FROM judged WHERE kind = 'rejected'),
upserted AS (
  SELECT t.transaction_id, CASE WHEN w THEN a.amount_paise ELSE t.amount_paise END AS amount_paise, CASE WHEN w THEN a.gateway_status ELSE t.gateway_status END AS gateway_status,
    CASE WHEN w THEN a.timestamp_utc ELSE t.timestamp_utc END AS timestamp_utc, CASE WHEN w THEN a.processing_run_id ELSE t.processing_run_id END AS processing_run_id,
    CASE WHEN w THEN 'PENDING_RECONCILIATION' ELSE t.reconciliation_status END AS reconciliation_status, t.currency, t.duplicate_mutation_count + CASE WHEN a.transaction_id IS NOT NULL AND NOT w THEN 1 ELSE 0 END AS duplicate_mutation_count
  FROM (SELECT t.*, a.transaction_id IS NOT NULL AND t.reconciliation_status IN ('EXCEPTION_MISSING_WEBHOOK', 'EXCEPTION_LATE_UNRESOLVED', 'PENDING_RECONCILIATION') AS w FROM webhooks t LEFT JOIN (SELECT * FROM judged WHERE kind <> 'rejected') a USING (transaction_id)) t
  LEFT JOIN (SELECT * FROM judged WHERE kind <> 'rejected') a USING (transaction_id)
  UNION ALL
  SELECT transaction_id, amount_paise, gateway_status, timestamp_utc, processing_run_id, CASE WHEN amount_paise <= 0 THEN 'EXCEPTION_REVERSAL' ELSE 'PENDING_RECONCILIATION' END, currency, 0
  FROM judged a WHERE kind <> 'rejected' AND transaction_id NOT IN (SELECT transaction_id FROM webhooks)),
pf AS (
  SELECT *, CAST(od AS DATE) + {SHIFT_DAYS} AS pday, CASE WHEN {_h("df")} < 30 THEN 'dmy' WHEN {_h("df")} < 50 THEN 'dmy' WHEN {_h("df")} < 70 THEN 'iso' WHEN {_h("df")} < 74 THEN 'none' ELSE 'iso' END AS df,
    gross + CASE WHEN {_h("mf")} BETWEEN 20 AND 39 THEN 1 ELSE 0 END AS paise, {_pick(METHODS, _h("meth") + " % " + str(len(METHODS)))} AS method,
    CASE {_h("cur")} % 4 WHEN 0 THEN 'INR' WHEN 1 THEN 'INR' END AS cur, CASE WHEN {_h("mer")} < 10 THEN 'UNKNOWN' ELSE 'm_' || c END AS mer
  FROM base),
canon AS (SELECT *, CASE WHEN df = 'none' THEN NULL ELSE strftime(pday, '%Y-%m-%d') END AS day FROM pf)
"""


def _alias(raw: str) -> str:
    """The instrument of a spelling, as nested rules: exact first, then the longest alias inside."""
    key = f"replace(replace(lower(trim({raw})), '-', '_'), ' ', '_')"
    exact = " ".join(f"WHEN {key} = '{a}' THEN '{v}'" for a, v in ALIASES.items())
    inside = " ".join(f"WHEN contains({key}, '{a}') THEN '{ALIASES[a]}'" for a in sorted(ALIASES, key=len, reverse=True))
    return f"CASE WHEN {raw} IS NULL OR {key} = '' THEN 'UNKNOWN' {exact} {inside} ELSE 'UNKNOWN' END"


def _q(sql: str) -> str:
    return f"WITH {_BASE} {sql}"


_PCT = "CAST((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100.0"
_MATCHED = "CAST(sum(CASE WHEN reconciliation_status = 'MATCHED' THEN 1 ELSE 0 END) AS BIGINT)"
_RUPEES = "CAST(sum(amount_paise) AS DOUBLE) / 100.0"
_EXCESS = "greatest(dgap - 1, mgap - 1)"
_SCORE = f"CASE WHEN dgap <= 1 AND mgap > 1 THEN 0.95 WHEN {_EXCESS} <= 0 THEN 0.05 + 0.1 / (1 + exp(-(CAST({_EXCESS} AS DOUBLE) / 10))) ELSE 0.2 + 0.75 / (1 + exp(-((CAST({_EXCESS} AS DOUBLE) - 10) / 20))) END"
_SCORED = f"""scored AS (
  SELECT transaction_id, {_SCORE} AS score FROM (
    SELECT s.transaction_id, abs({_net("t.amount_paise", "s.instrument_type", None)} - s.settled_amount_paise) AS dgap, abs({_net("t.amount_paise", "s.instrument_type", "s.m")} - s.settled_amount_paise) AS mgap
    FROM src s JOIN merged t USING (transaction_id) WHERE t.reconciliation_status = 'MATCHED' AND t.amount_paise IS NOT NULL))"""
_RULES = {
    "settlement_date": "day IS NULL",
    "instrument_type": f"({_alias('method')}) = 'UNKNOWN'",
}


def _canon(provider: str) -> str:
    inst = _alias("method")
    fee, gst = {"razorpay": (101, 18), "cashfree": (268, 18), "payu": (-13, 18), "generic": (-1, None)}[provider]
    generic = provider == "generic"
    tx = "CAST(k AS VARCHAR)" if provider == "payu" else "'pay_' || k"
    settlement = "NULL" if generic else "'setl_' || k"
    ref = "'setl_' || k" if provider == "payu" else "'utr_' || k"
    return f"""SELECT {ref} AS bank_ref_id, {tx} AS transaction_id, CAST({'gross' if generic else 'paise'} AS BIGINT) AS settled_amount_paise, day AS settlement_date, {inst} AS instrument_type,
      {'mer' if provider in ('cashfree', 'generic') else "'UNKNOWN'"} AS merchant_id, CAST({fee} AS BIGINT) AS fee_paise, CAST({'NULL' if gst is None else gst} AS BIGINT) AS gst_paise, CAST({settlement} AS VARCHAR) AS settlement_id,
      {ref} AS utr, cur AS currency, CAST({'NULL' if generic else 'paise'} AS BIGINT) AS gross_amount_paise, '{'acme' if generic else provider}' AS provider FROM canon"""


SQL = {
    "settlement_decision": _q("SELECT status, count(*) AS n, CAST(sum(settled_amount_paise) AS BIGINT) AS settled_paise FROM decided GROUP BY 1"),
    "settlement_fold": _q("SELECT transaction_id, settled_amount_paise, fee_paise, gst_paise, settlement_date, bank_ref_id, settlement_id, utr, gross_amount_paise, instrument_type, merchant_id, currency, provider, instalments FROM folded"),
    "partial_settlements": _q("SELECT transaction_id, instalments, settled_amount_paise FROM folded WHERE instalments > 1"),
    "redelivery_collapse": _q("SELECT transaction_id, settled_amount_paise, settlement_date, bank_ref_id, settlement_id FROM once"),
    "fee_net": _q(f"SELECT settlement_id, CAST({_fee('gross_amount_paise', 'instrument_type', 'merchant_id')} AS BIGINT) AS fee, CAST({_bps(_fee('gross_amount_paise', 'instrument_type', 'merchant_id'), _gst('instrument_type'))} AS BIGINT) AS gst, CAST({_net('gross_amount_paise', 'instrument_type', 'merchant_id')} AS BIGINT) AS net FROM settlements"),
    "rate_card_asof": _q("SELECT CASE WHEN try_strptime(settlement_date, '%Y-%m-%d') IS NULL OR settlement_date >= '2025-04-01' THEN 'v2.0.0' ELSE 'v1.0.0' END AS version, instrument_type, count(*) AS n FROM settlements GROUP BY 1, 2"),
    "fee_fallback_census": _q("""SELECT r.reason, count(f.reason) AS n FROM (VALUES ('card_unparseable_date'), ('card_out_of_range'), ('merchant_unknown'), ('instrument_unknown')) r(reason)
      LEFT JOIN (SELECT CASE WHEN try_strptime(settlement_date, '%Y-%m-%d') IS NULL THEN 'card_unparseable_date' WHEN settlement_date < '2024-01-01' THEN 'card_out_of_range'
        WHEN merchant_id IS NOT NULL AND merchant_id NOT IN ('UNKNOWN', 'merch_001', 'merch_demo') THEN 'merchant_unknown' WHEN instrument_type IS NULL OR instrument_type = 'CRYPTO' THEN 'instrument_unknown' END AS reason FROM folded) f USING (reason) GROUP BY 1"""),
    "settlement_merge": _q("SELECT transaction_id, CAST(amount_paise AS BIGINT) AS amount_paise, gateway_status, timestamp_utc, merchant_id, reconciliation_status, bank_ref_id, instrument_type, currency FROM merged"),
    "status_counts": _q("""SELECT 'table' AS scope, reconciliation_status AS status, count(*) AS n FROM merged GROUP BY 2
      UNION ALL SELECT 'batch', reconciliation_status, count(*) FROM merged WHERE transaction_id IN (SELECT transaction_id FROM folded) GROUP BY 2
      UNION ALL SELECT 'duplicates', 'EXCEPTION_DUPLICATE_WEBHOOK', CAST(coalesce(sum(duplicate_mutation_count), 0) AS BIGINT) FROM merged"""),
    "batch_counters": _q("""SELECT (SELECT count(*) FROM settlements) AS total_rows, (SELECT count(*) FROM once) AS distinct_rows, count(*) AS deduped_rows, count(settled_amount_paise) AS evaluated,
      (SELECT count(*) FROM settlements) - (SELECT count(*) FROM once) AS duplicate_rows, count(*) FILTER (WHERE instalments > 1) AS partial_transactions, count(*) FILTER (WHERE currency IS NULL) AS currency_missing FROM folded"""),
    "match_rate": _q(f"""SELECT m AS matched, e AS evaluated, w AS within_lag, CASE WHEN e - w > 0 THEN CAST(m AS DOUBLE) / (e - w) END AS rate FROM (SELECT
      (SELECT count(*) FROM swept WHERE st = 'MATCHED' AND transaction_id IN (SELECT transaction_id FROM folded)) AS m, (SELECT count(settled_amount_paise) FROM folded) AS e,
      (SELECT count(*) FROM swept t JOIN folded s USING (transaction_id) WHERE t.st = 'EXCEPTION_MISSING_WEBHOOK' AND datediff('day', t.day, try_strptime(s.settlement_date, '%Y-%m-%d')::DATE) BETWEEN 0 AND CASE s.provider WHEN 'cashfree' THEN 1 WHEN 'payu' THEN 3 ELSE 2 END) AS w)"""),
    "late_sweep": _q("SELECT st AS reconciliation_status, count(*) AS n FROM swept GROUP BY 1"),
    "missing_within_lag": _q("SELECT t.transaction_id, s.provider, s.settlement_date FROM merged t JOIN folded s USING (transaction_id) WHERE t.reconciliation_status = 'EXCEPTION_MISSING_WEBHOOK' AND datediff('day', t.day, try_strptime(s.settlement_date, '%Y-%m-%d')::DATE) BETWEEN 0 AND CASE s.provider WHEN 'cashfree' THEN 1 WHEN 'payu' THEN 3 ELSE 2 END"),
    "depth_gauges": _q("SELECT 'dlq_depth' AS gauge, (SELECT count(*) FROM letters) AS n UNION ALL SELECT 'late_unresolved_total', (SELECT count(*) FROM swept WHERE st = 'EXCEPTION_LATE_UNRESOLVED')"),
    "provider_batches": _q("SELECT DISTINCT provider, coalesce(provider, 'gateway') || ':' || settlement_date AS batch_id FROM settlements"),
    "mismatch_spread": _q("""SELECT coalesce(l[n // 2 + 1], 0) AS p50, coalesce(l[greatest(n * 9 // 10, 1)], 0) AS p90, coalesce(l[n], 0) AS largest FROM (
      SELECT list_sort(list(g)) AS l, count(*) AS n FROM (SELECT CAST(abs(t_net - settled_amount_paise) AS BIGINT) AS g FROM decided WHERE tid IS NOT NULL AND t_amount IS NOT NULL) WHERE g > 1)"""),
    "bank_missing": _q("SELECT * FROM missing_ev"),
    "bank_orphans": _q("SELECT * FROM orphan_ev"),
    "bank_demote": _q("SELECT CASE WHEN reconciliation_status = 'MATCHED' AND transaction_id IN (SELECT transaction_id FROM missing_ev) THEN 'EXCEPTION_MISSING_BANK_STATEMENT' ELSE reconciliation_status END AS reconciliation_status, count(*) AS n FROM merged GROUP BY 1"),
    "bank_counters": _q("""SELECT 'evidence' AS counter, count(*) AS n FROM merged WHERE reconciliation_status = 'MATCHED' AND transaction_id NOT IN (SELECT transaction_id FROM missing_ev)
      UNION ALL SELECT 'missing', count(*) FROM merged WHERE reconciliation_status = 'MATCHED' AND transaction_id IN (SELECT transaction_id FROM missing_ev) UNION ALL SELECT 'orphans', count(*) FROM orphan_ev"""),
    "residual_score": _q(f", {_SCORED} SELECT transaction_id, round(score, 9) AS score FROM scored").replace(") ,", "),", 1),
    "residual_demote": _q(f", {_SCORED} SELECT CASE WHEN transaction_id IN (SELECT transaction_id FROM scored WHERE score >= 0.9) THEN 'EXCEPTION_FEE_MISMATCH' ELSE reconciliation_status END AS reconciliation_status, count(*) AS n FROM merged GROUP BY 1"),
    "dlq_split": _q("SELECT kind, count(*) AS n FROM judged GROUP BY 1"),
    "reversal_split": _q("SELECT transaction_id, amount_paise, 'EXCEPTION_REVERSAL' AS status FROM judged WHERE kind = 'reversal'"),
    "ingest_upsert": _q("SELECT transaction_id, CAST(amount_paise AS BIGINT) AS amount_paise, gateway_status, timestamp_utc, processing_run_id, reconciliation_status, currency, CAST(duplicate_mutation_count AS BIGINT) AS duplicate_mutation_count FROM upserted"),
    "duplicate_mutation": _q("SELECT reconciliation_status, CAST(sum(duplicate_mutation_count) AS BIGINT) AS duplicates FROM upserted GROUP BY 1"),
    "dlq_content_hash": _q("SELECT payload_hash, transaction_id, amount_paise FROM letters"),
    "dlq_replayable": _q("SELECT count(*) FILTER (WHERE replayable) AS replayable, count(*) FILTER (WHERE replayable AND transaction_id IN (SELECT transaction_id FROM webhooks)) AS already, count(*) FILTER (WHERE stranded) AS stranded FROM letters"),
    "dlq_replay": _q("""SELECT reconciliation_status, processing_run_id, count(*) AS n FROM (SELECT reconciliation_status, processing_run_id FROM webhooks
      UNION ALL SELECT 'PENDING_RECONCILIATION', 'run_2' FROM (SELECT DISTINCT transaction_id FROM letters WHERE replayable AND transaction_id NOT IN (SELECT transaction_id FROM webhooks))) GROUP BY 1, 2"""),
    "dlq_purge": _q("SELECT payload_hash FROM letters WHERE transaction_id IS NULL OR transaction_id NOT IN (SELECT transaction_id FROM letters WHERE replayable)"),
    "ingest_gauges": _q(f"SELECT count(*) AS rows, count(*) FILTER (WHERE came < TIMESTAMP '{NOW}' - INTERVAL 1 DAY) AS late, CAST(0 AS BIGINT) AS unreadable_time, CAST(0 AS BIGINT) AS pan, count(*) FILTER (WHERE kind = 'reversal') AS reversals, count(*) FILTER (WHERE kind = 'rejected') AS rejected FROM judged"),
    "schema_ids": _q("SELECT DISTINCT '1' AS schema_id FROM arrivals WHERE decodable"),
    "q_dlq_depth": _q("SELECT count(*) AS dlq_rows FROM letters"),
    "validation_violations": _q(" UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS n FROM canon WHERE {c} HAVING count(*) > 0" for r, c in _RULES.items())),
    "quarantine_split": _q("""SELECT part, n FROM (SELECT count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS quarantined FROM (SELECT
      settled_amount_paise > 0 AND settlement_date <> 'not-a-date' AND instrument_type <> 'CRYPTO' AND coalesce(currency = 'INR', true) AS ok FROM settlements)) UNPIVOT (n FOR part IN (valid, quarantined))"""),
    "calendar_mask": _q("""SELECT settlement_id, day FROM (SELECT settlement_id, substr(settlement_date, 1, 8) || lpad(CAST(length(settlement_id) * 7 % 40 AS VARCHAR), 2, '0') AS day FROM settlements)
      WHERE regexp_full_match(day, '\\d{4}-\\d{2}-\\d{2}') AND try_strptime(day, '%Y-%m-%d') IS NULL"""),
    "instrument_alias": _q(f"SELECT raw, {_alias('raw')} AS instrument, count(*) AS orders FROM (SELECT {_pick(SPELLINGS, _h('spell') + ' % ' + str(len(SPELLINGS)))} AS raw FROM base) GROUP BY 1, 2"),
    "inr_to_paise": _q("SELECT CAST(k AS VARCHAR) AS order_id, CAST(paise AS BIGINT) AS paise FROM canon"),
    "iso_date": _q("SELECT CAST(k AS VARCHAR) AS order_id, day FROM canon"),
    "provider_lag": _q("SELECT provider, CAST(CASE provider WHEN 'cashfree' THEN 1 WHEN 'payu' THEN 3 ELSE 2 END AS INTEGER) AS lag, count(*) AS n FROM settlements GROUP BY 1, 2"),
    "fault_bucket": _q(f"SELECT CAST({_h('fault')} AS INTEGER) AS bucket, count(*) AS n FROM base GROUP BY 1"),
    "ledger_seed": _q("SELECT 'PENDING_RECONCILIATION' AS reconciliation_status, count(*) AS n, CAST(sum(gross) AS BIGINT) AS paise FROM base"),
    "branch_publish": _q("SELECT 'before' AS seen, reconciliation_status, count(*) AS n FROM webhooks GROUP BY 2 UNION ALL SELECT 'after', reconciliation_status, count(*) FROM merged GROUP BY 2"),
    "mart_versions": _q("SELECT reconciliation_status AS status, day, count(*) AS n, CAST(sum(CASE WHEN reconciliation_status = 'MATCHED' THEN amount_paise END) AS BIGINT) AS matched_paise FROM merged GROUP BY 1, 2"),
    "click_windows": """WITH c AS (SELECT *, coalesce(month(arrived_at), 13) AS lot FROM clicks WHERE ts IS NOT NULL),
      lots AS (SELECT lot, max(max(ts)) OVER (ORDER BY lot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM c GROUP BY lot),
      judged AS (SELECT c.*, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR > date_trunc('milliseconds', seen) - INTERVAL 1 HOUR, true) AS taken FROM c JOIN lots USING (lot))
      SELECT CAST(ts AS DATE) AS day, kind, count(*) AS n, count(DISTINCT date_trunc('hour', ts)) AS hours, max(value) AS most FROM judged WHERE taken GROUP BY 1, 2
      UNION ALL SELECT NULL, 'too late', count(*) FILTER (WHERE NOT taken), 0, NULL FROM judged""",
    "click_sessions": """WITH c AS (SELECT client_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY client_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM clicks WHERE ts IS NOT NULL),
      s AS (SELECT client_id, sum(new) OVER (PARTITION BY client_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM c),
      g AS (SELECT client_id, k, count(*) AS n FROM s GROUP BY 1, 2)
      SELECT client_id, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS n, max(n) AS longest FROM g GROUP BY 1""",
    "benchmark_slice": _q("SELECT DISTINCT s.transaction_id, s.settlement_date FROM settlements s JOIN (SELECT transaction_id FROM webhooks ORDER BY 1 LIMIT 500) USING (transaction_id)"),
    "json_decode": "SELECT event_type, count(*) AS n, CAST(sum(CAST(regexp_extract(props, ':\\s*(-?\\d+)', 1) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1",
    "events_windows": "SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "avro_decode": _q("SELECT decodable, CASE WHEN decodable THEN '1' END AS schema_id, CASE WHEN decodable THEN transaction_id END AS transaction_id, CASE WHEN decodable THEN CAST(amount_paise AS BIGINT) END AS amount_paise, CASE WHEN decodable THEN timestamp_utc END AS timestamp_utc, CASE WHEN decodable THEN currency END AS currency FROM arrivals WHERE transaction_id IS NOT NULL"),
    "pan_scan": _q(f"""SELECT unnest(['transaction_id', 'note']) AS "column", unnest([CAST(0 AS BIGINT), (SELECT count(*) FROM (SELECT {_h("pan")} < 5 AS plain, '411111111111' || CAST(k AS VARCHAR) AS d FROM base)
      WHERE plain OR (length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 THEN CAST(d[i] AS INTEGER) ELSE (CAST(d[i] AS INTEGER) * 2) // 10 + (CAST(d[i] AS INTEGER) * 2) % 10 END)) % 10 = 0))]) AS n"""),
    "mt940_roundtrip": _q("SELECT substr(bank_ref_id, 1, 16) AS bank_ref, settled_amount_paise AS amount_paise, settlement_date AS value_date, 'CREDIT' AS direction, substr(transaction_id, 4) AS link_tx FROM folded WHERE settled_amount_paise > 0 AND settlement_date <> 'not-a-date'"),
    "stream_ingest": _q("SELECT CASE WHEN kind = 'reversal' THEN 'EXCEPTION_REVERSAL' ELSE 'PENDING_RECONCILIATION' END AS reconciliation_status, count(*) AS n FROM judged WHERE kind <> 'rejected' GROUP BY 1"),
    "mart": _q("SELECT transaction_id, CAST(amount_paise AS BIGINT) AS amount_paise, merchant_id, instrument_type, gateway_status, reconciliation_status AS status, bank_ref_id, CASE WHEN timestamp_utc = 'not-a-timestamp' OR timestamp_utc = 'not-a-date' THEN NULL ELSE CAST(replace(replace(timestamp_utc, 'T', ' '), 'Z', '') AS TIMESTAMP) END AS transacted_at, CASE WHEN reconciliation_status = 'MATCHED' THEN CAST(amount_paise AS BIGINT) END AS matched_amount_paise FROM merged"),
    "q_kpi_match_rate": _q(f"SELECT {_PCT.format(part=_MATCHED, whole='count(*)')} AS match_rate_pct FROM merged"),
    "q_kpi_volume_rupees": _q(f"SELECT {_RUPEES} AS volume_rupees FROM merged"),
    "q_kpi_at_risk_rupees": _q(f"SELECT {_RUPEES} AS at_risk_rupees FROM merged WHERE reconciliation_status <> 'MATCHED'"),
    "q_match_rate": _q(f"SELECT status, n, {_PCT.format(part='n', whole='CAST(sum(n) OVER () AS BIGINT)')} AS pct FROM (SELECT reconciliation_status AS status, count(*) AS n FROM merged GROUP BY 1)"),
    "q_daily_match_rate": _q(f"SELECT day, total, matched, {_PCT.format(part='matched', whole='total')} AS match_rate_pct FROM (SELECT day, count(*) AS total, {_MATCHED} AS matched FROM merged GROUP BY 1)"),
    "q_daily_trend": _q("SELECT day, reconciliation_status AS status, count(*) AS n FROM merged GROUP BY 1, 2"),
    "q_volume_by_instrument": _q(f"SELECT instrument_type, count(*) AS n, {_RUPEES} AS volume_rupees FROM merged WHERE instrument_type IS NOT NULL GROUP BY 1"),
    "q_mismatch_by_instrument": _q(f"SELECT instrument_type, count(*) AS mismatches, {_RUPEES} AS rupees_at_risk FROM merged WHERE reconciliation_status = 'EXCEPTION_FEE_MISMATCH' AND instrument_type IS NOT NULL GROUP BY 1"),
    "q_exceptions_by_merchant": _q(f"SELECT merchant_id, count(*) AS mismatches, {_RUPEES} AS rupees_at_risk FROM merged WHERE reconciliation_status = 'EXCEPTION_FEE_MISMATCH' GROUP BY 1"),
    "q_top_mismatches": _q("SELECT transaction_id, merchant_id, instrument_type, CAST(amount_paise AS DOUBLE) / 100.0 AS amount_rupees, bank_ref_id FROM merged WHERE reconciliation_status = 'EXCEPTION_FEE_MISMATCH' ORDER BY amount_paise DESC NULLS LAST, transaction_id LIMIT 10"),
} | {f"normalize_{p}": _q(_canon(p)) for p in ("razorpay", "cashfree", "payu", "generic")}
