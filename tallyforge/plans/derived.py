"""Three ledgers derived from the orders table, the same in Spark and in DuckDB.

Every attribute of an order comes from stable buckets (SHA-256 of a tag and the key), so that the faults
of a real batch occur at known rates: instalments, redeliveries, orphans, wrong nets, foreign
currencies, unreadable dates and times, reversals, loose and linked bank statements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.rates import RateBook
from ..functions.text import ALIASES, bucket
from ..operators.dlq import PAYLOAD

SHIFT_DAYS = 10_400  # moves the orders' dates to 2023 to 2030
AS_OF, LATE_DAYS, LAG_DAYS, NOW = "2027-01-01", 7, 2, "2027-01-01 00:00:00"
INSTRUMENTS = [*S.INSTRUMENTS, "CRYPTO"]


def h(tag: str) -> Column:
    return bucket(f"7|{tag}", F.col("k"))


def with_buckets(rows: DataFrame, *tags: str) -> DataFrame:
    """rows with the bucket of each tag in a column of its own (h_tag): a hash that several conditions ask for is formed once a row."""
    return rows.withColumns({f"h_{t}": h(t) for t in tags})


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    m = F.col("c") % 10
    merchant = F.when(m == 0, "merch_001").when(m == 1, "merch_demo").when(m != 2, F.concat(F.lit("m_"), (F.col("c") % 50).cast("string")))
    return (
        o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.round(F.col("o_totalprice") * 100).cast("long").alias("gross"), F.col("o_orderdate").cast("timestamp").alias("od"))
        .withColumn("transaction_id", F.concat(F.lit("tx_"), F.lpad(F.col("k").cast("string"), 12, "0")))
        .withColumn("merchant_id", merchant)
    )


def webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gateway's ledger before a batch."""
    rev, st, dup = (F.col(f"h_{t}") for t in ("rev", "st", "dup"))
    amount = F.when(h("null") >= 1, F.when(rev < 2, -F.col("gross")).otherwise(F.col("gross")))
    stamp = F.date_format(F.col("od") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    status = F.when(rev < 2, S.REVERSAL).when(st < 3, S.MATCHED).when(st < 4, S.MISSING_BANK_STATEMENT).when(st < 6, S.LATE_UNRESOLVED).when(st < 8, S.MISSING_WEBHOOK).otherwise(S.PENDING)
    cols = {
        "amount_paise": amount, "gateway_status": F.when(rev < 2, "REFUND").otherwise("CAPTURED"), "timestamp_utc": F.when(h("ts") < 1, "not-a-timestamp").otherwise(stamp),
        "processing_run_id": F.lit("run_1"), "reconciliation_status": status, "currency": F.when(h("wcur") >= 5, "INR"), "duplicate_mutation_count": F.when(dup < 3, dup.cast("long")).otherwise(F.lit(0)),
    }
    kept = with_buckets(base(spark, sf_dir), "fault").where(~F.col("h_fault").between(7, 11))
    rows = with_buckets(kept, "rev", "st", "dup").withColumns(cols)
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).cast(f.dataType).alias(f.name) for f in S.LEDGER.fields))


def settlements(spark: SparkSession, sf_dir: str, book: RateBook | None = None) -> DataFrame:
    """The providers' rows, with redeliveries and instalments."""
    book = book or RateBook.load()
    day = F.date_format(F.date_add(F.col("od").cast("date"), h("lag") % 5 + SHIFT_DAYS), "yyyy-MM-dd")
    o = with_buckets(base(spark, sf_dir), "cur").withColumns({
        "settlement_date": F.when(h("sd") < 1, "not-a-date").otherwise(day),
        "instrument_type": F.element_at(F.array(*(F.lit(i) for i in INSTRUMENTS)), h("inst") % 7 + 1),
        "fault": h("fault"), "provider": F.element_at(F.array(F.lit("razorpay"), F.lit("cashfree"), F.lit("payu"), F.lit(None).cast("string")), h("prov") % 4 + 1),
        "currency": F.when(F.col("h_cur") < 2, "USD").when(F.col("h_cur") >= 5, "INR"),
    })
    o = book.with_net(o, "gross", "instrument_type", "merchant_id", "settlement_date")
    off = F.when(F.col("fault") < 5, 50 + F.col("fault")).when(F.col("fault") == 5, 1).when(F.col("fault") == 6, -1).otherwise(0)
    o = o.withColumn("net", F.col("rate_net") + off)
    half = F.call_function("div", F.col("net"), F.lit(2).cast("long"))
    part = lambda amount, ref, sid: F.struct(amount.alias("a"), F.lit(ref).alias("r"), F.lit(sid).alias("s"))
    parts = (
        F.when(F.col("fault").between(12, 13), F.array(part(F.col("net"), "", "_1"), part(F.col("net"), "", "_2")))
        .when(F.col("fault").between(14, 15), F.array(part(half, "a", "a"), part(F.col("net") - half, "b", "b")))
        .otherwise(F.array(part(F.col("net"), "", "")))
    )
    rows = o.withColumn("x", F.explode(parts))
    cols = {
        "bank_ref_id": F.concat(F.lit("br_"), F.col("k").cast("string"), F.col("x.r")), "settled_amount_paise": F.col("x.a"), "fee_paise": F.col("rate_fee"), "gst_paise": F.col("rate_fee_gst"),
        "settlement_id": F.concat(F.lit("s_"), F.col("k").cast("string"), F.col("x.s")), "gross_amount_paise": F.col("gross"), "utr": F.concat(F.lit("br_"), F.col("k").cast("string"), F.col("x.r")),
    }
    rows = rows.withColumns(cols)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in S.SETTLEMENT.fields))


def statements(spark: SparkSession, sf_dir: str, settled: DataFrame | None = None) -> DataFrame:
    """Bank statement lines with their ids: most settlements have one, many are linked, some are off in date, amount or sign."""
    rows = (settlements(spark, sf_dir) if settled is None else settled).groupBy("transaction_id").agg(F.max("settlement_date").alias("d"), F.sum(F.when(~F.col("settlement_id").endswith("_2"), F.col("settled_amount_paise"))).alias("a"))
    rows = rows.withColumn("k", F.substring("transaction_id", 4, 12).cast("long")).where(h("bs") < 90)
    amount = (F.col("a") + h("bamt") % 3 - 1) * F.when(h("bneg") < 2, -1).otherwise(1)
    day = F.date_format(F.date_add(F.try_to_date("d", "yyyy-MM-dd"), h("bdate") % 5), "yyyy-MM-dd")
    return rows.select(
        F.col("k").alias("statement_id"), F.concat(F.lit("st_"), F.col("k").cast("string")).alias("bank_ref"), amount.cast("long").alias("amount_paise"), day.alias("value_date"),
        F.when(amount >= 0, "CREDIT").otherwise("DEBIT").alias("direction"), F.when(h("blink") < 60, F.col("transaction_id")).alias("link_tx"), F.lit("").alias("narration"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch of events: new, repeated, undecodable, reversed and broken ones."""
    o = base(spark, sf_dir)
    cols = {
        "decodable": h("dec") >= 3, "schema_id": F.lit("1"),
        "amount_paise": F.when(h("aamt") < 4, -F.col("gross")).when(h("aamt") < 5, F.lit(0).cast("long")).otherwise(F.col("gross") + 1),
        "gateway_status": F.when(h("aamt") < 2, " refund ").when(h("aamt") < 3, "CAPTURED").when(h("aamt") < 5, F.lit(None).cast("string")).otherwise("CAPTURED"),
        "timestamp_utc": F.date_format(F.col("od") + F.expr(f"INTERVAL {SHIFT_DAYS + 1} DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "processing_run_id": F.lit("run_2"), "currency": F.lit("INR"),
        "transaction_id": F.when(h("noid") >= 2, F.col("transaction_id")),
    }
    return o.withColumns(cols).select("decodable", "schema_id", *(f.name for f in S.EVENT.fields))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import dlq

    return dlq.dead_letters(arrivals(spark, sf_dir).where(~dlq.accepted()).select(*PAYLOAD))


def provider_file(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """A provider's raw file (all text) with spellings of its own."""
    o = base(spark, sf_dir)
    day = F.date_add(F.col("od").cast("date"), SHIFT_DAYS)
    date_text = F.when(h("df") < 30, F.date_format(day, "dd/MM/yyyy")).when(h("df") < 50, F.date_format(day, "d-M-yyyy")).when(h("df") < 70, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00Z"))).when(h("df") < 72, F.lit("junk")).when(h("df") < 74, F.lit("")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    money = F.concat(F.when(h("mf") < 20, F.lit("₹")).otherwise(F.lit("")), F.call_function("div", F.col("gross"), F.lit(100).cast("long")).cast("string"), F.lit("."), F.lpad((F.col("gross") % 100).cast("string"), 2, "0"), F.when(h("mf").between(20, 39), F.lit("5")).otherwise(F.lit("")))
    method = F.element_at(F.array(*(F.lit(x) for x in METHODS)), h("meth") % len(METHODS) + 1)
    cur = F.element_at(F.array(F.lit(" inr "), F.lit("INR"), F.lit("NA"), F.lit("")), h("cur") % 4 + 1)
    merchant = F.when(h("mer") < 10, F.lit("")).otherwise(F.concat(F.lit(" m_"), F.col("c").cast("string"), F.lit(" ")))
    key, ref = F.col("k").cast("string"), F.concat(F.lit("utr_"), F.col("k").cast("string"))
    shape = {
        "razorpay": {"Payment Id": F.concat(F.lit("pay_"), key), "Settlement Id": F.concat(F.lit("setl_"), key), "Settlement UTR": ref, "Amount": money, "Fee": F.lit("1.005"), "Tax": F.lit("0.18"), "Settlement Amount": money, "Settlement Date": date_text, "Payment Method": method, "Currency": cur},
        "cashfree": {"payment_id": F.concat(F.lit("pay_"), key), "order_id": key, "settlement_id": F.concat(F.lit("setl_"), key), "utr": ref, "amount": money, "fee": F.lit("2.675"), "tax": F.lit("0.18"), "settlement_amount": money, "settlement_date": date_text, "payment_method": method, "merchant_id": merchant, "currency": cur},
        "payu": {"mihpayid": key, "settlement_id": F.concat(F.lit("setl_"), key), "amount": money, "surcharge": F.lit("-0.125"), "tax": F.lit("0.18"), "settlement_amount": money, "payment_mode": method, "settlement_date": date_text, "currency": cur},
        "generic": {"transaction_id": F.concat(F.lit("pay_"), key), "bank_ref_id": ref, "settled_amount_paise": F.col("gross").cast("string"), "settlement_date": date_text, "instrument_type": method, "merchant_id": merchant, "currency": cur, "fee_paise": F.lit("-1"), "provider": F.lit("acme")},
    }[provider]
    return o.select(*(c.alias(n) for n, c in shape.items()))


#: Payment methods as providers spell them.
METHODS = ["upi", "Card - Visa Credit", "Debit Card", "net banking", "PayLater", "international_card", "barter", " ", "NB"]
#: All spellings of instruments that the queries try.
SPELLINGS = [*ALIASES, *METHODS, "cash", "Net-Banking", "my upi app", "emi-card"]
