"""Money, rates, dates, provider text, validation and adapters."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.functions import dates, money, text
from tallyforge.functions.rates import Providers, RateBook, RateError
from tallyforge.operators import adapters, validate

BOOK = RateBook.load()


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def test_fee_grid_equals_scalar(spark):
    r = random.Random(1)
    rows = [(a, i, m, d) for a in (0, 1, 25, 999, 100000, 100001, 12345789) for i in ("UPI", "CREDIT_CARD", "INTERNATIONAL", "CRYPTO", None) for m in (None, "", "UNKNOWN", "merch_001", "merch_demo", "other") for d in (None, "", "junk", "2024/01/01", "2024-01-01", "2025-04-01", "2026-06-15", "2010-01-01")]
    rows = r.sample(rows, 400)
    df = BOOK.with_net(spark.createDataFrame(rows, "a long, i string, m string, d string"), "a", "i", "m", "d")
    for x in df.collect():
        fee, gst, net = BOOK.fee(x.a, x.i, x.m, x.d)
        assert (x.rate_fee, x.rate_fee_gst, x.rate_net) == (fee, gst, net), x
        assert x.rate_tol == BOOK.rate(x.i, x.m, x.d).tolerance


@given(st.integers(-(10**12), 10**12), st.integers(0, 10_000))
@settings(max_examples=200, deadline=None)
def test_rounding_is_symmetric_and_close(amount, bps):
    got = money.bps_amount_scalar(amount, bps)
    assert got == -money.bps_amount_scalar(-amount, bps)
    assert abs(got * 10_000 - amount * bps) <= 5_000


def test_negative_amounts_round_alike(spark):
    df = spark.createDataFrame([(a, b) for a in (-25, -100001, 25, 3) for b in (0, 200, 1800)], "a long, b int").select("a", "b", money.bps_amount(F.col("a"), F.col("b")).alias("x"))
    assert all(r.x == money.bps_amount_scalar(r.a, r.b) for r in df.collect())


def test_card_choice():
    assert [BOOK.card(d).version for d in (None, "junk", "2010-01-01", "2024-01-01", "2025-03-31", "2025-04-01", "2030-01-01")] == ["v2.0.0", "v2.0.0", "v1.0.0", "v1.0.0", "v1.0.0", "v2.0.0", "v2.0.0"]
    assert BOOK.rate("CREDIT_CARD", "merch_001", "2024-05-01").mdr_bps == 180  # general merchants apply to every card


@pytest.mark.parametrize(
    "change",
    [
        {"default": {"mdr_rate_bps": 1.5, "gst_on_mdr": 18}}, {"default": {"mdr_rate_bps": 10_001, "gst_on_mdr": 18}}, {"default": {"mdr_rate_bps": 1, "gst_on_mdr": 101}},
        {"default": {"mdr_rate_bps": 1, "gst_on_mdr": 18, "tolerance_paise": 101}}, {"instruments": {"CASH": {"mdr_rate_bps": 1}}}, {"history": [{"version": "a", "effective_from": "soon"}]},
        {"history": [{"version": "a", "effective_from": "2024-01-01"}, {"version": "b", "effective_from": "2025-01-01"}]},
        {"history": [{"version": "a", "effective_from": "2024-01-01", "effective_to": "2025-02-01"}, {"version": "b", "effective_from": "2025-01-01"}]},
    ],
)
def test_bad_rate_files(change):
    with pytest.raises(RateError):
        RateBook({"default": {"mdr_rate_bps": 150, "gst_on_mdr": 18.0}} | change)


def test_many_merchants_keep_expressions_small(spark):
    many = {"default": {"mdr_rate_bps": 150, "gst_on_mdr": 18.0}, "merchants": {f"m{i}": {"UPI": {"mdr_rate_bps": i % 300}} for i in range(3000)}}
    df = RateBook(many).with_net(spark.createDataFrame([(100000, "UPI", "m250", "2025-01-01")], "a long, i string, m string, d string"), "a", "i", "m", "d")
    assert df.first()["rate_fee"] == 2500


@pytest.mark.parametrize(("raw", "paise"), [("₹1,234.56", 123456), ("2.675", 268), ("1.005", 101), ("-100.505", -10051), ("", None), ("junk", None), (None, None), (" 5 ", 500)])
def test_minor_units(spark, raw, paise):
    assert one(spark, money.minor_units, raw) == paise


@pytest.mark.parametrize(("raw", "day"), [("2025-04-01", "2025-04-01"), ("02/04/2025", "2025-04-02"), ("2-4-2025", "2025-04-02"), ("2025-04-01T10:00:00Z", "2025-04-01"), ("31/02/2025", "2025-02-31"), ("junk", None), ("", None), (None, None)])
def test_iso_text(spark, raw, day):
    assert one(spark, dates.iso_text, raw) == day


@pytest.mark.parametrize(("raw", "ok"), [("2026-06-10T09:00:00Z", True), ("2026-06-10 09:00:00.123", True), ("2026-06-10", True), ("not-a-timestamp", False), ("", False), ("2026-13-45T99:99:99", False), (None, False)])
def test_event_time(spark, raw, ok):
    assert (one(spark, dates.event_time, raw) is not None) == ok


@pytest.mark.parametrize(("raw", "name"), [("card - visa credit", "CREDIT_CARD"), ("UPI", "UPI"), ("netbanking", "NETBANKING"), ("Net Banking", "UNKNOWN"), ("international_card", "INTERNATIONAL"), ("barter", "UNKNOWN"), (None, "UNKNOWN"), (" ", "UNKNOWN")])
def test_instrument(spark, raw, name):
    assert one(spark, text.instrument, raw) == name


@pytest.mark.parametrize(("raw", "n"), [("4111111111111111", 1), ("pay 4111 1111-1111 1111 now", 1), ("411111111114", 0), ("4111111111111112", 0), (None, 0), ("4111111111111111 and 5500005555555559", 2)])
def test_pans(spark, raw, n):
    assert len(one(spark, text.pans, raw)) == n


def test_providers():
    p = Providers.load()
    assert p.spec("cashfree")["lag_days"] == 1 and p.spec("other")["lag_days"] == 2 and p.spec("upi_npci")["late_sla_days"] == 3


def test_adapter_detection():
    assert adapters.detect(["Payment Id", "Settlement Id", "Settlement UTR"]).name == "razorpay"
    assert adapters.detect(["payment_id", "settlement_id", "settlement_amount"]).name == "cashfree"
    assert adapters.detect(["mihpayid"]).name == "payu" and adapters.detect(["x"]).name == "generic" and adapters.detect(["x"], "PayU").name == "payu"


def test_razorpay_row(spark):
    raw = spark.createDataFrame([("pay_1", "setl_1", None, "100.00", "2.00", "0.36", "97.64", "02/04/2025", "card - visa credit")], "`Payment Id` string, `Settlement Id` string, `Settlement UTR` string, `Amount` string, `Fee` string, `Tax` string, `Settlement Amount` string, `Settlement Date` string, `Payment Method` string")
    r = adapters.normalise(raw).first()
    assert (r.settled_amount_paise, r.fee_paise, r.gst_paise, r.settlement_date, r.instrument_type, r.merchant_id, r.currency, r.bank_ref_id, r.provider) == (9764, 200, 36, "2025-04-02", "CREDIT_CARD", "UNKNOWN", None, None, "razorpay")


def test_validation(spark):
    base = {"transaction_id": "tx_1", "settled_amount_paise": 5, "bank_ref_id": "b", "settlement_date": "2024-02-29", "instrument_type": "UPI", "fee_paise": None, "gst_paise": None, "gross_amount_paise": None, "currency": None}
    cases = [({}, []), ({"settled_amount_paise": -1}, ["settled_amount_paise"]), ({"bank_ref_id": None}, ["bank_ref_id"]), ({"settlement_date": "2024-02-30"}, ["calendar"]), ({"settlement_date": "x"}, ["settlement_date"]), ({"currency": "USD"}, ["currency"]), ({"transaction_id": "a!", "instrument_type": "UNKNOWN"}, ["transaction_id", "instrument_type"]), ({"fee_paise": -1}, ["fee_paise"])]
    schema = "transaction_id string, settled_amount_paise long, bank_ref_id string, settlement_date string, instrument_type string, fee_paise long, gst_paise long, gross_amount_paise long, currency string"
    df = spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], schema)
    assert [r[0] for r in df.select(validate.violations()).collect()] == [v for _, v in cases]
    assert validate.quarantine_rate(df) == (8, 7)
    with pytest.raises(validate.ValidationError):
        validate.check_quarantine(8, 1)
    with pytest.raises(validate.ValidationError):
        validate.check_volume(10, 100)
    assert validate.check_volume(10, None) and not validate.check_volume(10, 100, strict=False)
