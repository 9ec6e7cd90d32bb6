"""The answer key: payments and settlements with labels worked out by hand, and the legs after the merge."""

import pytest
from pyspark.sql import functions as F

from tallyforge import schemas as S
from tallyforge.functions.rates import Providers, RateBook
from tallyforge.operators import bank, fold, merge, reconcile, residual

M, FEE, NOHOOK, CUR = S.MATCHED, S.FEE_MISMATCH, S.MISSING_WEBHOOK, S.CURRENCY_MISMATCH
DAY = "2025-06-11"
# id, gateway amount (None: no amount, "-": no webhook), instrument, merchant, gateway currency, settled parts (amount, date, currency, reference), status
CASES = [
    ("upi", 100000, "UPI", None, "INR", [(100000,)], M), ("cc", 100000, "CREDIT_CARD", None, "INR", [(97640,)], M), ("dc", 100000, "DEBIT_CARD", None, "INR", [(98820,)], M),
    ("nb", 100000, "NETBANKING", None, "INR", [(98230,)], M), ("wal", 100000, "WALLET", None, "INR", [(98230,)], M), ("intl", 100000, "INTERNATIONAL", None, "INR", [(96460,)], M),
    ("merch1", 100000, "CREDIT_CARD", "merch_001", "INR", [(97876,)], M), ("merch2", 100000, "CREDIT_CARD", "merch_demo", "INR", [(97758,)], M),
    ("v1last", 100000, "CREDIT_CARD", None, "INR", [(97640, "2025-03-31")], M), ("v2first", 100000, "CREDIT_CARD", None, "INR", [(97640, "2025-04-01")], M),
    ("v1first", 100000, "UPI", None, "INR", [(100000, "2024-01-01")], M), ("v2mid", 100000, "DEBIT_CARD", None, "INR", [(98820, "2025-04-02")], M),
    ("hi2", 100000, "CREDIT_CARD", None, "INR", [(97642,)], FEE), ("lo3", 100000, "CREDIT_CARD", None, "INR", [(97637,)], FEE),
    ("upifee", 100000, "UPI", None, "INR", [(99000,)], FEE), ("wrongrate", 100000, "CREDIT_CARD", "merch_001", "INR", [(97758,)], FEE),
    ("lo1", 100000, "CREDIT_CARD", None, "INR", [(97639,)], M), ("hi1", 100000, "CREDIT_CARD", None, "INR", [(97641,)], M), ("even", 100000, "CREDIT_CARD", None, "INR", [(97640,)], M),
    ("nohook1", "-", "CREDIT_CARD", None, "INR", [(97640,)], NOHOOK), ("nohook2", "-", "UPI", None, "INR", [(100000,)], NOHOOK), ("noamount", None, "CREDIT_CARD", None, "INR", [(97640,)], FEE),
    ("zero", 1000, "UPI", None, "INR", [(0,)], FEE), ("dust", 25, "CREDIT_CARD", None, "INR", [(24,)], M), ("tiny", 1, "UPI", None, "INR", [(1,)], M),
    ("cursame", 100000, "CREDIT_CARD", None, "INR", [(97640, DAY, "INR")], M), ("curdiff", 100000, "CREDIT_CARD", None, "INR", [(97640, DAY, "USD")], CUR), ("curnull", 100000, "CREDIT_CARD", None, None, [(97640, DAY, "INR")], M),
    ("newmerch", 100000, "CREDIT_CARD", "m_new", "INR", [(97640,)], M), ("nomerch", 100000, "CREDIT_CARD", None, "INR", [(97640,)], M), ("crypto", 100000, "CRYPTO", None, "INR", [(98230,)], M),
    ("early", 100000, "CREDIT_CARD", None, "INR", [(97640, "2010-01-01")], M), ("nodate", 100000, "CREDIT_CARD", None, "INR", [(97640, "not-a-date")], M),
    ("two", 1000, "UPI", None, "INR", [(400, DAY, "INR", "a"), (600, "2025-06-12", "INR", "b")], M),
    ("three", 1000, "UPI", None, "INR", [(250, DAY, "INR", "a"), (250, DAY, "INR", "b"), (500, "2025-06-12", "INR", "c")], M),
    ("short", 1000, "UPI", None, "INR", [(400, DAY, "INR", "a"), (598, "2025-06-12", "INR", "b")], FEE),
    ("twice", 100000, "CREDIT_CARD", None, "INR", [(97640, DAY, "INR", "a"), (97640, DAY, "INR", "a")], M),
    ("soon", 100000, "CREDIT_CARD", None, "INR", [(97640, "2025-06-04")], M), ("later", 100000, "CREDIT_CARD", None, None, [(97640, "2025-07-15", None)], M),
    ("frac", 10001, "CREDIT_CARD", None, "INR", [(9765,)], M), ("refund", -2500, "CREDIT_CARD", "merch_001", "INR", [], S.REVERSAL),
]


@pytest.fixture(scope="module")
def tables(spark):
    hooks, parts = [], []
    for i, amount, inst, merch, cur, settled, _ in CASES:
        if amount != "-":
            back = amount is not None and amount <= 0
            hooks.append({"transaction_id": i, "amount_paise": amount, "gateway_status": "REFUND" if back else "CAPTURED", "timestamp_utc": "2025-06-10T09:00:00Z", "merchant_id": merch, "reconciliation_status": S.REVERSAL if back else S.PENDING, "currency": cur, "duplicate_mutation_count": 0})
        for n, p in enumerate(settled):
            amount_, day, c, ref = (*p, *(None, DAY, "INR", "r")[len(p):])
            parts.append({"transaction_id": i, "settled_amount_paise": amount_, "settlement_date": day, "instrument_type": inst, "merchant_id": merch, "currency": c, "bank_ref_id": f"{ref}_{i}", "settlement_id": f"s{n}_{i}"})
    row = lambda schema, d: tuple(d.get(f.name) for f in schema.fields)
    return spark.createDataFrame([row(S.LEDGER, h) for h in hooks], S.LEDGER), spark.createDataFrame([row(S.SETTLEMENT, p) for p in parts], S.SETTLEMENT)


def test_answer_key(tables):
    assert len(CASES) == 41
    hooks, parts = tables
    after = reconcile.settlement_merge(hooks, fold.fold(parts), RateBook.load())
    got = {r["transaction_id"]: r["reconciliation_status"] for r in after.collect()}
    assert got == {c[0]: c[6] for c in CASES}


def test_decision_agrees_with_merge(tables):
    hooks, parts = tables
    got = {r["transaction_id"]: r["status"] for r in reconcile.decide(reconcile.merge_source(fold.fold(parts)), hooks, RateBook.load()).collect()}
    assert got == {c[0]: c[6] for c in CASES if c[5]}


def test_merge_twice_is_merge_once(tables):
    hooks, parts = tables
    book, folded = RateBook.load(), fold.fold(parts)
    once = reconcile.settlement_merge(hooks, folded, book)
    twice = reconcile.settlement_merge(once, folded, book)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_counters(tables):
    _, parts = tables
    c = reconcile.batch_counters(parts).first().asDict()
    assert c == {"total_rows": 45, "distinct_rows": 44, "deduped_rows": 40, "evaluated": 40, "duplicate_rows": 1, "partial_transactions": 3, "currency_missing": 1}
    census = {r["reason"]: r["n"] for r in reconcile.fallback_census(fold.fold(parts), RateBook.load()).collect()}
    assert census == {"card_unparseable_date": 1, "card_out_of_range": 1, "merchant_unknown": 1, "instrument_unknown": 1}


def test_late_sweep_and_lag(spark, tables):
    hooks, parts = tables
    after = reconcile.settlement_merge(hooks, fold.fold(parts), RateBook.load())
    fresh = reconcile.missing_within_lag(after, fold.fold(parts), Providers.load())
    assert {r["transaction_id"] for r in fresh.collect()} == {"nohook1", "nohook2"}
    swept = {r["transaction_id"]: r["reconciliation_status"] for r in reconcile.late_sweep(after, "2025-07-01").collect()}
    assert swept["nohook1"] == S.LATE_UNRESOLVED and swept["cc"] == M


def test_merge_rejects_two_rows_of_a_key(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(merge.CardinalityError):
        merge.merge(t, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), "k", [], None, check=True)


def test_merge_arms_and_delete(spark):
    t = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 4)], "k string, v int")
    s = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30), ("e", 50)], "k string, v int")
    arms = [merge.Arm(F.col("t.v") == 1, delete=True), merge.Arm(F.col("t.v") > 1, {"v": F.col("s.v")})]
    got = {r["k"]: r["v"] for r in merge.merge(t, s, "k", arms, {"k": F.col("s.k"), "v": F.col("s.v")}).collect()}
    assert got == {"b": None, "c": 30, "d": 4, "e": 50}  # a null condition takes no arm


def test_gates():
    with pytest.raises(reconcile.GateError):
        reconcile.check_slo(94996 / 100000)
    reconcile.check_slo(None)
    reconcile.check_drift({M: 3, S.DUPLICATE_SETTLEMENT: 9}, 3)
    with pytest.raises(reconcile.GateError):
        reconcile.check_drift({M: 3}, 4)
    assert reconcile.match_rate(5, 5, 5) is None and reconcile.fold_residual({M: 3}, 1) == {M: 2, FEE: 1}


def test_bank_evidence_labels(spark):
    s = spark.createDataFrame([(i, a, DAY, 1) for i, a in (("same", 97640), ("late", 96460), ("back", 50000), ("debit", 70000))], "transaction_id string, settled_amount_paise long, settlement_date string, tolerance int")
    b = spark.createDataFrame([(1, 97640, DAY, None), (2, 96460, "2025-06-14", None), (3, -50000, DAY, "back"), (4, -70000, DAY, None), (5, 97640, DAY, "elsewhere")], "statement_id long, amount_paise long, value_date string, link_tx string")
    assert {r[0] for r in bank.missing(s, b, 2).collect()} == {"late", "debit"}
    assert {r[0] for r in bank.orphans(b, s, 2).collect()} == {2, 4, 5}
    counters = {r["counter"]: r["n"] for r in bank.leg_counters(s.withColumn("reconciliation_status", F.lit(S.MATCHED)), bank.missing(s, b, 2), bank.orphans(b, s, 2)).collect()}
    assert counters == {"evidence": 2, "missing": 2, "orphans": 3}


def test_bank_evidence_of_a_million_equal_prices(spark):
    """One hot price and one hot link: no pair rows, no task with the hot key, right answers beside it."""
    n = 1_000_000
    s = spark.range(n).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.when(F.col("id") < n - 3, 9900).otherwise(F.col("id")).cast("long").alias("settled_amount_paise"), F.lit(DAY).alias("settlement_date"), F.lit(1).alias("tolerance"))
    b = spark.range(n).select(F.col("id").alias("statement_id"), F.when(F.col("id") < n - 2, 9901).otherwise(F.col("id") + 1).cast("long").alias("amount_paise"), F.lit(DAY).alias("value_date"), F.when(F.col("id") % 3 == 0, F.lit("t5")).alias("link_tx"))
    b = b.unionByName(spark.createDataFrame([(n, 1, None, None), (n + 1, None, DAY, None), (n + 2, 5, DAY, "nobody")], "statement_id long, amount_paise long, value_date string, link_tx string"))
    flagged = bank.with_evidence(s, b, 2)
    assert {r[0] for r in flagged.where("NOT evidence").collect()} == {f"t{n - 3}"} and flagged.count() == n
    used = bank.with_use(b, s, 2)
    assert sorted(r[0] for r in used.where("NOT used").collect()) == [n, n + 1, n + 2]
    plan = flagged._jdf.queryExecution().executedPlan()
    assert "Cartesian" not in plan.toString()


def test_bank_evidence_equals_every_pair(spark):
    """Random books against all pairs in plain Python."""
    import random
    from datetime import date, timedelta

    r = random.Random(4)
    day = lambda: None if r.random() < 0.05 else (date(2025, 6, 1) + timedelta(r.randrange(8))).isoformat()
    s = [(f"t{i}", r.choice([None, r.randrange(-500, 500)]) if r.random() < 0.1 else r.randrange(-500, 500), day(), r.choice([0, 1, 7, 100])) for i in range(150)]
    b = [(i, r.randrange(-600, 600), day(), r.choice([None, None, f"t{r.randrange(170)}"])) for i in range(150)]
    near = lambda x, y: x[1] is not None and x[2] and y[2] and y[3] is None and abs(x[1] - y[1]) <= x[3] and abs((date.fromisoformat(x[2]) - date.fromisoformat(y[2])).days) <= 2
    links = lambda x, y: y[3] == x[0]
    sd = spark.createDataFrame(s, "transaction_id string, settled_amount_paise long, settlement_date string, tolerance int")
    bd = spark.createDataFrame(b, "statement_id long, amount_paise long, value_date string, link_tx string")
    assert {x[0] for x in bank.missing(sd, bd, 2).collect()} == {x[0] for x in s if not any(near(x, y) or links(x, y) for y in b)}
    assert {x[0] for x in bank.orphans(bd, sd, 2).collect()} == {y[0] for y in b if not any(near(x, y) or links(x, y) for x in s)}


def test_bank_join_has_no_nested_loop(spark, sf):
    from tallyforge.plans import registry

    for query in (registry.bank_missing, registry.bank_orphans):
        joins = [line for line in query(spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in line or "Cartesian" in line]
        assert not any("Cartesian" in j for j in joins)
        # the one nested loop has a side of one row: the number of all rows
        assert all("BuildRight, Inner" in j or "BuildLeft, Inner" in j for j in joins if "NestedLoop" in j)
        assert any("LeftSemi" in j for j in joins)  # the near ones are looked up, not paired


def test_residual_scores():
    book = RateBook.load()
    assert residual.score_scalar(book, 100000, 97876, "CREDIT_CARD", "merch_001", DAY) > 0.9  # a negotiated match
    assert residual.score_scalar(book, 100000, 97640, "CREDIT_CARD", "merch_001", DAY) == 0.95
    assert residual.score_scalar(book, 100000, 97640, "CREDIT_CARD", None, DAY) < 0.1
