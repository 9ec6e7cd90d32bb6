"""The bank leg derives its inputs once, and its look-up tells heavy keys that hold from those that do not."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import skew
from tallyforge.plans import derived, registry

SF = "/root/testdata/sf0.001"


def test_settlements_are_derived_once(spark, monkeypatch):
    calls, plain = [], derived.settlements
    monkeypatch.setattr(derived, "settlements", lambda *a, **k: calls.append(1) or plain(*a, **k))
    registry.bank_counters(spark, SF)
    assert len(calls) == 1


def test_flag_rows_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY", 4)
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a"] * 9 + ["b"] * 8 + ["c", "d", None])], "id long, k string")
    got = skew.flag_rows(rows, ["k"], lambda p: p.where(F.col("k").isin("a", "c")), "hit", "id").collect()
    assert len(got) == 20 and all(r.hit == (r.k in ("a", "c")) for r in got)
