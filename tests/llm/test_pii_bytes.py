"""Texts whose bytes are no UTF-8 are read, not refused."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import pii


def test_bytes_that_are_no_text(spark):
    raw = [bytearray(b"\xff a@b.cd 1.2.3.4"), bytearray(b"plain +1 234 567 8901 \xc3"), None]
    docs = spark.createDataFrame(list(enumerate(raw)), "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))
    assert pii.passages(docs)
    params = {k: np.zeros_like(v) for k, v in pii.Tagger().p.items()}
    got = {r.doc_id: [(x.k, x.s, x.e) for x in r.base] for r in pii.find(docs, params).collect()}
    assert got == {0: [(0, 2, 8), (1, 9, 16)], 1: [(3, 6, 21)], 2: []}
