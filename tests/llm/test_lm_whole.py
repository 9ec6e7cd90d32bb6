"""The language model learns from every training text and every known word."""

import zlib
from collections import Counter

import numpy as np

from tallyforge.llm import common, lm, queries


def test_every_training_text_and_word_trains(spark, sf, monkeypatch):
    docs = common.table(spark, sf, "documents").select("doc_id", "text").limit(60)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    train = Counter()
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            train.update(lm.tokens((r.text or "").encode()))
    top = sorted((w for w in train if w != lm.END), key=lambda w: (-train[w], w))[: lm.TOP]
    seen, averaged = [], lm.averaged
    monkeypatch.setattr(lm, "averaged", lambda changes: seen.append(sum(r.n for r in changes.collect())) or averaged(changes))
    assert lm.score(docs, queries.default_tokenizer()).count() == docs.count()
    assert seen == [sum(train.values()), len(train) - 1 - len(top)]


def test_gradients_by_parts_equal_those_of_windows():
    r = np.random.default_rng(1)
    net = lm.Attention(50, 7)
    sequence = (r.integers(0, 50, 90), r.integers(-1, 7, 91))
    x, y, _ = net._laid([sequence])
    lead = lm.SEEN - lm.STEP
    asks = np.nonzero(y >= 0)[0]
    window = (asks - lead) // lm.STEP
    loss, got = net.parts_gradients(x, y, [(np.array([w]), asks[window == w][None]) for w in np.unique(window)])
    shown, classes, _ = net.windows([sequence])
    want_loss, want = net.gradients(shown, classes)
    assert abs(loss - want_loss) < 1e-5
    for k, g in want.items():
        if k == "e":
            g, h = (np.zeros_like(net.p["e"]) for _ in range(2))
            g[want[k][0]], h[got[k][0]] = want[k][1], got[k][1]
            assert np.allclose(g, h, atol=1e-6)
        else:
            assert np.allclose(g, got[k], atol=1e-6), k


def test_long_words_train_whole():
    r = np.random.default_rng(2)
    speller = lm.Speller(r.integers(0, 9, 1400).astype(float), 5)
    sizes = np.array([3, 1, 15, 16, 17, 45, 3])
    ids, cls = r.integers(0, 1400, sizes.sum()), r.integers(0, 5, len(sizes))
    starts = np.cumsum(sizes) - sizes
    before = speller.words(ids, starts, sizes, cls)
    adam = lm._Adam(speller.p, 0.01)
    for i in range(20):
        assert speller.learn(ids, starts, sizes, cls, adam, i) == len(sizes)
    assert (speller.words(ids, starts, sizes, cls) > before).all()
