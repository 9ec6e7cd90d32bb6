"""The passes of the language model over all words: one forward for training and scores, rows summed and stepped in bulk."""

import numpy as np

from tallyforge.llm import lm


def test_training_and_scores_share_a_forward_without_dividing_attention():
    r = np.random.default_rng(3)
    net = lm.Attention(70_000, 7)
    x, y, _ = net._laid([(r.integers(0, 70_000, 90), r.integers(-1, 7, 91)), (r.integers(0, 70_000, 3), np.array([1, -1, -1, 0]))])
    shown, classes, owner = net.windows([(x[x >= lm.FIRST][:90] - lm.FIRST, y[lm.SEEN - lm.STEP :][:91])])
    want, lead = net._outputs(shown)[0], lm.SEEN - lm.STEP
    for i in range(len(shown)):
        at = lead + i * lm.STEP + np.arange(5)[None]
        *_, a, inv, h, t = net._forward(x, np.array([i]), at, net._forms())
        assert np.allclose(t, want[i, :5], atol=1e-5)
        assert np.allclose(a.reshape(5, -1).sum(1) * inv[:, 0], 1, atol=1e-5)


def test_rows_are_summed_whatever_their_number():
    r = np.random.default_rng(4)
    for top in (9, 1 << 16, 200_000):  # sorted in 16 bits where they fit
        x, dx = r.integers(0, top, (40, 3)), r.standard_normal((40, 3, 8)).astype(np.float32)
        x[0, 0] = top - 1
        want = np.zeros((top, 8), np.float32)
        np.add.at(want, x, dx)
        at, got = lm._rows(x, dx)
        assert at.tolist() == sorted(set(x.ravel().tolist())) and np.allclose(got, want[at], atol=1e-5)
    assert [len(z) for z in lm._rows(np.zeros((0, 3), np.int64), np.zeros((0, 3, 8), np.float32))] == [0, 0]


def test_large_logits_lose_nothing():
    z = np.array([[300, 0, -300], [-500, -400, -450], [1, 2, 3]], np.float32)
    y, plain = np.array([0, 1, 2]), z.astype(np.float64)
    got, g = lm._softmax_loss(z.copy(), y)
    want = plain[np.arange(3), y] - np.logaddexp.reduce(plain, 1)
    assert np.allclose(got, want, atol=1e-5) and np.isfinite(g).all() and np.allclose(g.sum(1), 0, atol=1e-5)


def test_sparse_steps_equal_dense_ones():
    r = np.random.default_rng(5)
    p = {"e": r.standard_normal((6, 4)).astype(np.float32)}
    q = {"e": p["e"].copy()}
    sparse, dense = lm._Adam(p, 0.01), lm._Adam(q, 0.01)
    for _ in range(3):
        g = r.standard_normal((6, 4)).astype(np.float32)
        sparse({"e": (np.arange(6), g)})
        dense({"e": g})
    assert np.array_equal(p["e"], q["e"]) and sparse.past["e"].shape == (6, 2, 4)
