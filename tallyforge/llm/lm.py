"""Language-model scoring: corpus-wide word counts, and causal self-attention over subword ids.

Counts: texts are dealt into blocks; each block sends its distinct words with their counts, packed, to
hash buckets, where totals over all training texts and each word's subwords are formed once, and gets
those of its own words back in the order sent. No row per word occurrence is shuffled, and a frequent
word is one entry a block.

Model, over the subword ids of a text: a causal attention layer reads the subwords before a word and
gives the probability of the word's class. Each of the TOP most frequent words of the corpus is a class of
its own, as is the end; other words fall into CLUSTERS classes by the texts that their subwords occur in.
Inside a class a word has its discounted share of the corpus counts, and the mass that discounting frees
is spelled: a second causal attention layer, started by the class, gives the word's subwords one by one
from all subwords of the tokenizer (an adaptive softmax, ordered by corpus counts) and then a stop. The
probabilities of all words, known or not, sum to at most 1.

Training: class vectors and a first fit use a bounded sample of passages (parameters below). From there every
block trains the attention layer on each word of all its training texts, and the task of a bucket trains the
speller on each distinct training word of it; their changes are averaged by what each has learned from.
Overlapping windows give each word its context and score each word once.

Defined cases: null text counts as empty and has the end token alone; repeated rows count and score
once each; with no training text every count is 0; extra columns are dropped.
"""

from __future__ import annotations

import copy
import pickle
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import blocks_for, bucketed, checkpointed, hash_sample, slices, small_batches, text_bytes

#: Widths of the attention layer and of the speller, subwords scored and seen by a window, subwords that the speller sees.
WIDTH, LETTERS, STEP, SEEN, SPELLED = 16, 32, 32, 64, 16
#: Words with a class of their own, and classes of all others. Class 0 is the end.
TOP, CLUSTERS, PROJECTED = 95, 32, 24
#: Entries of the speller's first softmax, and of each of its tail groups.
HEAD, TAIL = 128, 768
#: The bounded sample of the first fit: documents, passages of each, characters of a passage; distinct words that the speller learns from.
SAMPLE_DOCS, PASSAGES, PASSAGE_CHARS, SAMPLE_WORDS = 800, 4, 1500, 60_000
#: Steps of the first fits and their batches.
STEPS, SPELL_STEPS, BATCH, SPELL_BATCH = 300, 1500, 64, 256
#: The pass over all training texts: rates of the attention layer and the speller, words of one part and parts of a step, subwords that the speller takes a step.
RATE, SPELL_RATE, PART, PARTS, SPELL_PART = 0.004, 0.001, 512, 2, 8192
#: Subwords of words that are spelled beside each other (their logits fit a core's cache).
SPELL_SCORED = 4096
PAD, BOS, FIRST = 0, 1, 2
#: Rows that a bucket of words returns: its sums, its subwords' words, its most frequent words, words to learn from, and all words with who asked.
NUMBERS, SUBWORDS, MOST, LEARN, ALL = range(5)
#: The end token as a word: no real word holds a space.
END = b" "


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between the six white-space bytes, then the end token."""
    words = text.lower().split()
    words.append(END)
    return words


class _Index(dict):
    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self)
        return n


class Words:
    """The distinct words of a block, numbered as they come, and their order by bucket and bytes."""

    def __init__(self):
        self.index = _Index()

    def ids(self, text: bytes) -> np.ndarray:
        t = tokens(text)
        return np.fromiter(map(self.index.__getitem__, t), np.int64, len(t))

    def dealt(self, n_buckets: int) -> list[tuple[int, list[bytes], np.ndarray]]:
        """(bucket, its words in order, their numbers): the same for the same words in any order of coming."""
        words = list(self.index)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        return [(int(b), [words[i] for i in order[edges[b] : edges[b + 1]].tolist()], order[edges[b] : edges[b + 1]]) for b in np.nonzero(np.diff(edges))[0]]


def _pieces(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ids that begin at start and have the given sizes, in a row."""
    upto = np.concatenate([[0], np.cumsum(size)])
    return ids.take(np.repeat(start - upto[:-1], size) + np.arange(upto[-1]), mode="clip")


# take() with "clip" and a row's sum as a product are several times faster than indexing and sum(); all indices are in range.


def _take(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table.take(at, 0, mode="clip")


def _sums(z: np.ndarray) -> np.ndarray:
    """The sums of the last axis."""
    return (z.reshape(-1, z.shape[-1]) @ np.ones(z.shape[-1], z.dtype)).reshape(z.shape[:-1])


def _exp(z: np.ndarray, most: float) -> None:
    """exp of min(z, most), in place."""
    if z.size and z.max() > most:
        np.minimum(z, np.float32(most), out=z)
    np.exp(z, out=z)


# ---------------------------------------------------------------- one causal attention layer


def _layer(r: np.random.Generator, length: int, d: int) -> dict[str, np.ndarray]:
    g = lambda *s: (r.standard_normal(s) * 0.1).astype(np.float32)
    return {"near": np.zeros(length, np.float32), "q": g(d, d), "k": g(d, d), "v": g(d, d), "o": g(d, d)}


def _distance(first: int, length: int) -> np.ndarray:
    """How far position j lies before position first + i; negative: after it."""
    return np.arange(first, length)[:, None] - np.arange(length)[None, :]


def _bias(near: np.ndarray, first: int, length: int) -> np.ndarray:
    """What is added to attention scores: the learned bias of a distance, and the causal mask."""
    far = _distance(first, length)
    return np.where(far >= 0, near[np.maximum(far, 0)], np.float32(-1e4))


def _attend(p: dict[str, np.ndarray], x: np.ndarray, first: int, blind: np.ndarray | None = None):
    """Outputs (n, length - first, width) at positions first... of embedded inputs x (n, length, width), and what backward needs.

    A position sees itself and those before it; sequences in `blind` do not see positions below first.
    """
    d = x.shape[2]
    last = np.ascontiguousarray(x[:, first:])
    proj = lambda z, w: (z.reshape(-1, d) @ w).reshape(z.shape)
    q, k, v = proj(last, p["q"] * np.float32(1 / np.sqrt(d))), proj(x, p["k"]), proj(x, p["v"])
    s = np.matmul(q, k.transpose(0, 2, 1))
    s += _bias(p["near"], first, x.shape[1])
    if blind is not None and first:
        s[blind, :, :first] = -1e4
    _exp(s, 60)
    s /= _sums(s)[:, :, None] + np.float32(1e-20)
    h = np.matmul(s, v)
    t = np.tanh(last + proj(h, p["o"]))
    return t, (x, last, q, k, v, s, h, t, first)


def _attend_back(p: dict[str, np.ndarray], memo, dt: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The gradient of the inputs, and of the layer's parameters, from that of the outputs."""
    x, last, q, k, v, a, h, t, first = memo
    d = x.shape[2]
    scale = np.float32(1 / np.sqrt(d))
    dt = dt * (1 - t * t)
    flat = lambda z: z.reshape(-1, d)
    g = {"o": flat(h).T @ flat(dt)}
    dh = (flat(dt) @ p["o"].T).reshape(dt.shape)
    da, dv = np.matmul(dh, v.transpose(0, 2, 1)), np.matmul(a.transpose(0, 2, 1), dh)
    ds = da
    ds -= _sums(dh * h)[:, :, None]
    ds *= a
    far = _distance(first, x.shape[1])
    g["near"] = np.bincount(far[far >= 0], ds.sum(0)[far >= 0], len(p["near"])).astype(np.float32)
    dq, dk = np.matmul(ds, k) * scale, np.matmul(ds.transpose(0, 2, 1), q)
    g |= {"q": flat(last).T @ flat(dq), "k": flat(x).T @ flat(dk), "v": flat(x).T @ flat(dv)}
    dx = flat(dk) @ p["k"].T
    dx += flat(dv) @ p["v"].T
    dx = dx.reshape(x.shape)
    dx[:, first:] += (flat(dq) @ p["q"].T + flat(dt)).reshape(dt.shape)
    return dx, g


def _rows(x: np.ndarray, dx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a table that x took, and the sums of their gradients."""
    at = x.ravel()
    order = np.argsort(at.astype(np.uint16) if at.max(initial=0) < 1 << 16 else at, kind="stable")  # 16 bits are sorted by radix
    at = _take(at, order)
    start = np.concatenate([[0], np.nonzero(at[1:] != at[:-1])[0] + 1]) if len(at) else at
    # pairs of numbers as complex ones: half as many sums to start
    return at[start], np.add.reduceat(_take(dx.reshape(-1, dx.shape[-1]), order).view(np.complex64), start, 0).view(np.float32)


class _Adam:
    """Adam over a dict of parameters; a gradient may be (rows, their gradients)."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.step = p, rate, 0
        self.past = {k: np.zeros((len(x), 2, *x.shape[1:]), x.dtype) for k, x in p.items()}  # both means of a row lie together

    def __call__(self, grads: dict) -> None:
        self.step += 1
        a, b = 1 - 0.9**self.step, 1 - 0.99**self.step
        for k, g in grads.items():
            at, g = g if isinstance(g, tuple) else (None, g)
            past = self.past[k] if at is None else _take(self.past[k], at)
            m, v = past[:, 0], past[:, 1]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            v *= np.float32(0.99)
            v += np.float32(0.01) * g * g
            change = v * np.float32(1 / b)
            np.sqrt(change, out=change)
            change += np.float32(1e-7)
            np.divide(m, change, out=change)
            change *= np.float32(self.rate / a)
            if at is None:
                self.p[k] -= change
            else:
                self.past[k][at] = past
                self.p[k][at] = _take(self.p[k], at) - change


def _softmax_loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of y, and the gradient of their negative sum, for logits z (changed in place)."""
    if z.size and max(z.max(), -z.min()) > 60:
        z -= z.max(1, keepdims=True)
    rows = np.arange(len(z))
    mine = z[rows, y]
    np.exp(z, out=z)
    total = _sums(z)
    z *= (1 / total)[:, None]
    z[rows, y] -= 1
    return mine - np.log(total), z


# ---------------------------------------------------------------- the class of the next word


class Attention:
    """One layer of causal self-attention over the subword ids of a text; gives the class of each next word."""

    def __init__(self, n_ids: int, n_classes: int, seed: int = 5):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) * 0.1).astype(np.float32)
        self.p = {"e": g(FIRST + n_ids, WIDTH), "u": g(WIDTH, n_classes), "b": np.zeros(n_classes, np.float32)} | _layer(r, SEEN, WIDTH)

    @staticmethod
    def _laid(sequences: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts in a row, each led by padding and a multiple of STEP long: inputs, classes (-1: none), texts by window.

        A sequence is (subword ids, classes of the words that begin after the start and after each id). Window i shows
        inputs i * STEP to i * STEP + SEEN and scores the last STEP of them.
        """
        count = -(-np.array([len(s) + 1 for s, _ in sequences], np.int64) // STEP)
        lead = SEEN - STEP
        base = np.concatenate([[0], np.cumsum(lead + count * STEP)])
        x, y = np.full(base[-1], PAD, np.int32), np.full(base[-1], -1, np.int32)
        for (s, c), at in zip(sequences, base + lead):
            x[at] = BOS
            x[at + 1 : at + 1 + len(s)] = s + FIRST
            y[at : at + len(c)] = c
        return x, y, np.repeat(np.arange(len(sequences)), count + lead // STEP)

    @classmethod
    def windows(cls, sequences: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs (n, SEEN), classes after each of the last STEP inputs, and the text of each window."""
        x, y, owner = cls._laid(sequences)
        at = np.arange(max(0, len(owner) - (SEEN - STEP) // STEP))
        at = at[owner[at] == owner[at + (SEEN - STEP) // STEP]] if len(at) else at  # a window lies in one text
        first = at[:, None] * STEP
        return x[first + np.arange(SEEN)], y[first + np.arange(SEEN - STEP, SEEN)], owner[at]

    def _outputs(self, x: np.ndarray):
        lead = SEEN - STEP
        return _attend(self.p, self.p["e"][x], lead, np.nonzero(x[:, lead - 1] == PAD)[0])

    def classes(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Class logits after the given positions (row numbers of n * STEP)."""
        return self._outputs(x)[0].reshape(-1, WIDTH)[rows] @ self.p["u"] + self.p["b"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss and gradients for classes y (n, STEP); -1 counts as nothing."""
        t, memo = self._outputs(x)
        flat, rows = t.reshape(-1, WIDTH), np.nonzero(y.ravel() >= 0)[0]
        got, dz = _softmax_loss(flat[rows] @ self.p["u"] + self.p["b"], y.ravel()[rows])
        dz /= max(1, len(rows))
        dt = np.zeros_like(flat)
        dt[rows] = dz @ self.p["u"].T
        dx, g = _attend_back(self.p, memo, dt.reshape(t.shape))
        return float(-got.mean()), g | {"u": flat[rows].T @ dz, "b": dz.sum(0), "e": _rows(x, dx)}

    def fit(self, sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, rate: float = 0.01, seed: int = 5) -> int:
        """Adam on windows of the sequences, `steps` batches drawn; how many windows there are."""
        x, y, _ = self.windows(sequences)
        some = (y >= 0).any(1)
        x, y, r, adam = x[some], y[some], np.random.default_rng(seed), _Adam(self.p, rate)
        if not len(x):
            return 0
        for i in range(steps):
            at = r.integers(0, len(x), BATCH)
            adam.rate = rate * (1 - 0.9 * i / steps)
            adam(self.gradients(x[at], y[at])[1])
        return len(x)

    def learn(self, sequences: list[tuple[np.ndarray, np.ndarray]], adam: _Adam, seed: int = 5) -> int:
        """One pass of Adam over every class of the sequences; how many there are.

        A step takes parts of windows; those of a part have equally many classes, so that nothing is filled up.
        """
        x, y, _ = self._laid(sequences)
        lead, r, parts = SEEN - STEP, np.random.default_rng(seed), []
        asks = np.nonzero(y >= 0)[0]
        window, start, many = np.unique((asks - lead) // STEP, return_index=True, return_counts=True)
        for n in np.unique(many):
            group = r.permutation(np.nonzero(many == n)[0])
            each = max(1, PART // int(n))
            parts += [(window[w], asks[start[w][:, None] + np.arange(n)]) for w in (group[i : i + each] for i in range(0, len(group), each))]
        order, rate = r.permutation(len(parts)), adam.rate
        for i in range(0, len(order), PARTS):
            some = [parts[j] for j in order[i : i + PARTS]]
            adam.rate = rate * min(1, sum(at.size for _, at in some) / (PART * PARTS))  # a small batch is no whole step
            adam(self.parts_gradients(x, y, some)[1])
        adam.rate = rate
        return len(asks)

    def parts_gradients(self, x: np.ndarray, y: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[float, dict]:
        """Mean loss and gradients for the classes at the asking positions of windows (window numbers, positions (n, asks)).

        The same function as gradients(), from products of matrices: a score is e_i (q k) e_j, an output e_i + sum a_j e_j (v o).
        """
        p, d, lead, n_all = self.p, WIDTH, SEEN - STEP, sum(at.size for _, at in parts)
        forms = mix, out, bias = self._forms()
        g, around = {k: np.zeros_like(p[k]) for k in ("u", "b")}, np.zeros_like(bias)
        dmix, dout, loss, ids, de = np.zeros_like(mix), np.zeros_like(out), 0.0, [], []
        for window, at in parts:
            seen, mine, e, own, q, a, inv, h, t = self._forward(x, window, at, forms)
            z = t @ p["u"]
            z += p["b"]
            if max(z.max(), -z.min()) > 60:
                z -= z.max(1, keepdims=True)
            rows, to = np.arange(len(z)), y.take(at.ravel())
            loss -= z[rows, to].sum() / n_all
            np.exp(z, out=z)
            total = _sums(z)
            loss += np.log(total).sum() / n_all
            z[rows, to] -= total
            share = 1 / (total * np.float32(n_all))  # what makes a row of z a gradient
            g["u"] += (z.T @ (t * share[:, None])).T
            g["b"] += share @ z
            dt = z @ p["u"].T
            dt *= share[:, None]
            dt *= 1 - t * t
            dout += h.T @ dt
            dh = dt @ out.T
            dh *= inv
            ds = np.matmul(dh.reshape(q.shape), e.transpose(0, 2, 1))
            ds -= _sums(dh * h).reshape(*at.shape, 1)
            ds *= a
            place, sums = _rows(at % STEP, ds)
            around[place] += sums
            dq = np.matmul(ds, e).reshape(-1, d)
            dmix += own.T @ dq
            more = np.matmul(a.transpose(0, 2, 1), dh.reshape(q.shape))
            more += np.matmul(ds.transpose(0, 2, 1), q)
            ids += [seen.ravel(), mine]
            de += [more.reshape(-1, d), dt + dq @ mix.T]
        g["near"] = np.bincount(np.maximum(_distance(lead, SEEN), 0).ravel(), around.ravel(), len(p["near"])).astype(np.float32)  # 0 where nothing is seen
        dmix *= np.float32(1 / np.sqrt(d))
        g |= {"q": dmix @ p["k"], "k": dmix.T @ p["q"], "v": dout @ p["o"].T, "o": p["v"].T @ dout}
        return float(loss), g | {"e": _rows(np.concatenate(ids), np.concatenate(de))}

    def _forms(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """q k (scaled), v o, and the bias of distances: all that a pass over asking positions needs beside the embeddings."""
        p = self.p
        return p["q"] @ p["k"].T * np.float32(1 / np.sqrt(WIDTH)), p["v"] @ p["o"], _bias(p["near"], SEEN - STEP, SEEN)

    def _forward(self, x: np.ndarray, window: np.ndarray, at: np.ndarray, forms):
        """Outputs at the asking positions `at` (n, asks) of windows, last, and what backward needs; attention is divided by its sum (1 / inv) in h alone."""
        (mix, out, bias), e, lead = forms, self.p["e"], SEEN - STEP
        seen, mine = x.take(window[:, None] * STEP + np.arange(SEEN), mode="clip"), x.take(at.ravel(), mode="clip")
        e, own = _take(e, seen), _take(e, mine)
        q = (own @ mix).reshape(*at.shape, WIDTH)
        a = np.matmul(q, e.transpose(0, 2, 1))
        a += _take(bias, at % STEP)
        blind = np.nonzero(seen[:, lead - 1] == PAD)[0]
        if len(blind):
            a[blind, :, :lead] = -1e4
        _exp(a, 60)
        inv = 1 / (_sums(a).reshape(-1, 1) + np.float32(1e-20))
        h = np.matmul(a, e).reshape(-1, WIDTH)
        h *= inv
        return seen, mine, e, own, q, a, inv, h, np.tanh(own + h @ out)

    def score(self, sequences: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The summed log-probability (natural) of each sequence's classes.

        Only the positions where a word begins ask; windows in which equally many do go through together.
        """
        p, lead = self.p, SEEN - STEP
        x, y, owner = self._laid(sequences)
        out = np.zeros(len(sequences))
        asks = np.nonzero(y >= 0)[0]
        if not len(asks):
            return out
        forms = self._forms()
        window, start, many = np.unique((asks - lead) // STEP, return_index=True, return_counts=True)
        for n in np.unique(many):
            group = np.nonzero(many == n)[0]
            each = max(1, PART // int(n))
            for lo in range(0, len(group), each):
                w = group[lo : lo + each]
                at = asks[start[w][:, None] + np.arange(n)]
                z = self._forward(x, window[w], at, forms)[-1] @ p["u"]
                z += p["b"]
                if z.max() > 80:
                    np.minimum(z, np.float32(80), out=z)
                mine = z[np.arange(len(z)), y.take(at.ravel())].astype(np.float64)
                np.exp(z, out=z)
                got = mine - np.log(_sums(z) + np.float32(1e-30))
                out += np.bincount(owner[window[w]], weights=got.reshape(-1, n).sum(1), minlength=len(out))
        return out


# ---------------------------------------------------------------- the spelling of a word


class Speller:
    """One layer of causal self-attention inside a word: its class, then its subwords; gives all next subwords and the stop.

    Entry 0 of the first softmax is the stop, then come the most frequent subwords and the tail groups.
    """

    def __init__(self, counts: np.ndarray, n_classes: int, seed: int = 6):
        r, n = np.random.default_rng(seed), len(counts)
        order = np.argsort(-counts, kind="stable")
        self.rank = np.empty(n, np.int32)
        self.rank[order] = np.arange(1, n + 1)  # 0 is the stop
        self.groups = max(0, -(-(n + 1 - HEAD) // TAIL))
        room = HEAD + self.groups * TAIL
        size = np.zeros(room)
        size[1 : n + 1] = counts[order] + 0.5
        size[0] = 0.3 * size.sum()
        g = lambda *s: (r.standard_normal(s) * 0.1).astype(np.float32)
        bias = np.where(size > 0, np.log(np.maximum(size, 1e-30) / size.sum()), -40).astype(np.float32)
        mass = np.log(np.maximum(size[HEAD:].reshape(self.groups, TAIL).sum(1), 0.5) / size.sum()).astype(np.float32)
        self.p = {"e": g(n, LETTERS), "c": g(n_classes, LETTERS), "w": g(room, LETTERS), "b": bias, "gw": g(self.groups, LETTERS), "gb": mass} | _layer(r, SPELLED, LETTERS)

    def _logits(self, t: np.ndarray) -> np.ndarray:
        return t @ np.concatenate([self.p["w"][:HEAD], self.p["gw"]]).T + np.concatenate([self.p["b"][:HEAD], self.p["gb"]])

    def _tails(self, y: np.ndarray):
        """(group, rows of y in it, their places in it) for targets beyond the first softmax."""
        far = np.nonzero(y >= HEAD)[0]
        group = (y[far] - HEAD) // TAIL
        order = np.argsort(group, kind="stable")
        far, group = far[order], group[order]
        for at in np.split(np.arange(len(far)), np.nonzero(np.diff(group))[0] + 1) if len(far) else []:
            yield int(group[at[0]]), far[at], (y[far[at]] - HEAD) % TAIL

    def _entry(self, y: np.ndarray) -> np.ndarray:
        return np.where(y < HEAD, y, HEAD + (y - HEAD) // TAIL)

    def logp(self, t: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of targets y (0 the stop, else 1 + rank) for outputs t."""
        z = self._logits(t)
        if z.size and z.max() > 80:
            np.minimum(z, np.float32(80), out=z)
        out = z[np.arange(len(y)), self._entry(y)].astype(np.float64)
        out -= np.log(_sums(np.exp(z, out=z)) + np.float32(1e-30))
        for g, rows, at in self._tails(y):
            lo = HEAD + g * TAIL
            z = t[rows] @ self.p["w"][lo : lo + TAIL].T + self.p["b"][lo : lo + TAIL]
            z -= z.max(1, keepdims=True)
            mine = z[np.arange(len(rows)), at]
            out[rows] += mine - np.log(_sums(np.exp(z, out=z)))
        return out

    def _inputs(self, ids: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Embedded classes and subwords (n, 1 + length)."""
        return np.concatenate([_take(self.p["c"], cls)[:, None], _take(self.p["e"], ids)], 1)

    def words(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The log-probability (natural) of each word, given its class: runs of ids from starts, of any length."""
        out = np.zeros(len(sizes))
        order = np.argsort(sizes, kind="stable")
        edge = np.searchsorted(sizes[order], np.arange(SPELLED + 1))
        for n in range(1, SPELLED):
            for lo in range(edge[n], edge[n + 1], max(1, SPELL_SCORED // n)):
                at = order[lo : min(edge[n + 1], lo + max(1, SPELL_SCORED // n))]
                s = ids[starts[at][:, None] + np.arange(n)]
                t, _ = _attend(self.p, self._inputs(s, cls[at]), 0)
                y = np.concatenate([self.rank[s], np.zeros((len(at), 1), np.int32)], 1)
                out[at] = self.logp(t.reshape(-1, LETTERS), y.ravel()).reshape(y.shape).sum(1)
        for i in order[edge[SPELLED] :]:  # longer than a window: overlapping ones, each target once
            s = ids[starts[i] : starts[i] + sizes[i]]
            out[i] = self._long(s, int(cls[i]))
        return out

    def _long(self, s: np.ndarray, cls: int) -> float:
        half = SPELLED // 2
        x = np.concatenate([self.p["c"][cls][None], self.p["e"][s]])
        y = np.concatenate([self.rank[s], [0]])
        t, _ = _attend(self.p, x[None, :SPELLED], 0)
        total = self.logp(t[0], y[:SPELLED]).sum()
        lows = np.arange(half, len(y) - half, half)  # windows that score their second half
        for part in np.array_split(lows, -(-len(lows) // 1024)):
            at = np.minimum(part[:, None] + np.arange(SPELLED), len(y) - 1)
            t, _ = _attend(self.p, x[at], half)
            keep = (part[:, None] + np.arange(half, SPELLED) < len(y)).ravel()
            total += self.logp(t.reshape(-1, LETTERS)[keep], y[at[:, half:].ravel()[keep]]).sum()
        return float(total)

    def gradients(self, s: np.ndarray, cls: np.ndarray | None, y: np.ndarray | None = None) -> tuple[float, dict]:
        """Mean loss and gradients for words of one length: subwords s (n, length), classes, targets (by default the subwords and the stop).

        Without classes s are windows from inside words, with targets after their last ones only.
        """
        y = np.concatenate([self.rank[s], np.zeros((len(s), 1), np.int32)], 1) if y is None else y
        t, memo = _attend(self.p, self.p["e"][s] if cls is None else self._inputs(s, cls), 0 if cls is not None else s.shape[1] - y.shape[1])
        flat, y = t.reshape(-1, LETTERS), y.ravel()
        got, dz = _softmax_loss(self._logits(flat), self._entry(y))
        dz /= len(y)
        loss = -got.sum() / len(y)
        dt = dz[:, :HEAD] @ self.p["w"][:HEAD] + dz[:, HEAD:] @ self.p["gw"]
        rows, dw, db = [np.arange(HEAD)], [dz[:, :HEAD].T @ flat], [dz[:, :HEAD].sum(0)]
        for g, mine, at in self._tails(y):
            lo = HEAD + g * TAIL
            more, d = _softmax_loss(flat[mine] @ self.p["w"][lo : lo + TAIL].T + self.p["b"][lo : lo + TAIL], at)
            loss -= more.sum() / len(y)
            d /= len(y)
            dt[mine] += d @ self.p["w"][lo : lo + TAIL]
            rows.append(np.arange(lo, lo + TAIL))
            dw.append(d.T @ flat[mine])
            db.append(d.sum(0))
        dx, g = _attend_back(self.p, memo, dt.reshape(t.shape))
        at = np.concatenate(rows)
        g |= {"w": (at, np.concatenate(dw)), "b": (at, np.concatenate(db)), "gw": dz[:, HEAD:].T @ flat, "gb": dz[:, HEAD:].sum(0)}
        return float(loss), g | ({"e": _rows(s, dx)} if cls is None else {"c": _rows(cls, dx[:, 0]), "e": _rows(s, dx[:, 1:])})

    def fit(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cls: np.ndarray, steps: int = SPELL_STEPS, rate: float = 0.01, seed: int = 6) -> Speller:
        """Adam on batches of words of equal length below SPELLED, drawn; learn() takes the longer ones too."""
        r, adam = np.random.default_rng(seed), _Adam(self.p, rate)
        by = {n: np.nonzero(sizes == n)[0] for n in range(1, SPELLED)}
        by = {n: at for n, at in by.items() if len(at)}
        if not by:
            return self
        lengths, share = list(by), np.array([len(at) * (n + 1) for n, at in by.items()], float)
        for i in range(steps):
            n = lengths[r.choice(len(lengths), p=share / share.sum())]
            at = by[n][r.integers(0, len(by[n]), max(16, 4 * SPELL_BATCH // (n + 1)))]
            adam.rate = rate * (1 - 0.9 * i / steps)
            adam(self.gradients(ids[starts[at][:, None] + np.arange(n)], cls[at])[1])
        return self

    def learn(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cls: np.ndarray, adam: _Adam, seed: int = 6) -> int:
        """One pass of Adam over every word, of any length, in batches of one length; how many words there are."""
        r, parts = np.random.default_rng(seed), []
        batches = lambda at, n: [(n, at[i : i + max(1, SPELL_PART // n)]) for i in range(0, len(at), max(1, SPELL_PART // n))]
        for n in range(1, SPELLED):
            parts += batches(r.permutation(np.nonzero(sizes == n)[0]), n)
        far = np.nonzero(sizes >= SPELLED)[0]
        parts += batches(r.permutation(far), SPELLED)
        half = SPELLED // 2
        # windows inside long words, each with SPELLED subwords and targets after its second half: word, first subword
        lows = [np.append(np.arange(half - 1, sizes[i] - SPELLED, half), sizes[i] - SPELLED) for i in far]
        word, low = np.repeat(far, [len(x) for x in lows]), np.concatenate([np.zeros(0, np.int64), *lows])
        inside = batches(r.permutation(len(low)), SPELLED)
        rate = adam.rate
        for i in r.permutation(len(parts) + len(inside)):
            n, at = parts[i] if i < len(parts) else inside[i - len(parts)]
            adam.rate = rate * min(1, len(at) * n / SPELL_PART)  # a small batch is no whole step
            if i < len(parts):
                s = ids[starts[at][:, None] + np.arange(n)]
                adam(self.gradients(s, cls[at])[1] if n < SPELLED else self.gradients(s[:, :-1], cls[at], self.rank[s])[1])
            else:
                to = low[at][:, None] + np.arange(half + 1, SPELLED + 1)  # the subwords after, or the stop after the last
                after_it = self.rank[ids[starts[word[at]][:, None] + np.minimum(to, sizes[word[at]][:, None] - 1)]]
                adam(self.gradients(ids[(starts[word[at]] + low[at])[:, None] + np.arange(SPELLED)], None, np.where(to < sizes[word[at]][:, None], after_it, 0))[1])
        adam.rate = rate
        return len(sizes)


# ---------------------------------------------------------------- classes, and the whole model


class Classes:
    """The class of a word: 0 the end, 1... the most frequent words, then clusters by what its subwords occur with."""

    def __init__(self, top: list[bytes], n_ids: int):
        self.top = {w: i + 1 for i, w in enumerate(top)}
        self.first = 1 + len(top)
        self.vec = np.zeros((n_ids, PROJECTED), np.float32)
        self.mid = np.zeros((1, PROJECTED + 2), np.float32)
        self.n = self.first + 1

    def learn(self, texts: list[tuple[np.ndarray, np.ndarray]], seed: int = 4) -> Classes:
        """Subword vectors and clusters from (subword ids, sizes of the words) of passages."""
        r = np.random.default_rng(seed)
        n_ids = len(self.vec)
        seen = np.zeros(n_ids)
        project = r.standard_normal((n_ids, PROJECTED)).astype(np.float32)
        for s, _ in texts:
            n = np.bincount(s, minlength=n_ids)
            at = np.nonzero(n)[0]
            d = (np.sqrt(n[at])[:, None] * project[at]).sum(0)
            self.vec[at] += n[at][:, None] * (d / (np.linalg.norm(d) + 1e-9))
            seen += n
        self.vec /= np.maximum(seen, 1)[:, None].astype(np.float32)
        if not texts:
            return self
        ids, sizes = np.concatenate([s for s, _ in texts]), np.concatenate([z for _, z in texts])
        x = self._features(ids, sizes)
        x = x[r.permutation(len(x))[:40_000]]
        if not len(x):
            return self
        mid = x[r.permutation(len(x))[:CLUSTERS]].copy()
        for _ in range(10):
            own = self._nearest(x, mid)
            for c in range(len(mid)):
                if (own == c).any():
                    mid[c] = x[own == c].mean(0)
        self.mid, self.n = mid, self.first + len(mid)
        return self

    def _features(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mean vectors of words (runs of ids), with how long they are and how many subwords say nothing."""
        if not len(sizes):
            return np.zeros((0, PROJECTED + 2), np.float32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = np.add.reduceat(self.vec[ids], starts, 0) / sizes[:, None]
        short = np.add.reduceat((np.abs(self.vec[ids]).sum(1) == 0).astype(np.float32), starts) / sizes
        return np.concatenate([mean, 0.15 * np.log(sizes)[:, None], 0.3 * short[:, None]], 1).astype(np.float32)

    @staticmethod
    def _nearest(x: np.ndarray, mid: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int32)
        for lo in range(0, len(x), 65536):
            out[lo : lo + 65536] = ((mid * mid).sum(1) - 2 * x[lo : lo + 65536] @ mid.T).argmin(1)
        return out

    def of(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Classes of words, given their subwords in a row (the end has none)."""
        own = np.fromiter((0 if w == END else self.top.get(w, -1) for w in words), np.int32, len(words))
        far = own < 0
        own[far] = self.first + self._nearest(self._features(ids[np.repeat(far, sizes)], sizes[far]), self.mid)
        return own


class Model:
    """All parts; masses and types by class come from the whole corpus."""

    def __init__(self, classes: Classes, net: Attention, speller: Speller):
        self.classes, self.net, self.speller = classes, net, speller
        self.mass, self.types, self.discount = np.zeros(classes.n), np.zeros(classes.n), 0.5

    def inside(self, cls: np.ndarray, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """The log-probability (natural) of each distinct word in its class."""
        out = np.zeros(len(cls))
        far = cls >= self.classes.first  # the end and the most frequent words are alone in their classes
        c = cls[far]
        free = spelled[far] + np.log(self.discount * self.types[c] + 1)
        own = np.log(np.maximum(count[far] - self.discount, 1e-300))
        out[far] = np.logaddexp(np.where(count[far] > 0, own, -np.inf), free) - np.log(self.mass[c] + 1)
        return out

    def spelled(self, cls: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The log-probability (natural) that the speller gives each word, whose subwords lie in a row; 0 where nothing is spelled."""
        out, far = np.zeros(len(cls), np.float32), cls >= self.classes.first
        out[far] = self.speller.words(ids, (np.cumsum(sizes) - sizes)[far], sizes[far], cls[far])
        return out


@lru_cache(maxsize=1)
def _model(raw: bytes) -> Model:
    return pickle.loads(raw)


def cut(texts: list[bytes], tok: bpe.PairIndexBPE) -> list[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words of a text, their subword ids in a row, how many each has) for each text; a distinct word is cut once."""
    index = _Index()
    split = [t.lower().split() for t in texts]
    at = [np.fromiter(map(index.__getitem__, w), np.int64, len(w)) for w in split]
    ids, size = tok.merge([b" " + w for w in index])
    starts = np.cumsum(size) - size
    return [(w, _pieces(ids, starts[i], size[i]), size[i]) for w, i in zip(split, at)]


def sequences(texts: list[bytes], tok: bpe.PairIndexBPE, classes: Classes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Texts for the attention layer: subword ids, and the class of the word (or end) after the start and after each id."""
    return [(ids, after(classes.of([*w, END], ids, np.append(size, 0)), np.append(size, 0))) for w, ids, size in cut(texts, tok)]


def after(cls: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Classes of the words (the last is the end, without subwords) at the positions that precede them; -1 inside words."""
    out = np.full(int(sizes.sum()) + 1, -1, np.int32)
    out[np.cumsum(sizes) - sizes] = cls
    return out


def _passages(docs: DataFrame) -> list[str]:
    """Up to PASSAGES passages from anywhere in each of about SAMPLE_DOCS training texts."""
    some = hash_sample(docs.select("doc_id", "text").where(~held_out(F.col("doc_id")) & (F.length("text") > 0)), SAMPLE_DOCS, "doc_id", "text")
    length = F.length("text")
    at = lambda i: F.pmod(F.xxhash64("text", i), F.greatest(length - PASSAGE_CHARS + 1, F.lit(1))).cast("int") + 1
    count = F.least(F.lit(PASSAGES), F.ceil(length / PASSAGE_CHARS)).cast("int")
    rows = some.select(F.explode(F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(F.col("text"), at(i), F.lit(PASSAGE_CHARS)))).alias("t")).collect()
    return sorted(r["t"] for r in rows)


def first_fit(docs: DataFrame, tokenizer: str, top: list[bytes], learn: list[bytes], subwords: np.ndarray) -> Model:
    """Classes, a first fit of the attention layer and the speller: one task, with one thread, so that the driver stays free."""
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast((_passages(docs), top, learn, subwords))  # bounded by the sample's parameters

    def run(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit(tokenizer, *given.value))]}, pa.schema([("model", pa.binary())]))

    got = pickle.loads(spark.range(1, numPartitions=1).mapInArrow(run, "model binary").first()["model"])
    given.destroy()
    return got


def fit(tokenizer: str, passages: list[str], top: list[bytes], learn: list[bytes], subwords: np.ndarray) -> Model:
    """All parts of the model, learned from passages of training texts, the most frequent words, and words to spell."""
    tok = bpe.load(tokenizer)
    texts = [t.encode() for t in passages]
    cuts = cut(texts, tok)
    classes = Classes(top, len(tok.token_bytes)).learn([(ids, sizes) for _, ids, sizes in cuts if len(ids)])
    net = Attention(len(tok.token_bytes), classes.n)
    seqs = [(ids, after(classes.of([*w, END], ids, np.append(z, 0)), np.append(z, 0))) for w, ids, z in cuts]
    for _, c in seqs:
        c[-1] = -1  # a passage's end is none of the text's
    seen = np.bincount(np.concatenate([c[c >= 0] for _, c in seqs] or [np.zeros(0, np.int64)]), minlength=classes.n) + 0.5
    net.p["b"][:] = np.log(seen / seen.sum())
    net.fit(seqs)
    ids, sizes = tok.merge([b" " + w for w in learn])
    cls = classes.of(learn, ids, sizes)
    far = cls >= classes.first
    speller = Speller(subwords, classes.n).fit(ids, (np.cumsum(sizes) - sizes)[far], sizes[far], cls[far])
    return Model(classes, net, speller)


def averaged(changes: DataFrame) -> dict[str, np.ndarray]:
    """The mean of changes of parameters (d, n), weighed by what each was learned from.

    Partial sums are formed by at most 32 tasks, each streaming, so the driver gets 32 sets of changes at most.
    """

    def add(batches):
        total, weight = None, 0
        for b in batches:
            for raw, n in zip(b.column("d").to_pylist(), b.column("n").to_pylist()):
                d = _opened(raw)
                total = {k: (total[k] if total else 0) + x * np.float32(n) for k, x in d.items()}
                weight += n
        if weight:
            yield _change({k: x / np.float32(weight) for k, x in total.items()}, weight)

    total, weight = {}, 0
    for r in changes.repartition(32).mapInArrow(add, "d binary, n long").toLocalIterator():
        for k, x in _opened(r["d"]).items():
            total[k] = total.get(k, 0) + x * np.float32(r["n"])
        weight += r["n"]
    return {k: x / np.float32(weight) for k, x in total.items()}


def spelling_learned(totals: DataFrame, shared) -> DataFrame:
    """The changes (d, n) of the speller that each task learns from all known words of its buckets, bucket after bucket."""

    def learn(batches):
        base, n = _model(shared.value), 0
        speller = copy.copy(base.speller)
        speller.p = {k: x.copy() for k, x in base.speller.p.items()}
        adam = _Adam(speller.p, SPELL_RATE)
        for r in (r for b in batches for r in b.to_pylist()):
            sizes, ids = np.frombuffer(r["sizes"], np.int32).astype(np.int64), np.frombuffer(r["ids"], np.int32)
            cls = base.classes.of(r["words"].split(b"\n"), ids, sizes)
            use = (np.frombuffer(r["totals"], np.int64) > 0) & (cls >= base.classes.first)
            n += speller.learn(ids, (np.cumsum(sizes) - sizes)[use], sizes[use], cls[use], adam, r["bucket"])
        if n:
            yield _change({k: x - base.speller.p[k] for k, x in speller.p.items()}, n)

    return totals.where(F.col("kind") == ALL).select("bucket", "words", "totals", "sizes", "ids").mapInArrow(learn, "d binary, n long")


def _change(d: dict[str, np.ndarray], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"d": [zlib.compress(pickle.dumps({k: x.astype(np.float16) for k, x in d.items()}), 1)], "n": [int(n)]}, pa.schema([("d", pa.binary()), ("n", pa.int64())]))


def _opened(raw: bytes) -> dict[str, np.ndarray]:
    return {k: x.astype(np.float32) for k, x in pickle.loads(zlib.decompress(raw)).items()}


# ---------------------------------------------------------------- over the corpus


def _summed(batches):
    """(id, n) rows of the subword counts of buckets, summed within a task."""
    sums: dict[int, int] = {}
    for b in batches:
        for ids, n in zip(b.column("ids").to_pylist(), b.column("totals").to_pylist()):
            for i, c in zip(np.frombuffer(ids, np.int32).tolist(), np.frombuffer(n, np.int64).tolist()):
                sums[i] = sums.get(i, 0) + c
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())], names=["id", "n"])


def score(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    docs = small_batches(docs).select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    n_blocks = blocks_for(text_bytes(docs))
    # written in buckets: counting, training and scoring read the texts where they lie
    blocks = bucketed(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("out"), F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int").alias("block")), "lm_blocks", n_blocks, "block")
    learn_words = -(-SAMPLE_WORDS // n_blocks)

    sent = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
    told = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("words", "totals", "sizes", "ids", "blocks", "places"))])
    answer = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("totals", "sizes", "ids", "cls", "spelled"))])

    def count(group):
        words, seen = Words(), []
        for text, out in zip(group.column("text").cast(pa.binary()).to_pylist(), group.column("out").to_pylist()):
            ids = words.ids(text or b"")
            if not out:
                seen.append(ids.astype(np.int32))
        n = np.bincount(np.concatenate(seen), minlength=len(words.index)) if seen else np.zeros(len(words.index), np.int64)
        block = group.column("block")[0].as_py()
        return pa.Table.from_pylist([{"bucket": bucket, "block": block, "words": b"\n".join(w), "counts": n[at].astype(np.int64).tobytes()} for bucket, w, at in words.dealt(n_blocks)], sent)

    def total(group):
        tok, rows = bpe.load(tokenizer), group.to_pylist()
        parts = [r["words"].split(b"\n") for r in rows]  # no word holds a line end
        number = _Index()
        at = np.fromiter((number[w] for p in parts for w in p), np.int64, sum(map(len, parts)))
        sums = np.bincount(at, weights=np.frombuffer(b"".join(r["counts"] for r in rows), np.int64)).astype(np.int64)
        words = list(number)
        ids, size = tok.merge([b"" if w == END else b" " + w for w in words])
        real = np.array([w != END for w in words])
        kinds = np.bincount(ids, weights=np.repeat((sums > 0) & real, size), minlength=1).astype(np.int64)
        used = np.nonzero(kinds)[0]
        known = np.nonzero((sums > 0) & real)[0]
        most = known[np.lexsort((known, -sums[known]))[:TOP]]
        learn = known[np.argsort(np.fromiter((xxhash.xxh64_intdigest(words[i], 1) for i in known), np.uint64, len(known)), kind="stable")[:learn_words]]
        out = [
            {"kind": NUMBERS, "totals": np.array([sums.sum(), (sums > 0).sum(), (sums == 1).sum(), (sums == 2).sum()], np.int64).tobytes()},
            {"kind": SUBWORDS, "ids": used.astype(np.int32).tobytes(), "totals": kinds[used].tobytes()},
            {"kind": MOST, "words": b"\n".join(words[i] for i in most), "totals": sums[most].tobytes()},
            {"kind": LEARN, "words": b"\n".join(words[i] for i in learn)},
            {
                "kind": ALL, "bucket": rows[0]["bucket"], "words": b"\n".join(words), "totals": sums.tobytes(), "sizes": size.astype(np.int32).tobytes(), "ids": ids.astype(np.int32).tobytes(),
                "blocks": np.array([[r["block"], len(p)] for r, p in zip(rows, parts)], np.int32).tobytes(), "places": at.astype(np.int32).tobytes(),
            },
        ]
        return pa.Table.from_pylist(out, told)

    def told_blocks(shared, spell: bool) -> DataFrame:
        """What each bucket tells each block of its words; their spelling only for the scores."""

        def answers(batches):
            model = _model(shared.value)
            for r in (r for b in batches for r in b.to_pylist()):
                sums, size, ids = np.frombuffer(r["totals"], np.int64), np.frombuffer(r["sizes"], np.int32).astype(np.int64), np.frombuffer(r["ids"], np.int32)
                cls = model.classes.of(r["words"].split(b"\n"), ids, size)
                spelled, starts = model.spelled(cls, ids, size) if spell else np.zeros(len(cls), np.float32), np.cumsum(size) - size
                places, lo = np.frombuffer(r["places"], np.int32), 0
                for block, n in np.frombuffer(r["blocks"], np.int32).reshape(-1, 2).tolist():
                    mine = places[lo : lo + n]
                    lo += n
                    yield pa.RecordBatch.from_pylist([{
                        "block": block, "bucket": r["bucket"], "totals": sums[mine].tobytes(), "sizes": size[mine].astype(np.int32).tobytes(),
                        "ids": _pieces(ids, starts[mine], size[mine]).tobytes(), "cls": cls[mine].astype(np.int16).tobytes(), "spelled": spelled[mine].tobytes(),
                    }], answer)

        return totals.where(F.col("kind") == ALL).drop("kind").mapInArrow(answers, "block int, bucket int, totals binary, sizes binary, ids binary, cls binary, spelled binary")

    def laid(left, right):
        """Word numbers of each text of a block; by number: count, subwords, class and spelling; and all subwords in that order."""
        words = Words()
        docs_ids = [words.ids(t or b"") for t in left.column("text").cast(pa.binary()).to_pylist()]
        n_words = len(words.index)
        c, size, cls, spelled = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64), np.zeros(n_words, np.int32), np.zeros(n_words)
        at, parts, back = [], [], {r["bucket"]: r for r in right.to_pylist()}
        for bucket, _, numbers in words.dealt(n_blocks):
            r = back.pop(bucket)
            c[numbers], size[numbers] = np.frombuffer(r["totals"], np.int64), np.frombuffer(r["sizes"], np.int32)
            cls[numbers], spelled[numbers] = np.frombuffer(r["cls"], np.int16), np.frombuffer(r["spelled"], np.float32)
            at.append(numbers)
            parts.append(np.frombuffer(r["ids"], np.int32))
        # subwords by word number, from the order of the answers
        order, sub = np.concatenate(at) if at else np.zeros(0, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.int32)
        came = np.zeros(n_words, np.int64)
        came[order] = np.cumsum(size[order]) - size[order]
        return docs_ids, c, size, cls, spelled, _pieces(sub, came, size)

    def some(docs_ids, size):
        return slices([int(size[i].sum()) + 1 for i in docs_ids], 300_000)  # a bounded number of subwords at a time

    def rehearse(left, right):
        """The changes of the attention layer that one block learns from all its training texts."""
        base, (docs_ids, _, size, cls, _, sub) = _model(shared.value), laid(left, right)
        docs_ids, starts, n = [i for i, out in zip(docs_ids, left.column("out").to_pylist()) if not out], np.cumsum(size) - size, 0
        net = copy.copy(base.net)
        net.p = {k: x.copy() for k, x in base.net.p.items()}
        adam = _Adam(net.p, RATE)
        for lo, hi in some(docs_ids, size):
            n += net.learn([(_pieces(sub, starts[i], size[i]), after(cls[i], size[i])) for i in docs_ids[lo:hi]], adam, lo)
        got = [_change({k: x - base.net.p[k] for k, x in net.p.items()}, n)] if n else []
        return pa.Table.from_batches(got, pa.schema([("d", pa.binary()), ("n", pa.int64())]))

    counted = blocks.groupBy("block").applyInArrow(count, "bucket int, block int, words binary, counts binary")
    totals = checkpointed(counted.groupBy("bucket").applyInArrow(total, "kind int, bucket int, words binary, totals binary, sizes binary, ids binary, blocks binary, places binary"))
    # the sums of all buckets: a few numbers each, and at most one count a subword of the tokenizer
    n_all, n_distinct, once, twice = _numbers(totals)
    every = totals.where(F.col("kind") == SUBWORDS).mapInArrow(_summed, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    subwords = np.zeros(len(bpe.load(tokenizer).token_bytes))
    subwords[[r["id"] for r in every]] = [r["n"] for r in every]
    learn = [w for r in totals.where(F.col("kind") == LEARN).select("words").collect() for w in r["words"].split(b"\n") if w]  # SAMPLE_WORDS, and one a bucket more
    model = first_fit(docs, tokenizer, _most_frequent(totals), learn, subwords)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # fixed by the tokenizer's size
    for part, changes in (
        (model.net, blocks.groupBy("block").cogroup(told_blocks(shared, False).groupBy("block")).applyInArrow(rehearse, "d binary, n long")),
        (model.speller, spelling_learned(totals, shared)),
    ):
        for k, x in averaged(changes).items():
            part.p[k] += x
    shared.destroy()
    model.discount = once / (once + 2 * twice) if once and twice else 0.5
    model.mass, model.types = _class_sums(totals, model)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # fixed by the tokenizer's size
    shift = float(np.log10(n_all + n_distinct + 1))

    def rate(left, right):
        model, (docs_ids, c, size, cls, spelled, sub) = _model(shared.value), laid(left, right)
        starts = np.cumsum(size) - size
        inside = model.inside(cls, c, spelled)
        logs, known = np.log10(c + 1.0), c > 0
        got = np.array([inside[i].sum() for i in docs_ids])
        for lo, hi in some(docs_ids, size):
            got[lo:hi] += model.net.score([(_pieces(sub, starts[i], size[i]), after(cls[i], size[i])) for i in docs_ids[lo:hi]])
        n = np.array([len(i) for i in docs_ids], np.int64)
        return pa.table({
            "doc_id": left.column("doc_id"), "held_out": left.column("out"), "n_tokens": pa.array(n), "n_known": pa.array(np.array([known[i].sum() for i in docs_ids], np.int64)),
            "train_tokens": pa.array(np.full(len(n), n_all, np.int64)), "base_score": pa.array(np.array([logs[i].sum() for i in docs_ids]) - n * shift), "score": pa.array(got / np.log(10)),
        })

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(told_blocks(shared, True).groupBy("block")).applyInArrow(rate, schema)


def _numbers(totals: DataFrame) -> list[int]:
    """Tokens, distinct tokens, and those that occur once and twice, of all buckets."""

    def add(batches):
        sums = np.zeros(4, np.int64)
        for b in batches:
            for x in b.column("totals").to_pylist():
                sums += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_pydict({f"n{i}": [int(x)] for i, x in enumerate(sums)})

    cols = [f"n{i}" for i in range(4)]
    row = totals.where(F.col("kind") == NUMBERS).mapInArrow(add, ", ".join(f"{c} long" for c in cols)).agg(*(F.sum(c).alias(c) for c in cols)).first()
    return [int(row[c] or 0) for c in cols]


def _most_frequent(totals: DataFrame) -> list[bytes]:
    """The TOP most frequent words of all training texts; ties to the lesser bytes."""

    def each(batches):
        for b in batches:
            for w, n in zip(b.column("words").to_pylist(), b.column("totals").to_pylist()):
                if w:
                    yield pa.RecordBatch.from_arrays([pa.array(w.split(b"\n"), pa.binary()), pa.array(np.frombuffer(n, np.int64))], names=["w", "n"])

    return [bytes(r["w"]) for r in totals.where(F.col("kind") == MOST).mapInArrow(each, "w binary, n long").orderBy(F.desc("n"), "w").limit(TOP).collect()]


def _class_sums(totals: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and distinct words of each class in all training texts."""
    shared, n = totals.sparkSession.sparkContext.broadcast(pickle.dumps(model.classes)), model.classes.n

    def add(batches):
        classes, sums = pickle.loads(shared.value), np.zeros((2, n), np.int64)
        for b in batches:
            for r in b.to_pylist():
                c, sizes, ids = np.frombuffer(r["totals"], np.int64), np.frombuffer(r["sizes"], np.int32).astype(np.int64), np.frombuffer(r["ids"], np.int32)
                cls = classes.of(r["words"].split(b"\n"), ids, sizes)
                sums[0] += np.bincount(cls, weights=c, minlength=n).astype(np.int64)
                sums[1] += np.bincount(cls, weights=c > 0, minlength=n).astype(np.int64)
        at = np.nonzero(sums[1])[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["c", "mass", "types"])

    mass, types = np.zeros(n), np.zeros(n)
    for r in totals.where(F.col("kind") == ALL).select("words", "totals", "sizes", "ids").mapInArrow(add, "c int, mass long, types long").groupBy("c").agg(F.sum("mass").alias("mass"), F.sum("types").alias("types")).collect():
        mass[r["c"]], types[r["c"]] = r["mass"], r["types"]
    return mass, types
