"""Personal data: base patterns plus a character-level bidirectional LSTM with CRF transitions.

The model is trained in numpy from labelled spans: those that the base patterns find in a bounded sample of
documents, and made ones in looser spellings. Overlapping windows cover every character of a text; where they
overlap their emissions are averaged, and the whole text is decoded as one path: characters where no best path
can be anything but outside (a bound on what its neighbours' transitions could gain) part it into stretches,
which are decoded exactly, so that the result equals one undivided Viterbi pass.

What the model finds is reconciled over the whole text: pieces of one kind that only separators part are one span, a span covers
whole words, and it must read as what it is said to be (read_as(): a number has as many digits as a phone number, in figures of
any script or in words; an address has a name, an at sign and a dot in some spelling). How much outside is favoured
is set from real passages that did not train.

Defined cases: null text counts as empty; spans that tie at a start are ordered by kind; a model span
that touches a base span is not added; repeated rows get equal spans; extra columns are dropped.
"""

from __future__ import annotations

import random
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_texts, slices, small_batches

# The base patterns and their kinds in listed order.
KINDS = ("email", "ip", "card", "phone")
EMAIL_HERE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL = re.compile("(?<![A-Za-z0-9._%+-])" + EMAIL_HERE.pattern)
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The bounded training sample: documents, passages around a digit or at sign and from anywhere of each, made spans; passes over it.
SAMPLE_DOCS, NEAR, ANYWHERE, MARGIN, MADE, EPOCHS, BATCH = 400, 2, 3, 60, 2400, 9, 64
#: Sizes of the model, of the windows that cover a text and of those that train, windows beside each other (two such batches cover AT_ONCE
#: characters; fewer cost more calls for each character, more do not stay in a core's cache),
#: and characters decoded at a time.
HIDDEN, EMBED, WINDOW, STRIDE, TRAINED, BESIDE, AT_ONCE = 16, 12, 256, 232, 80, 896, 400_000
#: Characters of stretches that are decoded beside each other, the shorter ones filled up.
DECODED = 400_000
#: Bound of a transition score, and the margin of training: certain characters part a text.
STRONGEST, CLEAR = 1.0, 2.5
#: What outside may gain (or lose) after training, and one passage in HELD that does not train but judges it: the least doubt that leaves those clean.
DOUBTS, HELD = (-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0), 5
CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,:;@+-_()[]{}<>/\\\"'=#%&*!?\n\t"
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: The input number after a text's end, next to those of characters.
PADDING = len(CHARS) + 3


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) of each base match, (start, end) of each dropped one)."""
    good, bad = [], []
    if "@" in text:
        good += [(m.start(), 0, m.end()) for m in _emails(text)]
    if not _digit(text):
        return good, bad
    if "." in text:
        for m in IP.finditer(text):
            ok = all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))
            (good.append((m.start(), 1, m.end())) if ok else bad.append((m.start(), m.end())))
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            good.append((m.start(), 2, m.end()))
        else:
            bad.append((m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                good.append((m.start(), 3, m.end()))
            else:
                bad.append((m.start(), m.end()))
    return sorted(good), bad


_digit = re.compile("[0-9]").search


def _emails(text: str):
    """Leftmost non-overlapping email matches; an attempt starts at a local part's first character or where the last match ended."""
    at = 0
    while (m := (EMAIL_HERE.match(text, at) if at else None) or EMAIL.search(text, at)) is not None:
        yield m
        at = m.end()


def _gate(z: np.ndarray) -> np.ndarray:
    """A sigmoid of straight pieces: no exponential for each character."""
    return np.clip(0.25 * z + 0.5, 0, 1)


def _squash(z: np.ndarray) -> np.ndarray:
    """Softsign, in the place of tanh; its slope is (1 - |value|) squared."""
    return z / (1 + np.abs(z))


class Tagger:
    """BiLSTM-CRF over characters in numpy."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) * 0.15).astype(np.float32)
        h, e = HIDDEN, EMBED
        self.p = {"emb": g(len(CHARS) + 3, e), "out": g(2 * h, TAGS), "ob": np.zeros(TAGS, np.float32), "tr": g(TAGS, TAGS)}
        for d in "fb":
            self.p |= {f"wx{d}": g(e, 4 * h), f"wh{d}": g(h, 4 * h), f"b{d}": np.zeros(4 * h, np.float32)}
        self.code = _codes()

    def codes(self, s: str) -> np.ndarray:
        return self.code[np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """x: codes (n, t). Hidden states (t, n, h) and, for training, what backward needs."""
        p, h = self.p, HIDDEN
        pre = p["emb"] @ p[f"wx{d}"] + p[f"b{d}"]
        n, t = x.shape
        hs, hh, c, memo = np.empty((t, n, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = pre[x[:, k]] + hh @ p[f"wh{d}"]
            s = _gate(z[:, : 3 * h])
            i, f, o, u = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], _squash(z[:, 3 * h :])
            last, prev = c, hh
            c = f * c + i * u
            tc = _squash(c)
            hs[k] = hh = o * tc
            if keep:
                memo.append((k, i, f, o, u, tc, last, prev))
        return hs, memo

    def emissions(self, x: np.ndarray, keep: bool = False):
        if not keep:
            return self._quick(x)
        hf, mf = self._lstm(x, "f", keep)
        hb, mb = self._lstm(x, "b", keep)
        both = np.concatenate([hf, hb], 2)
        return both @ self.p["out"] + self.p["ob"], both, mf, mb

    def _quick(self, x: np.ndarray) -> np.ndarray:
        """Emissions without what backward needs, in place.

        The slope and the offset of the gates are taken into the weights. Embeddings, a one for the bias, a
        mark of padding and the hidden state lie above each other, so that a step is one product. Padding
        closes all gates: a text's end does not depend on the longer windows beside it. Windows are filled up
        to a multiple of 16 columns, so that every column goes through the same kernel, and equal windows get equal bits;
        the product has a multiple of 16 rows (the last ones are zero), since its kernel is slower at any other number.
        """
        p, h, e = self.p, HIDDEN, EMBED
        asked, t = x.shape
        n = -(-asked // 16) * 16
        x = np.concatenate([x, np.full((n - asked, t), PADDING, x.dtype)])
        xt, out = np.ascontiguousarray(x.T, np.intp), np.empty((t, TAGS, n + 16), np.float32)[:, :, :n]  # 16: rows do not lie a power of two apart
        ob = p["ob"][:, None]
        slope = np.concatenate([np.full(3 * h, 0.25, np.float32), np.ones(h, np.float32)])
        closed = np.concatenate([np.full(3 * h, -400, np.float32), np.zeros(h, np.float32)])
        table = np.zeros((e, PADDING + 1), np.float32)
        table[:, :PADDING], padded = p["emb"].T, (x == PADDING).any(0)
        fed, z = np.empty((e + 2 + h, n), np.float32), np.empty((-(-(4 * h + TAGS) // 16) * 16, n), np.float32)
        seen, pads, hh, gates, last = fed[:e], fed[e + 1], fed[e + 2 :], z[: 3 * h], z[4 * h : 4 * h + TAGS]
        fed[e] = 1
        shut, open_ = np.zeros_like(gates), np.ones_like(gates)  # whole arrays: numpy compares those much faster than with a number
        i, f, o, u = (z[j * h : (j + 1) * h] for j in range(4))
        c, size = np.empty((h, n), np.float32), np.empty((h, n), np.float32)
        for d, part in (("f", p["out"][:h]), ("b", p["out"][h:])):
            w = np.concatenate([p[f"wx{d}"], p[f"b{d}"][None], closed[None], p[f"wh{d}"]]) * slope
            w[e, : 3 * h] += 0.5
            # the same product gives what the state before this step emits
            w = np.concatenate([w, np.concatenate([np.zeros((e + 2, TAGS), np.float32), part]), np.zeros((len(w), len(z) - 4 * h - TAGS), np.float32)], 1)
            w = np.ascontiguousarray(w.T, np.float32)
            hh[:], c[:], pads[:], at = 0, 0, 0, None
            for k in range(t) if d == "f" else range(t - 1, -1, -1):
                table.take(xt[k], 1, seen, "clip")
                if padded[k]:
                    np.equal(xt[k], PADDING, pads, casting="unsafe")
                elif at is not None and padded[at]:
                    pads[:] = 0
                np.matmul(w, fed, z)
                if at is not None:
                    np.add(last, ob if d == "f" else out[at], out[at])
                at = k
                np.maximum(gates, shut, gates)
                np.minimum(gates, open_, gates)
                np.abs(u, size)
                size += 1
                u /= size
                c *= f
                i *= u
                c += i
                np.abs(c, size)
                size += 1
                np.divide(c, size, hh)
                hh *= o
            if at is not None:
                np.add(part.T @ hh, ob if d == "f" else out[at], out[at])
        return out.transpose(0, 2, 1)[:, :asked]

    def gradients(self, x: np.ndarray, y: np.ndarray, margin: float = 0.0) -> dict[str, np.ndarray]:
        """Gradients of the mean negative CRF log-likelihood of tags y (n, t), all other tags helped by a margin."""
        p, h = self.p, HIDDEN
        em, both, mf, mb = self.emissions(x, True)
        t, n, k = em.shape
        em = em + np.float32(margin) * (np.arange(k) != y.T[:, :, None])
        lse = lambda a, ax: (m := a.max(ax, keepdims=True)).squeeze(ax) + np.log(np.exp(a - m).sum(ax))
        al, be = np.empty_like(em), np.zeros_like(em)
        al[0] = em[0]
        for i in range(1, t):
            al[i] = em[i] + lse(al[i - 1][:, :, None] + p["tr"], 1)
        for i in range(t - 2, -1, -1):
            be[i] = lse(p["tr"] + (em[i + 1] + be[i + 1])[:, None, :], 2)
        z = lse(al[-1], 1)
        dem = np.exp(al + be - z[None, :, None])
        dtr = np.zeros_like(p["tr"])
        for i in range(1, t):
            dtr += np.exp(al[i - 1][:, :, None] + p["tr"] + (em[i] + be[i])[:, None, :] - z[:, None, None]).sum(0)
            np.add.at(dtr, (y[:, i - 1], y[:, i]), -1)
        dem[np.arange(t)[:, None], np.arange(n)[None, :], y.T] -= 1
        dem, g = dem / n, {"tr": dtr / n}
        flat = both.reshape(-1, 2 * h)
        g["out"], g["ob"] = flat.T @ dem.reshape(-1, k), dem.sum((0, 1))
        dboth, demb = dem @ p["out"].T, np.zeros_like(p["emb"])
        for d, memo, part in (("f", mf, dboth[:, :, :h]), ("b", mb, dboth[:, :, h:])):
            dwx, dwh, db = np.zeros_like(p[f"wx{d}"]), np.zeros_like(p[f"wh{d}"]), np.zeros_like(p[f"b{d}"])
            dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for at, i, f, o, u, tc, last, prev in reversed(memo):
                dh = dh + part[at]
                dc = dc + dh * o * (1 - np.abs(tc)) ** 2
                steep = [0.25 * ((v > 0) & (v < 1)) for v in (i, f, o)]
                dz = np.concatenate([dc * u * steep[0], dc * last * steep[1], dh * tc * steep[2], dc * i * (1 - np.abs(u)) ** 2], 1).astype(np.float32)
                xe = p["emb"][x[:, at]]
                dwx += xe.T @ dz
                dwh += prev.T @ dz
                db += dz.sum(0)
                np.add.at(demb, x[:, at], dz @ p[f"wx{d}"].T)
                dh, dc = dz @ p[f"wh{d}"].T, dc * f
            g |= {f"wx{d}": dwx, f"wh{d}": dwh, f"b{d}": db}
        return g | {"emb": demb}

    def fit(self, windows: list[tuple[str, list[int]]], epochs: int = EPOCHS, seed: int = 7) -> Tagger:
        x = np.array([self.codes(s.ljust(TRAINED)[:TRAINED]) for s, _ in windows]).astype(np.int64)
        y = np.array([(t + [0] * TRAINED)[:TRAINED] for _, t in windows])
        r, m, v, step, steps = np.random.default_rng(seed), {}, {}, 0, epochs * -(-len(x) // BATCH)
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), BATCH):
                b = order[at : at + BATCH]
                step += 1
                rate = 0.04 * (1 - 0.9 * step / steps)
                for k, g in self.gradients(x[b], y[b], CLEAR).items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
                np.clip(self.p["tr"], -STRONGEST, STRONGEST, out=self.p["tr"])
        return self

    def viterbi(self, em: np.ndarray) -> np.ndarray:
        """The best tags of one stretch of emissions (t, k)."""
        tr, score, back = self.p["tr"], em[0].astype(np.float64), np.empty(em.shape, np.int8)  # sums of long texts need double precision
        for i in range(1, len(em)):
            s = score[:, None] + tr
            back[i] = s.argmax(0)
            score = s.max(0) + em[i]
        out = np.empty(len(em), np.int64)
        out[-1] = score.argmax()
        for i in range(len(em) - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
        return out

    def covered(self, texts: list[str], pieces: list[tuple[int, int, int]]) -> list[np.ndarray]:
        """Emissions of pieces (text, from, to): windows begin at every STRIDE of a text, and are averaged where they overlap.

        A text is followed by spaces, as in training, so that its end is read alike whatever lies beside it.
        """
        firsts = [max(0, -(-(a - WINDOW + 1) // STRIDE)) * STRIDE for _, a, _ in pieces]
        lasts = [(b - 1) // STRIDE * STRIDE + WINDOW for _, _, b in pieces]
        after = " " * (WINDOW - STRIDE)
        coded = [self.codes((texts[d][a:b] + (after if b > len(texts[d]) else ""))[: b - a]) for (d, _, _), a, b in zip(pieces, firsts, lasts)]
        base = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
        flat = np.concatenate([*coded, np.full(WINDOW, PADDING, np.uint8)])
        starts = [np.arange(lo, lo + b - first, STRIDE) for lo, first, (_, _, b) in zip(base, firsts, pieces)]
        ends = [np.minimum(s + WINDOW, hi) for s, hi in zip(starts, base[1:])]
        start, end = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (starts, ends))
        order = np.argsort(start - end, kind="stable")  # windows of equal length together
        start, end = start[order], end[order]
        hits = np.cumsum(np.bincount(start, minlength=len(flat) + 1) - np.bincount(end, minlength=len(flat) + 1))
        sums = np.zeros((len(flat), TAGS), np.float32)
        for lo in range(0, len(start), BESIDE):
            s, t = start[lo : lo + BESIDE], end[lo : lo + BESIDE]
            x = np.lib.stride_tricks.sliding_window_view(flat, (t - s).max())[s]  # flat ends in padding: every window fits
            short = np.nonzero(t - s < x.shape[1])[0]
            x[short] = np.where(np.arange(x.shape[1]) < (t - s)[short, None], x[short], np.uint8(PADDING))
            em = np.ascontiguousarray(self.emissions(x).transpose(1, 0, 2))
            for x, f, e in zip(em, s.tolist(), t.tolist()):
                sums[f:e] += x[: e - f]
        again = np.nonzero(hits[: len(flat)] > 1)[0]
        sums[again] = sums.take(again, 0, mode="clip") / hits[again].astype(np.float32)[:, None]
        return [sums[lo + a - first : lo + b - first] for lo, first, (_, a, b) in zip(base.tolist(), firsts, pieces)]

    def _gain(self) -> np.ndarray:
        """What the transitions of its neighbours could give back to each tag against outside."""
        tr = self.p["tr"]
        return np.maximum((tr - tr[:, :1]).max(0), 0) + np.maximum((tr - tr[:1]).max(1), 0) + np.float32(1e-4)

    @staticmethod
    def _sure(em: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Where every best path is outside: it beats each other tag by more than its neighbours' transitions could give back."""
        em = em.T
        return em[0] - np.add(em[1:], gain[1:, None], order="C").max(0) > 0  # a tag's row at a time

    def _decode(self, runs: list[tuple[np.ndarray, bool, bool]]) -> list[np.ndarray]:
        """Best tags of stretches (emissions, whether an outside character comes before, and after), in lockstep."""
        tr, out = self.p["tr"], [np.zeros(0, np.int64)] * len(runs)
        order = sorted(range(len(runs)), key=lambda i: -len(runs[i][0]))
        lo = 0
        while lo < len(order):  # long ones, of which few fit beside each other, come first
            some = order[lo : lo + max(1, min(4096, DECODED // len(runs[order[lo]][0])))]
            lo += len(some)
            size = np.array([len(runs[i][0]) for i in some])
            em = np.zeros((size[0], len(some), TAGS), np.float32)
            for k, i in enumerate(some):
                em[: size[k], k] = runs[i][0]
            score = em[0].astype(np.float64) + np.where(np.array([runs[i][1] for i in some])[:, None], tr[0], np.float32(0))
            back = np.zeros(em.shape, np.int8)
            for t in range(1, len(em)):
                n = int((size > t).sum())
                s = score[:n, :, None] + tr
                back[t, :n] = s.argmax(1)
                score[:n] = s.max(1) + em[t, :n]
            tag = (score + np.where(np.array([runs[i][2] for i in some])[:, None], tr[:, 0], np.float32(0))).argmax(1)
            tags = np.zeros(em.shape[:2], np.int64)
            for t in range(len(em) - 1, -1, -1):
                n = int((size > t).sum())
                tags[t, :n] = tag[:n]
                if t:
                    tag[:n] = np.where(size[:n] > t, back[t, np.arange(n), tag[:n]], tag[:n])
            for k, i in enumerate(some):
                out[i] = tags[: size[k], k]
        return out

    def spans(self, texts: list[str], gated: bool = False) -> list[list[tuple[int, int, int]]]:
        """(start, kind, end) of the spans that the model finds in each text.

        gated leaves out stretches beside which nothing stands that reconciled() could read as personal data; it would drop their spans.
        """
        pieces = [(d, a, min(len(t), a + AT_ONCE)) for d, t in enumerate(texts) for a in range(0, len(t), AT_ONCE)]
        gain = self._gain()
        open_: list[list] = []  # unsure stretches: text, from, emissions
        for lo, hi in slices([b - a for _, a, b in pieces], AT_ONCE):
            for (d, a, b), em in zip(pieces[lo:hi], self.covered(texts, pieces[lo:hi])):
                sure = np.concatenate([[True], self._sure(em, gain), [True]])
                edges = np.nonzero(sure[1:] != sure[:-1])[0].reshape(-1, 2)
                if gated and len(edges):
                    marks = np.append(-(10**9), evidence(texts[d], max(0, a - REACH), min(len(texts[d]), b + REACH)) - a)
                    beside = np.searchsorted(marks, edges[:, 0] - REACH) < np.searchsorted(marks, edges[:, 1] + REACH)
                    edges = edges[beside | (edges[:, 0] == 0) | (edges[:, 1] == b - a)]  # those at a piece's end may go on in the next
                for f, t in edges.tolist():
                    if open_ and open_[-1][0] == d and open_[-1][1] + len(open_[-1][2]) == a + f:
                        open_[-1][2] = np.concatenate([open_[-1][2], em[f:t]])
                    else:
                        open_.append([d, a + f, em[f:t].copy()])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (d, a, em), tags in zip(open_, self._decode([(em, a > 0, a + len(em) < len(texts[d])) for d, a, em in open_])):
            i = 0
            while i < len(tags):
                if tags[i] == 0:
                    i += 1
                    continue
                kind, e = (tags[i] - 1) // 2, i + 1
                while e < len(tags) and tags[e] == 2 * kind + 2:
                    e += 1
                out[d].append((a + i, int(kind), a + e))
                i = e
        return out


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Input numbers by code point: listed characters, digits of any script as theirs, other letters, and the rest."""
    code = np.zeros(0x110000, np.uint8)
    for c in range(128, 0x20000):
        ch = chr(c)
        d = unicodedata.digit(ch, -1)
        code[c] = CHARS.index(str(d)) + 1 if d >= 0 else len(CHARS) + 1 if ch.isalpha() else len(CHARS) + 2
    code[0x20000:] = len(CHARS) + 1
    for i, ch in enumerate(CHARS):
        code[ord(ch)] = i + 1
    return code


# Digits in words, and how the signs of an address are spelled out.
SAID = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
AT_SIGN = re.compile(r"(?i)\s*(?:@|\(\s*at\s*\)|\[\s*at\s*\]|\{\s*at\s*\}|\s(?:at)\s)\s*")
DOT_SIGN = re.compile(r"(?i)(?:\.(?!\s)|\s*(?:\(\s*dot\s*\)|\[\s*dot\s*\]|\{\s*dot\s*\}|\s(?:dot)\s)\s*)")
#: The at sign as a plain word, which prose holds too: then a dot must be spelled out as well.
BARE_AT = re.compile(r"(?i)\sat\s")
NAME = re.compile(r"[\w%+-]+", re.A)
#: What a span that can be read must have beside it: a figure of any script, an at sign in some spelling, or a digit in words; and how far
#: spans are grown at most.
EVIDENCE = re.compile(r"(?i)[\d@]|\b(?:at|" + "|".join(SAID) + r")\b")
REACH = 100
_FIGURE = re.compile(r"[\d@]")
_WORDS_OF_EVIDENCE = ("at", *SAID)
_SPACED_WORDS = tuple(f" {w} ".encode() for w in _WORDS_OF_EVIDENCE)
#: ASCII in lower case, with a space for what is in no word.
_PLAIN = bytes(ord(chr(i).lower()) if i < 128 and (chr(i).isalnum() or i == 95) else 32 for i in range(256))


def evidence(text: str, lo: int, hi: int) -> np.ndarray:
    """Where EVIDENCE begins in text[lo:hi], in order; its words are looked for one by one, which is many times faster than the pattern."""
    if any(c in text for c in "\u017f\u0130\u0131"):  # letters that only the pattern takes for s and i
        return np.array([m.start() for m in EVIDENCE.finditer(text, lo, hi)], np.int64)
    words: list[int] = []
    if text.isascii():
        raw = text.encode()
        x = np.frombuffer(raw, np.uint8)[lo:hi]
        figures = np.nonzero((x - np.uint8(48) < 10) | (x == 64))[0] + lo
        # all signs beside words become spaces, so that a word is found with its ends and not in others
        plain = (raw[lo - 1 : hi] if lo else b" " + raw[:hi]).translate(_PLAIN) + b" "
        for w in _SPACED_WORDS:
            at = plain.find(w)
            while at >= 0:
                words.append(lo + at)
                at = plain.find(w, at + len(w) - 1)
        return np.sort(np.concatenate([figures, np.array(words, np.int64)])) if words else figures
    figures = np.array([m.start() for m in _FIGURE.finditer(text, lo, hi)], np.int64)
    low = text.lower()
    for w in _WORDS_OF_EVIDENCE:
        at = low.find(w, lo, hi)
        while at >= 0:
            end = at + len(w)
            if not (at and _in_word(text[at - 1])) and not (end < hi and _in_word(text[end])):
                words.append(at)
            at = low.find(w, end, hi)
    return np.sort(np.concatenate([figures, np.array(words, np.int64)])) if words else figures


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


#: Characters that may stand between the pieces of one span, by kind.
JOINTS = {0: 9, 1: 1, 2: 2, 3: 3}
#: Groups of digits of a telephone number without a country code.
GROUPS = {(3, 3, 4), (3, 7), (4, 6), (5, 5), (4, 3, 4), (4, 3, 3), (3, 4, 4), (2, 4, 4), (5, 6), (3, 3, 2, 2), (2, 2, 2, 2, 2)}


def digits_of(s: str) -> tuple[str, tuple[int, ...]] | None:
    """The digits that a text is made of, in figures of any script or in words, and the sizes of their groups; None if it holds anything else."""
    out, groups = [], []
    for piece in re.findall(r"\d+|[A-Za-z]+|[^\W\d_]|[^\w\s().+-]", s.translate(_JOINERS)):
        if piece[0].isdigit():
            out += [str(unicodedata.digit(c)) for c in piece]
            groups.append(len(piece))
        elif piece.lower() in SAID:
            out.append(SAID[piece.lower()])
            groups.append(1)
        else:
            return None
    return "".join(out), tuple(groups)


#: Signs beside ASCII ones that part the groups of a number.
_JOINERS = {ord(c): " " for c in "\u00b7\u2010\u2011\u2013\u2014\u00a0\uff0d\u3000"} | {0xFF0B: "+", 0xFF08: "(", 0xFF09: ")"}


def read_as(s: str, kind: int) -> bool:
    """Whether a text of whole words can be a span of a kind. What the base patterns of that kind would take or drop in plain
    figures is theirs to judge, but for numbers without a country code."""
    if kind == 0:
        names = AT_SIGN.split(s.strip())
        if len(names) != 2 or not NAME.fullmatch(DOT_SIGN.sub("", names[0])):
            return False
        if BARE_AT.search(s) and "dot" not in names[1].lower():
            return False
        parts = DOT_SIGN.split(names[1])
        return len(parts) > 1 and all(NAME.fullmatch(p) for p in parts) and 2 <= len(parts[-1]) <= 12 and parts[-1].isalpha()
    if kind == 1:
        parts = DOT_SIGN.split(s.strip())
        return len(parts) == 4 and all(p.isdecimal() and len(p) < 10 and int(p) <= 255 for p in parts)
    found = digits_of(s)
    if not found or not found[0]:
        return False
    number, groups = found
    words = max(groups) == 1 and not any(c.isdigit() for c in s)
    plain = all(c in "0123456789" for c in s if c.isdigit())
    if kind == 2:
        return 14 <= len(number) <= 19 and luhn(number) and not words
    if words:
        return 7 <= len(number) <= 15 and len(set(number)) > 1
    if s.translate(_JOINERS).lstrip().startswith("+"):
        return 10 <= len(number) <= 15
    if len(number) not in (10, 11) or (plain and number[:4] in _YEARS and groups != (4, 3, 3)):
        return False
    tail = groups[1:] if groups[0] == 1 and len(number) == 11 else groups
    return groups in GROUPS or tail in GROUPS


_YEARS = {str(y) for y in range(1900, 2100)}


def _whole(text: str, s: int, e: int, kind: int) -> tuple[int, int]:
    """A span grown to whole words (of an address: its name too, where the at sign was found alone), without spaces and commas at its ends."""
    inside = (lambda c: c.isalnum() or c in "._%+-") if kind == 0 else (lambda c: c.isalnum() or c == "+")
    while s < e and text[e - 1].isspace():
        e -= 1
    while s < e and text[s].isspace() and not (kind == 0 and AT_SIGN.match(text, s)):
        s += 1
    lead = AT_SIGN.match(text, s) if kind == 0 and s < e else None
    if lead and lead.end() > s:
        while s > 0 and text[s - 1].isspace() and s > lead.start() - 2:
            s -= 1
    while s > 0 and inside(text[s - 1]):
        s -= 1
    while e < len(text) and inside(text[e]):
        e += 1
    if kind == 3 and s > 0 and text[s - 1] in "(\uff08" and (")" in text[s:e] or "\uff09" in text[s:e]):
        s -= 1
    ends = " \t\n\r,;:!?.\"'" if kind != 3 else " \t\n\r,;:!?.\"'-"
    while s < e and text[s] in ends:
        s += 1
    while s < e and text[e - 1] in ends + ("" if kind != 3 else "("):
        e -= 1
    return s, e


def reconciled(text: str, found: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The model's spans as whole ones that read as their kind, in order; none touches one that is taken."""
    merged: list[list[int]] = []
    for s, k, e in found:
        if merged and merged[-1][1] == k and s - merged[-1][2] <= JOINTS[k] and not text[merged[-1][2] : s].strip(" \t().-[]{}@+atdo\uff0d\u00a0\u3000"):
            merged[-1][2] = max(e, merged[-1][2])
        else:
            merged.append([s, k, e])
    out: list[tuple[int, int, int]] = []
    for s, k, e in merged:
        s, e = _whole(text, s, e, k)
        if k in (2, 3) and not any(c.isdigit() for c in text[s:e]):
            s, e = _said_run(text, s, e)
        elif s < e and not read_as(text[s:e], k):  # the model saw a part of it
            if k == 0:
                s, e = _address(text, s, e)
            elif k in (2, 3):
                s, e = _number_run(text, s, e)
        k = 3 if k == 2 and s < e and not read_as(text[s:e], 2) and read_as(text[s:e], 3) else k
        if s < e and read_as(text[s:e], k) and not any(s < b and a < e for a, b in taken) and not (out and s < out[-1][2]):
            out.append((s, k, e))
    return out


_ADDRESS = re.compile(rf"[\w%+-]+(?:\.[\w%+-]+)*{AT_SIGN.pattern[4:]}[A-Za-z0-9-]+(?:{DOT_SIGN.pattern[4:]}[A-Za-z0-9-]+)+", re.I)


def _address(text: str, s: int, e: int) -> tuple[int, int]:
    """The spelled address that a span lies in; its last part is a word."""
    for m in _ADDRESS.finditer(text, max(0, s - 60), min(len(text), e + 60)):
        if m.start() < e and s < m.end():
            whole = not (m.start() > 0 and text[m.start() - 1].isalnum()) and not (m.end() < len(text) and text[m.end()].isalnum())
            return m.span() if whole else (s, s)
    return s, s


_RUN = re.compile(r"(?:[+\uff0b]\s?)?[(\uff08]?\d(?:[\s().\u00b7\u2010-\u2014\uff08\uff09\uff0d-]{0,3}\d)*")


def _number_run(text: str, s: int, e: int) -> tuple[int, int]:
    """The run of figures and signs between them that a span lies in."""
    lo, hi = max(0, s - 40), min(len(text), e + 40)
    for m in _RUN.finditer(text, lo, hi):
        if m.start() < e and s < m.end():
            whole = not (m.start() > 0 and text[m.start() - 1].isalnum()) and not (m.end() < len(text) and text[m.end()].isalnum())
            return m.span() if whole else (s, s)
    return s, e


_WORD = re.compile(r"[A-Za-z]+")


def _said_run(text: str, s: int, e: int) -> tuple[int, int]:
    """The longest run of digit words that a span touches."""
    lo, hi = max(0, s - 80), min(len(text), e + 80)
    runs, last = [], None
    for m in _WORD.finditer(text, lo, hi):
        if m[0].lower() in SAID and not (m.end() == hi and hi < len(text) and text[hi].isalpha()):
            if last is not None and not text[last[1] : m.start()].strip(" \t,-"):
                last[1] = m.end()
            else:
                last = [m.start(), m.end()]
                runs.append(last)
        else:
            last = None
    touching = [r for r in runs if r[0] < e and s < r[1]]
    return tuple(max(touching, key=lambda r: r[1] - r[0])) if touching else (s, e)


def _made(r: random.Random, words: list[str]) -> tuple[str, list[int]]:
    """One made window: words of the corpus around a span in a common or loose spelling, or around something that is no personal data."""
    low = "abcdefghijklmnopqrstuvwxyz"
    w = lambda a, b: "".join(r.choice(low) for _ in range(r.randint(a, b)))
    real = lambda: r.choice(words) if words and r.random() < 0.85 else w(1, 9)
    name = lambda: (re.sub("[^a-z]", "", real().lower()) or w(2, 8))[:10]
    wide = str.maketrans("0123456789", "".join(chr(0xFF10 + i) for i in range(10)))
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    digits = list(SAID)[:10]
    said = lambda k: " ".join(r.choice(digits) for _ in range(k))
    at, dot = r.choice([("@", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" at ", " dot "), ("{at}", "."), (" {at} ", "."), (" AT ", " DOT ")])
    mail = f"{name()}{r.choice(['.', '_', ''])}{r.choice(['', name(), d(r.randint(1, 2))])}{at}{name()}{dot}{r.choice(['com', 'org', 'net', 'de', 'example' + dot + 'com'])}"
    ring = r.choice([f"+{r.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}", f"+{r.randint(1, 99)}{r.choice([' ', '-'])}{d(3)}{r.choice([' ', '-'])}{d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}"])
    prose = lambda k: " ".join(real() for _ in range(k))
    kind, s = r.choice([
        (0, mail), (0, mail), (0, mail), (0, mail), (0, mail), (0, mail), (0, mail), (0, mail), (1, ".".join(str(r.randint(0, 255)) for _ in range(4))), (3, ring), (3, ring), (3, ring.translate(wide)), (3, said(r.randint(7, 11))), (3, said(r.randint(7, 11))), (2, f"{d(4)} {d(4)} {d(4)} {d(4)}".translate(wide)),
        (None, f"{r.randint(1900, 2030)}"), (None, f"Version {r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}"), (None, f"({real()})"), (None, f"{real()}_{d(2)} [{w(1, 4)}]"), (None, d(r.randint(1, 12))), (None, f"AKIA{w(16, 16).upper()}"),
        (None, "".join(r.choice("0123456789abcdef") for _ in range(20))), (None, f"{real()} at {real()} {real()}"), (None, f"at the {real()} of dot {real()}"), (None, said(r.randint(1, 2))), (None, f"{d(2)}:{d(2)}"), (None, f"{d(2)}.{d(2)} {w(3, 3).upper()}"),
        (None, f"{d(4)}-{d(2)}-{d(2)}"), (None, "| " * r.randint(2, 9)), (None, r.choice("-=*.!") * r.randint(5, 25)), (None, (real() + r.choice([" ", ", "])) * r.randint(3, 9)), (None, prose(8)), (None, prose(8)),
    ])
    lead = prose(6)[-r.randint(8, 34) :]
    before, after = lead + " ", r.choice([" ", ". ", ", ", "\n", "; "]) + prose(8)
    tags = [0] * len(before) + ([0] * len(s) if kind is None else [2 * kind + 1] + [2 * kind + 2] * (len(s) - 1)) + [0] * len(after)
    return (before + s + after)[:TRAINED], tags[:TRAINED]


def corpus_words(passages: list[str]) -> list[str]:
    """The words of passages as often as they occur, without those that hold a digit or an at sign."""
    return [x for t in passages for x in t.split()[1:-1] if not re.search("[0-9@]", x)]


def training_windows(passages: list[str], seed: int = 7) -> list[tuple[str, list[int]]]:
    """Windows of passages, tagged by the base spans, and made ones in the words of the passages."""
    words = corpus_words(passages)
    r, out = random.Random(seed), [_made(random.Random(seed * 100_000 + i), words) for i in range(MADE)]
    for t in passages:
        tags = [0] * len(t)
        for s, k, e in base_spans(t)[0]:
            if s < e and not any(tags[s:e]):
                tags[s:e] = [2 * k + 1] + [2 * k + 2] * (e - s - 1)
        a = r.randint(0, max(0, len(t) - TRAINED))
        out.append((t[a : a + TRAINED], tags[a : a + TRAINED]))
    return out


def _texts(batch: pa.RecordBatch, col: str) -> list[str]:
    """A string column's texts; null is empty, and bytes that are no UTF-8 become the replacement character."""
    return [t.decode("utf-8", "replace") for t in batch_texts(batch, col)]


def passages(docs: DataFrame, text_col: str = "text") -> list[str]:
    """NEAR passages around digits and at signs of about SAMPLE_DOCS documents that have some, and ANYWHERE passages of as many others."""
    whole = docs.select(F.col(text_col).alias("t")).where(F.length("t") > 0)
    sign = F.col("t").rlike("[0-9@]")
    # as hash_sample() takes them, from one scan that counts and one that chooses
    counts = whole.agg(F.count_if(sign), F.count("*")).first()
    near, any_ = (F.pmod(F.xxhash64("t"), F.lit(max(1, n // SAMPLE_DOCS))) == 0 for n in counts)
    taken = F.filter(F.array(F.when(near & sign, True), F.when(any_, False)), lambda x: x.isNotNull())
    both = whole.where(near | any_).select("t", F.explode(taken).alias("near")).dropDuplicates(["t", "near"])

    def choose(batches):
        for b in batches:
            out = []
            for t, near in zip(_texts(b, "t"), b.column("near").to_pylist()):
                r = random.Random(zlib.crc32(t.encode("utf-8", "replace")))
                at = [m.start() for m in re.finditer("@|[0-9]+", t)] if near else []
                at = r.sample(at, min(NEAR, len(at))) if near else [r.randrange(len(t)) for _ in range(ANYWHERE)]
                out += [t[max(0, a - MARGIN) : a + MARGIN] for a in at]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["p"])

    return sorted({r["p"] for r in small_batches(both).mapInArrow(choose, "p string").collect()})


def train(docs: DataFrame, text_col: str = "text") -> dict[str, np.ndarray]:
    """Parameters learned from the passages of a bounded sample and MADE made spans; one passage in HELD only sets the doubt."""
    known = passages(docs, text_col)
    held = [t for i, t in enumerate(known) if i % HELD == 0]
    tagger = Tagger().fit(training_windows([t for i, t in enumerate(known) if i % HELD]))
    calm = [t for t in held if not base_spans(t)[0]]
    plain = tagger.p["ob"].copy()
    for doubt in DOUBTS:
        tagger.p["ob"] = plain.copy()
        tagger.p["ob"][0] += doubt
        if not any(reconciled(t, found, []) for t, found in zip(calm, tagger.spans(calm))):
            break
    return tagger.p


@lru_cache(maxsize=1)
def _tagger(key: bytes) -> Tagger:
    import pickle

    t = Tagger()
    t.p = pickle.loads(key)
    return t


def spans_of(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, as (start, kind, end) in order."""
    out = []
    for text, found in zip(texts, tagger.spans(texts, gated=True)):
        base, _ = base_spans(text)
        base.sort()
        out.append((base, sorted(base + reconciled(text, found, [(s, e) for s, _, e in base]))))
    return out


def find(docs: DataFrame, params: dict[str, np.ndarray], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans): arrays of struct<s,k,e> in order; kinds as numbered in KINDS."""
    import pickle

    key = docs.sparkSession.sparkContext.broadcast(pickle.dumps(params))  # a few tens of kB
    kind = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))

    def run(batches):
        tagger = _tagger(key.value)
        for batch in batches:
            got = spans_of(_texts(batch, text_col), tagger)
            cols = [pa.array([[{"s": s, "k": k, "e": e} for s, k, e in g[i]] for g in got], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *cols], names=[id_col, "base", "spans"])

    span = "array<struct<s:int,k:int,e:int>>"
    return small_batches(docs).select(id_col, text_col).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, base {span}, spans {span}")


def spelled(col: str):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document."""
    found = find(docs, train(docs))
    counts = [F.size(F.filter("base", lambda x, k=k: x["k"] == k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spelled("base").cast("binary"), 256).alias("base_sha256"), spelled("spans").alias("spans"))
