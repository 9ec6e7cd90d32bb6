"""Suffix-array removal of repeated passages across documents.

A byte goes when a string of LENGTH bytes that covers it also starts in a document with a smaller id.

1. Every LENGTH-byte string holds an anchor: the GRAM bytes in it with the least hash. Equal strings have
   equal anchors, so only anchors of at least two documents can matter. Blocks of texts send their packed
   anchor hashes to buckets and get back those that are shared.
2. Blocks send the surroundings of shared anchors, each distinct one once with its first document, to the
   bucket of the anchor. There, all suffixes of one suffix bucket (an anchor) at a time are sorted blockwise
   with a difference cover; neighbours in that order that agree in LENGTH bytes give each string's first
   document. Anchors of very many documents are instead split by string: every distinct string goes, with
   its first document in the block, to a bucket of its own hash.
3. Blocks get the answers for their surroundings and strings, and cut the texts.

Texts are shuffled once; nothing is collected; no group is unbounded, as each block sends a distinct
surrounding or string once, and hot anchors are dealt over all buckets.

Defined cases: null text counts as empty; a null id is larger than every id; rows with one id do not
shorten each other; texts under LENGTH bytes stay; extra columns pass through remove().
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks_for, give_back, mix64, small_batches, split_by_bucket, text_bytes, u64
from .suffixes import PERIOD, sample_ranks, sort_bucket, word_at

LENGTH, GRAM = 50, 20
SIDE = LENGTH - GRAM  # bytes of a surrounding before and after the anchor
ROW = LENGTH + SIDE
#: Anchors of more documents than this (counted in blocks) are dealt by string.
HOT = 512
#: Bytes of text handled at once, and suffixes sorted at once (a larger single anchor is still sorted whole).
CHUNK, SUFFIXES = 1 << 16, 1 << 18
ROWS_AT_ONCE = 1 << 13
KEY_BYTES = 6
_MASK = np.uint64((1 << (8 * KEY_BYTES)) - 1)
_C = 0x9E3779B97F4A7C15 | 1
NO_ID = np.iinfo(np.int64).max


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_C, -1, 1 << 64)
    one = lambda c: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, c, np.uint64)]))
    return one(_C), one(inverse)


def _slide(f, x: np.ndarray, w: int) -> np.ndarray:
    """f over each run of w neighbours."""
    n, s, y = len(x) - w + 1, 1, x
    while s * 2 <= w:
        y = f(y[:-s], y[s:])
        s *= 2
    return f(y[:n], y[w - s : w - s + n]) if s < w else y


class Anchors:
    """The anchors of several texts laid in a row: positions, hashes, owners and surroundings."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.raw)
        size = 1 << max(20, (n + 1).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * power[:n])])
        if n < LENGTH:
            self.pos = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
        else:
            h = mix64((self.sums[GRAM:] - self.sums[:-GRAM]) * self.inverse[: n - GRAM + 1])
            least = _slide(np.minimum, h, LENGTH - GRAM + 1)
            ends = np.repeat(self.begin[1:], sizes)[: len(least)]
            least[np.arange(len(least)) + LENGTH > ends] = 0  # no string crosses documents
            pad = np.zeros(LENGTH - GRAM, np.uint64)
            self.pos = np.nonzero((_slide(np.maximum, np.concatenate([pad, least, pad]), LENGTH - GRAM + 1) == h) & (h > 0))[0]
            self.hash = h[self.pos] & _MASK
        self.doc = np.searchsorted(self.begin, self.pos, side="right") - 1
        self.lo = np.maximum(self.pos - SIDE, self.begin[self.doc])
        self.hi = np.minimum(self.pos + LENGTH, self.begin[self.doc + 1])

    def strings(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of byte strings by content."""
        return (self.sums[hi] - self.sums[lo]) * self.inverse[lo]

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """Hashes of surroundings: content and where the anchor lies in it."""
        lo, hi, p = self.lo[at], self.hi[at], self.pos[at]
        return mix64(mix64(self.strings(lo, hi)) ^ ((p - lo) * 256 + (hi - lo)).astype(np.uint64))

    def rows(self, at: np.ndarray) -> np.ndarray:
        """Surroundings as rows of ROW bytes with the anchor at SIDE, zero where the document ends."""
        col = self.pos[at][:, None] + np.arange(-SIDE, LENGTH)
        ok = (col >= self.lo[at][:, None]) & (col < self.hi[at][:, None])
        return np.where(ok, self.raw[np.clip(col, 0, len(self.raw) - 1)], 0).astype(np.uint8)

    @staticmethod
    def of_rows(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(contexts(), anchor hashes) again from rows(): lo and hi are the ends of the surroundings in their rows."""
        if len(rows) > ROWS_AT_ONCE:
            parts = [Anchors.of_rows(rows[i : i + ROWS_AT_ONCE], lo[i : i + ROWS_AT_ONCE], hi[i : i + ROWS_AT_ONCE]) for i in range(0, len(rows), ROWS_AT_ONCE)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        power, inverse = _powers(1 << 20)
        cols = np.arange(ROW)
        inside = (cols >= lo[:, None]) & (cols < hi[:, None])
        part = np.where(inside, rows.astype(np.uint64) + np.uint64(1), np.uint64(0)) * power[:ROW]
        whole = part.sum(1, dtype=np.uint64) * inverse[lo]
        gram = part[:, SIDE : SIDE + GRAM].sum(1, dtype=np.uint64) * inverse[SIDE]
        return mix64(mix64(whole) ^ ((SIDE - lo) * 256 + (hi - lo)).astype(np.uint64)), mix64(gram) & _MASK

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, start) of each LENGTH-byte string around the anchors."""
        count = np.maximum(self.hi[at] - self.lo[at] - LENGTH + 1, 0)
        own = np.repeat(at, count)
        first = np.repeat(self.lo[at] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) if len(at) else np.zeros(0, np.int64)
        return own, first + np.arange(len(own))


def _chunks(table: pa.Table, text: str, ids: str):
    """(first row, texts, ids) for groups of rows of about CHUNK bytes."""
    texts, numbers = [x or b"" for x in table.column(text).cast(pa.binary()).to_pylist()], table.column(ids).cast(pa.int64()).fill_null(NO_ID).to_numpy()
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            yield lo, texts[lo : i + 1], numbers[lo : i + 1]
            lo, size = i + 1, 0


def _pack(keys: np.ndarray) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpack(cells) -> np.ndarray:
    raw = np.frombuffer(b"".join(cells), np.uint8).reshape(-1, KEY_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :KEY_BYTES] = raw
    return out.view(np.uint64).ravel()


def _first(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, where each is first, its least document, whether it has more than one)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), docs, np.zeros(0, bool)
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    head = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0] if len(k) else np.zeros(0, np.int64)
    last = np.append(head[1:], len(k)) - 1
    return k[head], order[head], d[head], d[head] != d[last]


ANSWER = pa.schema([("block", pa.int32()), ("kind", pa.int8()), ("keys", pa.binary()), ("docs", pa.binary()), ("masks", pa.binary())])
ANSWER_SQL = "block int, kind byte, keys binary, docs binary, masks binary"
#: Kinds of answers: shared anchors, hot anchors, surroundings, strings.
SHARED, HOTS, CONTEXTS, STRINGS = range(4)


def _window_masks(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, docs: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each surrounding, the bits of its strings that a surrounding of an earlier document in its group also holds.

    Groups are sorted a bounded number of suffixes at a time, unless one group alone is larger.
    """
    masks = np.zeros(len(rows), np.uint32)
    order = np.argsort(group, kind="stable")
    g = group[order]
    heads = np.nonzero(np.concatenate([[True], g[1:] != g[:-1]]))[0] if len(g) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(g)))
    at = 0
    while at < len(heads):
        to = at + 1
        while to < len(heads) and (heads[to] + size[to] - heads[at]) * (SIDE + 1) <= SUFFIXES:
            to += 1
        part = order[heads[at] : heads[to] if to < len(heads) else len(g)]
        masks[part] = _sort_part(rows[part], lo[part], hi[part], docs[part], group[part])
        at = to
    return masks


def _sort_part(rows, lo, hi, docs, group) -> np.ndarray:
    wide = np.zeros((len(rows), ROW + 2 * PERIOD + 8), np.uint8)
    wide[:, :ROW] = rows
    ranks = sample_ranks(wide, ROW)
    count = np.maximum(hi - lo - LENGTH + 1, 0)
    r = np.repeat(np.arange(len(rows)), count)
    s = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(r))
    order = sort_bucket(wide, ROW, r, s, group[r], ranks)
    r, s = r[order], s[order]
    same = np.ones(max(len(r) - 1, 0), bool)
    for b in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        v = word_at(wide, r, s + b)
        same &= v[1:] == v[:-1]
    same &= group[r][1:] == group[r][:-1]
    heads = np.nonzero(np.concatenate([[True], ~same]))[0] if len(r) else np.zeros(0, np.int64)
    out = np.zeros(len(rows), np.uint32)
    if len(r):
        least = np.minimum.reduceat(docs[r], heads)[np.cumsum(np.concatenate([[True], ~same])) - 1]
        hit = docs[r] > least
        np.bitwise_or.at(out, r[hit], np.uint32(1) << s[hit].astype(np.uint32))
    return out


def _cut(texts: list[bytes], ids: np.ndarray, hot: np.ndarray, context: tuple, string: tuple) -> list[np.ndarray]:
    """Which bytes of each text go."""
    a = Anchors(texts)
    start = np.zeros(len(a.raw), bool)
    doc = ids[a.doc]
    keys, firsts, masks = context
    if len(keys) and len(a.pos):
        c = a.contexts(np.arange(len(a.pos)))
        j = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
        hit = np.nonzero(keys[j] == c)[0]
        j = j[hit]
        own, w = a.windows(hit[doc[hit] > firsts[j]])
        start[w] = True
        some = (doc[hit] == firsts[j]) & (masks[j] != 0)
        at, m = hit[some], masks[j[some]]
        for b in range(SIDE + 1):
            on = (m >> np.uint32(b)) & np.uint32(1) == 1
            start[a.pos[at[on]] - SIDE + b] = True
    if len(hot) and len(string[0]) and len(a.pos):
        own, w = a.windows(np.nonzero(np.isin(a.hash, hot))[0])
        k = mix64(a.strings(w, w + LENGTH))
        j = np.minimum(np.searchsorted(string[0], k), len(string[0]) - 1)
        start[w[(string[0][j] == k) & (doc[own] > string[1][j])]] = True
    n = len(a.raw)
    last = np.maximum.accumulate(np.where(start, np.arange(n), -LENGTH)) if n else np.zeros(0, np.int64)
    gone = np.arange(n) - last < LENGTH
    return [gone[x:y] for x, y in zip(a.begin, a.begin[1:])]


def remove(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", hot: int = HOT, block_bytes: int = 16 << 20, as_text: bool = False) -> DataFrame:
    """docs with _kept (binary, the bytes that stay; as_text: a string without letters cut in two), _n_bytes, _n_removed and _n_spans."""
    n_blocks, limit = blocks_for(text_bytes(docs, text_col), block_bytes), hot
    columns = docs.columns
    blocks = small_batches(docs).withColumn("_block", F.pmod(F.xxhash64(id_col, F.col(id_col).isNull()), F.lit(n_blocks)).cast("int")).repartition(n_blocks, "_block")

    def announce(batches):
        by: dict[int, list] = {}
        for b in batches:
            t = pa.Table.from_batches([b])
            for block in set(b.column("_block").to_pylist()):
                part = t.filter(pa.compute.equal(t.column("_block"), block))
                for _, texts, ids in _chunks(part, text_col, id_col):
                    a = Anchors(texts)
                    # one entry for each anchor and document
                    k, d = a.hash, ids[a.doc]
                    order = np.lexsort((d, k))
                    k, d = k[order], d[order]
                    new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]) if len(k) else np.zeros(0, bool)
                    by.setdefault(block, []).append((k[new], d[new]))
        for block, parts in by.items():
            k, d = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]) if len(k) else np.zeros(0, bool)
            k, n = np.unique(k[new], return_counts=True)
            for bucket, kk, nn in split_by_bucket(k, n_blocks, n):
                many = nn > 1
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "block": block, "ones": _pack(kk[~many]), "many": _pack(kk[many]), "counts": nn[many].astype(np.uint32).tobytes()}], pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("ones", pa.binary()), ("many", pa.binary()), ("counts", pa.binary())]))

    def share(group):
        rows, keys, counts, cut = group.to_pylist(), [], [], []
        for r in rows:
            keys += [_unpack([r["ones"]]), _unpack([r["many"]])]
            counts += [np.ones(len(keys[-2]), np.int64), np.frombuffer(r["counts"], np.uint32).astype(np.int64)]
            cut.append(len(keys[-2]) + len(keys[-1]))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts))
        out, lo = [], 0
        for r, n in zip(rows, cut):
            mine = at[lo : lo + n]
            lo += n
            for kind, ok in ((SHARED, (total[mine] > 1) & (total[mine] <= limit)), (HOTS, total[mine] > limit)):
                if ok.any():
                    out.append({"block": r["block"], "kind": kind, "keys": distinct[mine[ok]].tobytes()})
        return pa.Table.from_pylist(out, ANSWER)

    told = blocks.mapInArrow(announce, "bucket int, block int, ones binary, many binary, counts binary").groupBy("bucket").applyInArrow(share, ANSWER_SQL)

    sent = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int8()), ("keys", pa.binary()), ("docs", pa.binary()), ("meta", pa.binary()), ("rows", pa.binary())])

    def send(left, right):
        give_back()
        if not right.num_rows:
            return pa.Table.from_pylist([], sent)
        kinds, cells = right.column("kind").to_numpy(), right.column("keys").to_pylist()
        cold, hot = (np.sort(u64(c for c, k in zip(cells, kinds) if k == kind)) for kind in (SHARED, HOTS))
        block = right.column("block")[0].as_py()
        ctx, win = [], []
        for _, texts, ids in _chunks(left, text_col, id_col):
            a = Anchors(texts)
            if len(cold):
                at = np.nonzero(cold[np.minimum(np.searchsorted(cold, a.hash), len(cold) - 1)] == a.hash)[0]
                c, head, d, multi = _first(a.contexts(at), ids[a.doc[at]])
                at = at[head]
                meta = np.stack([SIDE - (a.pos[at] - a.lo[at]), SIDE + (a.hi[at] - a.pos[at]), multi], 1).astype(np.uint8)
                ctx.append((c, a.hash[at], d, meta, a.rows(at)))
            if len(hot):
                own, w = a.windows(np.nonzero(np.isin(a.hash, hot))[0])
                k, _, d, multi = _first(mix64(a.strings(w, w + LENGTH)), ids[a.doc[own]])
                win.append((k, d, multi))
        out = []
        if ctx:
            c, anchor, d, meta, rows = (np.concatenate(x) for x in zip(*ctx))
            keys, head, first, multi = _first(c, d)
            meta = meta.copy()
            any_multi = np.zeros(len(keys), bool)
            np.logical_or.at(any_multi, np.searchsorted(keys, c), meta[:, 2] > 0)
            meta = meta[head]
            meta[:, 2] = multi | any_multi
            # hashes are formed again from the rows where they arrive
            for bucket, _, dd, mm, rr in split_by_bucket(anchor[head], n_blocks, first, meta, rows[head]):
                out.append({"bucket": bucket, "block": block, "kind": CONTEXTS, "docs": dd.tobytes(), "meta": mm.tobytes(), "rows": pa.compress(rr.tobytes(), "zstd", asbytes=True)})
        if win:
            k, d, multi = (np.concatenate(x) for x in zip(*win))
            keys, _, first, more = _first(k, d)
            any_multi = np.zeros(len(keys), bool)
            np.logical_or.at(any_multi, np.searchsorted(keys, k), multi)
            for bucket, kk, dd, mm in split_by_bucket(keys, n_blocks, first, (more | any_multi).astype(np.uint8)):
                out.append({"bucket": bucket, "block": block, "kind": STRINGS, "keys": kk.tobytes(), "docs": dd.tobytes(), "meta": mm.tobytes()})
        return pa.Table.from_pylist(out, sent)

    def judge(group):
        give_back()
        out, rows = [], group.to_pylist()
        for kind in (CONTEXTS, STRINGS):
            part = [r for r in rows if r["kind"] == kind]
            if not part:
                continue
            docs_ = np.frombuffer(b"".join(r["docs"] for r in part), np.int64)
            if kind == CONTEXTS:
                meta = np.frombuffer(b"".join(r["meta"] for r in part), np.uint8).reshape(-1, 3)
                raw = (pa.decompress(r["rows"], len(r["docs"]) // 8 * ROW, "zstd", asbytes=True) for r in part)
                text = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, ROW)
                keys, anchors = Anchors.of_rows(text, meta[:, 0].astype(np.int64), meta[:, 1].astype(np.int64))
            else:
                keys = u64(r["keys"] for r in part)
            distinct, head, first, _ = _first(keys, docs_)
            at = np.searchsorted(distinct, keys)
            masks = np.zeros(len(distinct), np.uint32)
            if kind == CONTEXTS:
                _, group_of, size = np.unique(anchors[head], return_inverse=True, return_counts=True)
                many = np.nonzero(size[group_of] > 1)[0]  # an anchor with one surrounding needs no sorting
                m = meta[head[many]].astype(np.int64)
                masks[many] = _window_masks(text[head[many]], m[:, 0], m[:, 1], first[many], group_of[many])
                multi = meta[:, 2] > 0
            else:
                multi = np.frombuffer(b"".join(r["meta"] for r in part), np.uint8) > 0
            told = multi | (docs_ > first[at]) | (masks[at] != 0)
            lo = 0
            for r in part:
                n = len(r["docs"]) // 8
                mine = at[lo : lo + n][told[lo : lo + n]]
                lo += n
                if len(mine):
                    out.append({"block": r["block"], "kind": kind, "keys": distinct[mine].tobytes(), "docs": first[mine].tobytes(), "masks": masks[mine].tobytes()})
        return pa.Table.from_pylist(out, ANSWER)

    sends = blocks.groupBy("_block").cogroup(told.groupBy("block")).applyInArrow(send, "bucket int, block int, kind byte, keys binary, docs binary, meta binary, rows binary")
    answers = sends.groupBy("bucket").applyInArrow(judge, ANSWER_SQL).unionByName(told.where(F.col("kind") == HOTS))
    result = T.StructType([*docs.schema.fields, T.StructField("_kept", T.StringType() if as_text else T.BinaryType()), T.StructField("_n_bytes", T.LongType()), T.StructField("_n_removed", T.LongType()), T.StructField("_n_spans", T.LongType())])

    def cut(left, right):
        give_back()
        kinds, cells = right.column("kind").to_numpy(), right.to_pylist()
        of = lambda kind, col: [c[col] for c, k in zip(cells, kinds) if k == kind]
        hot = u64(of(HOTS, "keys"))
        tables = []
        for kind in (CONTEXTS, STRINGS):
            keys = u64(of(kind, "keys"))
            order = np.argsort(keys)
            tables.append((keys[order], np.frombuffer(b"".join(of(kind, "docs")), np.int64)[order], np.frombuffer(b"".join(of(kind, "masks")), np.uint32)[order]))
        kept, size, removed, spans = [], [], [], []
        for _, texts, ids in _chunks(left, text_col, id_col):
            for t, gone in zip(texts, _cut(texts, ids, hot, tables[0], tables[1])):
                n = int(gone.sum())
                kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes() if n else t)
                size.append(len(t))
                removed.append(n)
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()) if n else 0)
        out = left.select(columns)
        for name, values, kind in (("_kept", [b.decode("utf-8", "ignore") for b in kept] if as_text else kept, pa.string() if as_text else pa.binary()), ("_n_bytes", size, pa.int64()), ("_n_removed", removed, pa.int64()), ("_n_spans", spans, pa.int64())):
            out = out.append_column(name, pa.array(values, kind))
        return out

    return blocks.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(cut, result)


def report(docs: DataFrame, **how) -> DataFrame:
    """The contract's columns for each document."""
    return remove(docs.select("doc_id", "text"), **how).select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with the repeated passages cut out of text_col; bytes of a letter that is cut in two go as well.

    A present n_chars follows the new text; null texts stay null.
    """
    out = remove(docs, text_col, id_col, as_text=True)
    out = out.withColumn(text_col, F.when(F.col("_n_removed") == 0, F.col(text_col)).otherwise(F.col("_kept")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_removed") == 0, F.col("n_chars")).otherwise(F.char_length(text_col).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def brute_force(texts: dict[int, bytes], length: int = LENGTH) -> dict[int, tuple[int, int, str]]:
    """(n_removed, n_spans, kept_sha256) of each document by a table of all strings: for tests."""
    first: dict[bytes, int] = {}
    for i in sorted(texts):
        t = texts[i]
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    out = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    return out
