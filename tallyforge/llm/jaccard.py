"""Exact Jaccard join of word shingles by count vectors in an R-tree.

1. Blocks. A pair within the threshold differs in at most D shingles. With the shingles hashed into more
   than D groups, such a pair agrees in a whole group; so each document has a key for each group, and only
   documents that share a key can link. Blocks of texts send packed keys to buckets and learn which keys
   several sets share (a document is in the size class of the smaller set, or of both where classes meet).
2. R-tree. For shared keys, blocks send count vectors: shingles hashed into groups and counted, about
   PER_GROUP to a group, so that unlike sets of any size stay apart. The sum of coordinate minima bounds an overlap from above. In a bucket, the vectors are packed into the
   leaves of an R-tree; leaves are joined by the minima of their upper corners, then points. What survives
   gives families (components of possible links), and only a star for each component of a key is passed on.
3. Verification. The sets of each family meet in one task, or in tasks for pairs of its chunks where a
   family is large; pairs that the bounds leave are compared exactly, unless they are connected already.

No pair list of a group leaves a task; nothing is capped; equal sets are handled once a block.

Defined cases: null text counts as empty; an empty set links with nothing; fewer words than a shingle form
one shingle; ties go to the smallest id; rows with a null id are left out of links and get no component;
repeated rows (one id) link with each other; extra columns pass through keep_one().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, checkpointed, give_back, mix64, small_batches, split_by_bucket, text_bytes, u64
from .components import components
from .repeats import KEY_BYTES, _chunks, _pack, _powers, _unpack

#: Shingles of a count vector's coordinate and the fewest and most coordinates, points of an R-tree leaf, ratio of size classes, documents of a family's chunk.
PER_GROUP, GROUPS, LEAF, RATIO, FAMILY = 10, (16, 4096), 64, 1.5, 2048
FULL = 255  # a count that may be larger
#: Families' members up to this number (16 bytes each) may be broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 2_000_000
KEY_MASK = np.uint64((1 << (8 * KEY_BYTES)) - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts in a row, where each text's begin)."""
    raw = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, stop = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    power, inverse = _powers(1 << max(20, (len(raw) + 1).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])])
    word = mix64((sums[stop] - sums[start]) * inverse[start])
    owner = np.searchsorted(ends, start, side="right")
    n = np.bincount(owner, minlength=len(texts))
    h = np.zeros(max(len(word) - k + 1, 0), np.uint64)
    for i in range(k):
        h = h * _A + word[i : i + len(h)]
    own = owner[: len(h)]
    inside = owner[k - 1 :] == own
    h, own = mix64(h[inside] ^ np.uint64(k)), own[inside]
    few = np.nonzero((n > 0) & (n < k))[0]
    if len(few):  # the whole sequence as one shingle
        first = np.searchsorted(owner, few)
        whole = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            on = n[few] > i
            whole[on] = whole[on] * _B + word[first[on] + i]
        h, own = np.concatenate([h, mix64(whole + n[few].astype(np.uint64))]), np.concatenate([own, few])
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])]) if len(h) else np.zeros(0, bool)
    h, own = h[new], own[new]
    return h, np.searchsorted(own, np.arange(len(texts) + 1))


def set_marks(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 128-bit mark of each set (two order-free sums), as rows of two numbers."""
    out = np.zeros((len(begin) - 1, 2), np.uint64)
    for i, c in enumerate((_A, _B)):
        s = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h ^ c))])
        out[:, i] = mix64(s[begin[1:]] - s[begin[:-1]] + np.diff(begin).astype(np.uint64))
    return out


class Threshold:
    """den * overlap >= num * union, and what follows from it."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def need(self, a, b):
        """The least overlap of sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def larger(self, a: int) -> int:
        return a * self.den // self.num

    def classes(self, most: int) -> list[tuple[int, int, int, int]]:
        """(least size, largest size, errors, groups) of each size class of the smaller set."""
        out, lo = [], 1
        while lo <= most:
            hi = max(lo, int(lo * RATIO))
            errors = (hi + self.larger(hi)) - self.need(hi, self.larger(hi)) * 2
            for a in (hi, hi - 1):  # rounding may favour a smaller pair by little
                b = self.larger(a)
                errors = max(errors, a + b - 2 * self.need(a, b)) if a >= lo else errors
            errors = max(errors, (hi + self.larger(hi)) * (self.den - self.num) // (self.den + self.num))
            out.append((lo, hi, errors, errors + 1 + (errors + 1) // 8))
            lo = hi + 1
        return out


def keys_of(h: np.ndarray, begin: np.ndarray, at: Threshold) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(class, coordinates of its count vectors, keys, their sets) for every group key of every set."""
    size = np.diff(begin)
    out = []
    for c, (lo, hi, errors, m) in enumerate(at.classes(int(size.max()) if len(size) else 0)):
        pick = np.nonzero((size >= lo) & (size <= at.larger(hi)))[0]
        if not len(pick):
            continue
        own = np.repeat(np.arange(len(pick)), size[pick])
        x = h[np.repeat(begin[pick] - np.concatenate([[0], np.cumsum(size[pick])[:-1]]), size[pick]) + np.arange(len(own))]
        cell = own * m + ((x >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(x ^ _B)[order])])
        edges = np.searchsorted(cell[order], np.arange(len(pick) * m + 1))
        sub, n = sums[edges[1:]] - sums[edges[:-1]], np.diff(edges)
        key = mix64(mix64(sub + n.astype(np.uint64) * _A) + (np.tile(np.arange(m), len(pick)).astype(np.uint64) * _B) + np.uint64((c + 1) * int(_A) & 0xFFFFFFFFFFFFFFFF))
        # at least m - errors groups agree: sets with fewer empty groups than that need no key for them
        empty = n == 0
        spare = empty.reshape(-1, m).sum(1) < m - errors
        use = ~(empty & np.repeat(spare, m))
        out.append((c, coordinates(hi), key[use] & KEY_MASK, np.repeat(pick, m)[use]))
    return out


def coordinates(size: int) -> int:
    """How many groups the count vectors of sets of a size have."""
    return min(max(1 << max(size // PER_GROUP, 1).bit_length(), GROUPS[0]), GROUPS[1])


def vectors(h: np.ndarray, begin: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors of sets; a coordinate of FULL counts as unbounded."""
    n = len(begin) - 1
    cell = np.repeat(np.arange(n), np.diff(begin)) * groups + ((h >> np.uint64(7)) % np.uint64(groups)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=n * groups), FULL).reshape(n, groups).astype(np.uint8)


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """R-tree leaves of at most LEAF points: the widest coordinate is cut at its middle again and again."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        p = todo.pop()
        if len(p) <= LEAF:
            out.append(p)
            continue
        x = points[p]
        axis = int(np.argmax(x.max(0).astype(np.int64) - x.min(0)))
        order = p[np.argsort(x[:, axis], kind="stable")]
        todo += [order[: len(p) // 2], order[len(p) // 2 :]]
    return out


def minima(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of all rows of a with all rows of b; a saturated coordinate makes them unbounded."""
    out = np.empty((len(a), len(b)), np.int64)
    for i in range(len(a)):
        out[i] = np.minimum(a[i], b).sum(1, dtype=np.int32)
    full_a, full_b = (a == FULL).any(1), (b == FULL).any(1)
    out[full_a[:, None] & full_b[None, :]] = np.iinfo(np.int64).max
    return out


class Forest:
    """Union-find over 0..n-1 with labels kept flat, and the edges that joined something."""

    def __init__(self, n: int):
        self.label, self.edges = np.arange(n), []
        self.members: dict[int, list[int]] = {}

    def join(self, i: int, j: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return
        self.edges.append((i, j))
        ma, mb = self.members.pop(a, [a]), self.members.pop(b, [b])
        if len(ma) < len(mb):
            a, b, ma, mb = b, a, mb, ma
        self.label[mb] = a
        self.members[a] = ma + mb


def tree_join(points: np.ndarray, size: np.ndarray, at: Threshold, forest: Forest, linked, across: np.ndarray | None = None) -> None:
    """Join all pairs whose bound allows a link and that are not connected yet and for which linked(i, js) holds.

    across: only pairs of unlike values are looked at.
    """
    parts = leaves(points)
    top = np.array([points[p].max(0) for p in parts])
    least, most = np.array([size[p].min() for p in parts]), np.array([size[p].max() for p in parts])
    for i, p in enumerate(parts):
        # the smallest overlap that any pair of the two leaves needs
        near = at.need(np.maximum(least[i], 0), least[i:])
        fit = (minima(top[i : i + 1], top[i:])[0] >= near) & (least[i:] * at.num <= most[i] * at.den) & (least[i] * at.num <= most[i:] * at.den)
        for j in np.nonzero(fit)[0] + i:
            q = parts[j]
            if forest.label[p[0]] == forest.label[q[0]] and (forest.label[p] == forest.label[p[0]]).all() and (forest.label[q] == forest.label[p[0]]).all():
                continue
            ok = minima(points[p], points[q]) >= at.need(size[p][:, None], size[q][None, :])
            if across is not None:
                ok &= across[p][:, None] != across[q][None, :]
            if i == j:
                ok &= np.arange(len(p))[:, None] < np.arange(len(p))[None, :]
            for a in np.nonzero(ok.any(1))[0]:
                b = q[ok[a]]
                b = b[forest.label[b] != forest.label[p[a]]]
                for x in linked(p[a], b) if len(b) else ():
                    forest.join(int(p[a]), int(x))


def possible(points: np.ndarray, size: np.ndarray, at: Threshold, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the pairs whose bound allows a link, as stars around their least name.

    Stars repeat from key to key where forests would not, so far fewer distinct edges are left.
    """
    forest = Forest(len(points))
    tree_join(points, size, at, forest, lambda i, js: js)
    order = np.lexsort((names, forest.label))
    label = forest.label[order]
    head = np.concatenate([[True], label[1:] != label[:-1]])
    lead = names[order][np.nonzero(head)[0]][np.cumsum(head) - 1]
    return lead[~head], names[order][~head]


def verified(sets: list[np.ndarray], at: Threshold, across: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets that link (exact)."""
    size = np.array([len(s) for s in sets])
    flat, begin = np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])
    forest = Forest(len(sets))
    # coordinates: the family's common shingles one by one (there, a minimum is a product), the rest in groups
    distinct, inv, count = np.unique(flat, return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(len(sets)), size)
    common = np.nonzero(count >= max(3, len(sets) // 50))[0]
    common = common[np.argsort(-count[common], kind="stable")][:1024]
    column = np.full(len(distinct), -1)
    column[common] = np.arange(len(common))
    bits = np.zeros((len(sets), len(common)), np.float32)
    on = column[inv] >= 0
    bits[own[on], column[inv[on]]] = 1
    rest = np.bincount(own[~on] * 16 + ((flat[~on] >> np.uint64(7)) % np.uint64(16)).astype(np.int64), minlength=len(sets) * 16).reshape(-1, 16)

    def linked(i: int, js: np.ndarray) -> np.ndarray:
        bound = bits[js] @ bits[i] + np.minimum(rest[js], rest[i]).sum(1)
        need = at.need(size[i], size[js])
        out, mine = [], sets[i]
        for j, n in zip(js[bound >= need], need[bound >= need]):
            if forest.label[i] == forest.label[j]:
                continue
            s = sets[j]
            k = np.searchsorted(mine, s)
            k[k == len(mine)] = len(mine) - 1
            if (mine[k] == s).sum() >= n:
                forest.join(int(i), int(j))
        return np.array(out, np.int64)

    tree_join(vectors(flat, begin, coordinates(int(size.max()))), size, at, forest, linked, across)
    return forest.edges


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = 6 << 20, family: int = FAMILY) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs with an integer id."""
    at = Threshold(num, den)
    docs = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_blocks = blocks_for(text_bytes(docs), block_bytes)
    n_meets = max(24, n_blocks // 3)  # buckets of count vectors: the fewer there are, the fewer stars repeat
    ids = docs.where(F.col("doc_id").isNotNull())
    blocks = ids.withColumn("_block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")).repartition(n_blocks, "_block")

    def measure(batches):
        for b in batches:
            for lo, texts, numbers in _chunks(pa.Table.from_batches([b]), "text", "doc_id"):
                h, begin = shingles(texts, k)
                marks = set_marks(h, begin)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, len(texts)), pa.array(np.diff(begin)), pa.array([m.tobytes() for m in marks], pa.binary())], names=["doc_id", "n_shingles", "mark"])

    def announce(batches):
        by: dict[int, tuple[set, list]] = {}
        for b in batches:
            t = pa.Table.from_batches([b])
            for block in set(b.column("_block").to_pylist()):
                part = t.filter(pa.compute.equal(t.column("_block"), block))
                seen, found = by.setdefault(block, (set(), []))
                for _, texts, _ in _chunks(part, "text", "doc_id"):
                    h, begin = shingles(texts, k)
                    new = _new_sets(set_marks(h, begin), np.diff(begin), seen)
                    found += [keys[new[sets]] for _, _, keys, sets in keys_of(h, begin, at)]
        for block, (_, found) in by.items():
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            for bucket, kk, nn in split_by_bucket(keys, n_blocks, n):
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "block": block, "keys": _pack(kk), "many": np.packbits(nn > 1).tobytes()}], pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("many", pa.binary())]))

    def share(group):
        give_back()
        rows = group.to_pylist()
        keys = _unpack(r["keys"] for r in rows)
        cut = [len(r["keys"]) // KEY_BYTES for r in rows]
        distinct, inv = np.unique(keys, return_inverse=True)
        n = np.bincount(inv, weights=1 + np.concatenate([np.unpackbits(np.frombuffer(r["many"], np.uint8))[:c] for r, c in zip(rows, cut)]))
        out, lo = [], 0
        for r, c in zip(rows, cut):
            mine = inv[lo : lo + c]
            lo += c
            if (n[mine] > 1).any():
                out.append({"block": r["block"], "keys": distinct[mine[n[mine] > 1]].tobytes()})
        return pa.Table.from_pylist(out, pa.schema([("block", pa.int32()), ("keys", pa.binary())]))

    sent = pa.schema([("bucket", pa.int32()), ("width", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary()), ("points", pa.binary())])

    def send(left, right):
        give_back()
        shared, seen, got = np.sort(u64(right.column("keys").to_pylist())), set(), {}
        if len(shared):
            for _, texts, numbers in _chunks(left, "text", "doc_id"):
                h, begin = shingles(texts, k)
                new = _new_sets(set_marks(h, begin), np.diff(begin), seen)
                for c, width, keys, sets in keys_of(h, begin, at):
                    ok = new[sets] & (shared[np.minimum(np.searchsorted(shared, keys), len(shared) - 1)] == keys)
                    used, back = np.unique(sets[ok], return_inverse=True)
                    if len(used):
                        runs = [h[begin[x] : begin[x + 1]] for x in used]
                        points = vectors(np.concatenate(runs), np.concatenate([[0], np.cumsum([len(x) for x in runs])]), width)
                        got.setdefault((c, width), []).append((keys[ok], numbers[sets[ok]], np.diff(begin)[sets[ok]].astype(np.int32), points[back]))
        out = []
        for (_, width), parts in got.items():
            keys, docs_, sizes, points = (np.concatenate(x) for x in zip(*parts))
            out += [{"bucket": b, "width": width, "keys": kk.tobytes(), "docs": d.tobytes(), "sizes": s.tobytes(), "points": p.tobytes()} for b, kk, d, s, p in split_by_bucket(keys, n_meets, docs_, sizes, points)]
        return pa.Table.from_pylist(out, sent)

    def judge(group):
        give_back()
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        widths = group.column("width").to_numpy()
        cells = lambda name, rows, kind: np.concatenate([np.frombuffer(group.column(name)[int(i)].as_buffer(), kind) for i in rows])
        for width in np.unique(widths):  # cells are read where they lie, one width at a time
            rows = np.nonzero(widths == width)[0]
            keys, docs_ = cells("keys", rows, np.uint64), cells("docs", rows, np.int64)
            size, points = cells("sizes", rows, np.int32).astype(np.int64), cells("points", rows, np.uint8).reshape(-1, width)
            order = np.argsort(keys, kind="stable")
            heads = np.nonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))[0]
            n = np.diff(np.append(heads, len(order)))
            a, b = order[heads[n == 2]], order[heads[n == 2] + 1]
            ok = _bound(points[a], points[b]) >= at.need(size[a], size[b])
            us.append(np.minimum(docs_[a[ok]], docs_[b[ok]]))
            vs.append(np.maximum(docs_[a[ok]], docs_[b[ok]]))
            for head, c in zip(heads[n > 2], n[n > 2]):
                p = order[head : head + c]
                lead, rest = possible(points[p], size[p], at, docs_[p])
                us.append(lead)
                vs.append(rest)
        pairs = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)], 1), axis=0)
        return pa.table({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})

    shared = blocks.mapInArrow(announce, "bucket int, block int, keys binary, many binary").groupBy("bucket").applyInArrow(share, "block int, keys binary")
    points = blocks.groupBy("_block").cogroup(shared.groupBy("block")).applyInArrow(send, "bucket int, width int, keys binary, docs binary, sizes binary, points binary")
    families = components(points.groupBy("bucket").applyInArrow(judge, "u long, v long"))
    # large families are cut into chunks, and each pair of chunks meets in a task of its own
    sizes = families.groupBy(F.col("root").alias("_root")).count()
    chunks = F.ceil(F.col("count") / family).cast("int")
    placed = families.join(sizes, F.col("root") == F.col("_root")).select(F.col("node").alias("doc_id"), "root", chunks.alias("chunks"), F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"))
    placed = checkpointed(placed)
    members = F.broadcast(placed) if placed.count() <= BROADCAST_ROWS else placed

    def gather(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            for lo, texts, _ in _chunks(t, "text", "doc_id"):
                h, begin = shingles(texts, k)
                part = b.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "root", "chunks", "chunk")), pa.array([h[x:y].tobytes() for x, y in zip(begin, begin[1:])], pa.binary())], names=["doc_id", "root", "chunks", "chunk", "shingles"])

    sets = ids.join(members, "doc_id").mapInArrow(gather, "doc_id long, root long, chunks int, chunk int, shingles binary")
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    meet = sets.withColumn("other", F.explode(other)).select("doc_id", "root", "chunk", "shingles", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunks")
    # small families share tasks; each pair of chunks has its own
    task = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("root"), F.lit(4 * n_blocks))).otherwise(F.xxhash64("root", "i", "j"))

    def compare(group):
        give_back()
        docs_, roots = group.column("doc_id").to_numpy(), group.column("root").to_numpy()
        i, j, chunk = (group.column(c).to_numpy() for c in ("i", "j", "chunk"))
        cells = group.column("shingles").to_pylist()
        us, vs = [], []
        order = np.lexsort((docs_, roots, j, i))
        same = (roots[order][1:] == roots[order][:-1]) & (i[order][1:] == i[order][:-1]) & (j[order][1:] == j[order][:-1])
        heads = np.nonzero(np.concatenate([[True], ~same]))[0]
        for lo, hi in zip(heads, np.append(heads[1:], len(order))):
            p = order[lo:hi]
            first: dict[bytes, int] = {}
            for x in p:  # equal sets are linked and compared once
                y = first.setdefault(cells[x], x)
                if y != x:
                    us.append(docs_[y])
                    vs.append(docs_[x])
            q = np.array(list(first.values()))
            if len(q) > 1:
                across = chunk[q] if i[q[0]] != j[q[0]] else None
                for a, b in verified([np.frombuffer(cells[x], np.uint64) for x in q], at, across):
                    us.append(docs_[q[a]])
                    vs.append(docs_[q[b]])
        return pa.table({"u": pa.array(np.array(us, np.int64)), "v": pa.array(np.array(vs, np.int64))})

    links = components(meet.withColumn("task", task).groupBy("task").applyInArrow(compare, "u long, v long"))
    # equal sets share a component; its name is the smallest id of all of them
    every = checkpointed(docs.mapInArrow(measure, "doc_id long, n_shingles long, mark binary"))
    by_mark = every.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("mark").agg(F.min("doc_id").alias("least"))
    rooted = every.join(links, every["doc_id"] == links["node"]).groupBy("mark").agg(F.min("root").alias("root"))
    marks = by_mark.join(rooted, "mark", "left")
    named = marks.where(F.col("root").isNotNull()).groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("name"))
    marks = marks.join(named, F.col("root") == F.col("_r"), "left").select(F.col("mark").alias("_m"), F.coalesce("name", "least").alias("name"))
    out = every.join(marks, (every["mark"] == marks["_m"]) & (every["n_shingles"] > 0), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"))


def _new_sets(marks: np.ndarray, size: np.ndarray, seen: set) -> np.ndarray:
    """Which sets are not empty and are the first of their kind."""
    out = np.zeros(len(marks), bool)
    for i, m in enumerate(marks):
        if size[i] and (b := m.tobytes()) not in seen:
            seen.add(b)
            out[i] = True
    return out


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.minimum(a, b).sum(1, dtype=np.int64) if len(a) else np.zeros(0, np.int64)
    out[(a == FULL).any(1) & (b == FULL).any(1)] = np.iinfo(np.int64).max
    return out


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with one row of each component: of its rows with the smallest id the one whose text has the least hash. Rows without an id stay.

    Rows are linked by their texts, not by their ids: of an id that stands on two different texts both stay, unless the texts are
    linked. Of rows that agree in id and text any one stays.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]  # the caller's names come back at the end
    key, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    row = F.when(F.col(key).isNotNull(), F.xxhash64(F.coalesce(F.col(text), F.lit("")), key))  # a number for each different row
    rows = docs.toDF(*names).withColumn("_row", row)
    found = join(rows.select(F.col("_row").alias("doc_id"), F.col(text).alias("text")), k, num, den).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_of")).distinct()
    ids = rows.where(F.col("_row").isNotNull()).groupBy("_row").agg(F.first(key).alias("_id"), F.count(F.lit(1)).alias("_rows"))
    lead = found.join(ids, "_row").groupBy("_of").agg(F.min(F.struct("_id", "_row", "_rows")).alias("l")).select(F.col("l._row").alias("_lead"), F.col("l._rows").alias("_rows"))
    lead = checkpointed(lead)
    met = rows.join(lead, rows["_row"] == lead["_lead"], "left")
    alone = met.where((F.col("_rows") == 1) | F.col("_row").isNull())
    repeated = rows.join(lead.where("_rows > 1"), rows["_row"] == F.col("_lead")).dropDuplicates(["_lead"])
    return alone.select(*names).unionByName(repeated.select(*names)).toDF(*docs.columns)
