"""BPE encoding and decoding by a pair occurrence index.

All distinct pieces of a batch lie in one symbol sequence with links. An index maps each mergeable
pair to all its positions; active ranks are applied in ascending order, and only the lists of the
neighbouring pairs that a merge creates are updated. Work follows the number of merges, so a piece
of a million characters costs no more per character than a short one.

Defined cases: null text counts as empty (no ids, empty decoded text); special-token strings in a
text become their own id, as the tokenizer file says; repeated rows give repeated results; extra
columns pass through unless they are named like the result, then the result replaces them.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Pieces that a Python worker remembers between batches; beyond it the memory starts afresh.
REMEMBER = 800_000
#: Rows encoded at once.
OUT_ROWS = 1000
#: After so many lists shorter than FEW, the rest is merged one position at a time.
FEW, FEW_TIMES = 40, 60

# The split pattern of the byte-level tokenizer (white space as Unicode has it).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class _Known(dict):
    """Numbers of pieces; a piece that is asked for the first time is noted in fresh and gets the next number."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.fresh.append(piece)
        return n


class PairIndexBPE:
    """A byte-level BPE tokenizer read from a `tokenizers` JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [vocab[c] for c in letters]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.rank = {}
        for r, (a, b, _) in enumerate(self.rules):
            self.rank.setdefault(a << 32 | b, r)
        keys = np.array(list(self.rank), np.uint64)
        order = np.argsort(keys)
        self.rank_keys, self.rank_vals = keys[order], np.array(list(self.rank.values()), np.int64)[order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in vocab.items():
            self.token_bytes[i] = bytes(of_letter[c] for c in t) if all(c in of_letter for c in t) else t.encode()
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pieces = regex.compile(PIECES).findall
        self.known, self.pool, self.starts = _Known(), np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.token_len = np.array([len(t) for t in self.token_bytes], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])
        self.token_pool = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has), by the pair occurrence index over all pieces at once."""
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lens = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        ids = np.array(self.byte_ids, np.int64)[raw]
        ends = np.cumsum(lens + 1) - 1
        ids[ends] = -1  # a wall after each piece
        n = len(ids)
        left, right = ids[:-1], ids[1:]
        key = (left << 32 | right).astype(np.uint64)
        at = np.minimum(np.searchsorted(self.rank_keys, key), len(self.rank_keys) - 1)
        hit = (self.rank_keys[at] == key) & (left >= 0) & (right >= 0) if len(self.rank_keys) else np.zeros(n - 1, bool)
        pos = np.nonzero(hit)[0]
        ranks = self.rank_vals[at[pos]]
        index: dict[int, list[np.ndarray]] = {}
        self._file(index, ranks, pos)
        heap = list(index)
        heapq.heapify(heap)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        small = 0
        while heap and small < FEW_TIMES:  # long lists: whole arrays at a time
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(r)))
            small += len(at) < FEW
            for k in self._merge_list(r, at, ids, nxt, prv, index):
                heapq.heappush(heap, k)
        positions = {r: np.concatenate(at).tolist() for r, at in index.items()}
        sym, nxt, prv = ids.tolist(), nxt.tolist(), prv.tolist()
        rank, rules = self.rank.get, self.rules
        while heap:
            r = heapq.heappop(heap)
            a, b, made = rules[r]
            for p in sorted(positions.pop(r)):
                if sym[p] != a or sym[q := nxt[p]] != b:
                    continue  # an earlier merge took one of the two
                sym[p], sym[q] = made, -2
                nxt[p] = after = nxt[q]
                prv[after] = p
                if (before := sym[prv[p]]) >= 0 and (k := rank(before << 32 | made)) is not None:
                    if k in positions:
                        positions[k].append(prv[p])
                    else:
                        positions[k] = [prv[p]]
                        heapq.heappush(heap, k)
                if (follows := sym[after]) >= 0 and (k := rank(made << 32 | follows)) is not None:
                    if k in positions:
                        positions[k].append(p)
                    else:
                        positions[k] = [p]
                        heapq.heappush(heap, k)
        ids = np.array(sym, np.int64)
        alive = ids >= 0
        upto = np.concatenate([[0], np.cumsum(alive)])[ends]
        return ids[alive].astype(np.int32), np.diff(upto, prepend=0)

    @staticmethod
    def _file(index: dict[int, list[np.ndarray]], ranks: np.ndarray, pos: np.ndarray) -> list[int]:
        """Add positions to the lists of their ranks; the ranks that had no list before."""
        order = np.argsort(ranks, kind="stable")
        ranks, pos = ranks[order], pos[order]
        new, starts = [], np.nonzero(np.diff(ranks, prepend=-1))[0]
        for r, p in zip(ranks[starts].tolist(), np.split(pos, starts[1:]) if len(starts) else []):
            if r in index:
                index[r].append(p)
            else:
                index[r] = [p]
                new.append(r)
        return new

    def _merge_list(self, r: int, at: np.ndarray, sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray, index: dict) -> list[int]:
        """Apply one rank to its sorted position list; update the lists of the new pairs."""
        a, b, made = self.rules[r]
        q = nxt[at]
        live = (sym[at] == a) & (sym[q] == b)
        at, q = at[live], q[live]
        if a == b and len(at) > 1:  # of touching pairs, every other one from the left
            head = np.concatenate([[True], q[:-1] != at[1:]])
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at, q = at[run % 2 == 0], q[run % 2 == 0]
        if not len(at):
            return []
        sym[at], sym[q] = made, -2
        after = nxt[q]
        nxt[at] = after
        prv[after] = at
        before = prv[at]
        left, right = sym[before], sym[after]
        key = np.concatenate([left << 32 | made, np.int64(made) << 32 | right]).astype(np.uint64)
        where = np.concatenate([before, at])
        ok = np.concatenate([left >= 0, right >= 0])
        key, where = key[ok], where[ok]
        j = np.minimum(np.searchsorted(self.rank_keys, key), len(self.rank_keys) - 1)
        hit = self.rank_keys[j] == key
        return self._file(index, self.rank_vals[j[hit]], where[hit])

    def _make_room(self) -> None:
        if len(self.known) > REMEMBER:
            self.known.clear()
            self.known.fresh, self.pool, self.starts = [], np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Merge the pieces that were asked for the first time."""
        known, special = self.known, self.special
        if not known.fresh:
            return
        plain = [p for p in known.fresh if p not in special]
        ids, sizes = self.merge([p.encode() for p in plain])
        if len(plain) < len(known.fresh):  # special tokens take their places among the rest
            parts = iter(np.split(ids, np.cumsum(sizes)[:-1]))
            own = [np.array([special[p]], np.int32) if p in special else next(parts) for p in known.fresh]
            sizes, ids = np.array([len(i) for i in own]), np.concatenate(own)
        self.pool = np.concatenate([self.pool, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        known.fresh = []

    def _gather(self, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces in a row, and where each piece's ids start (one more at the end)."""
        size = self.starts[piece + 1] - self.starts[piece]
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.pool[np.repeat(self.starts[piece] - upto[:-1], size) + np.arange(upto[-1])], upto

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of pieces taken whole, where each piece's ids start)."""
        self._make_room()
        piece = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        return self._gather(piece)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ends of each text's ids)."""
        self._make_room()
        split, special, of, docs = self.pieces, self.special, self.known.__getitem__, []
        for text in texts:
            if self.special_split is not None and any(t in text for t in special):
                parts = []
                for part in self.special_split.split(text):
                    parts += [part] if part in special else split(part)
            else:
                parts = split(text)
            docs.append(np.fromiter(map(of, parts), np.int64, len(parts)))
        self._learn()
        piece = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        ids, upto = self._gather(piece)
        return ids, upto[np.cumsum([len(d) for d in docs])] if docs else np.zeros(0, np.int64)

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids cut at ends."""
        size = self.token_len[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        raw = self.token_pool[np.repeat(self.token_at[ids] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        cuts = [0, *upto[ends].tolist()]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def load(path: str) -> PairIndexBPE:
    """One tokenizer per Python worker and file."""
    return PairIndexBPE(path)


def _put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], names=[*names, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", keep_text: bool = False) -> DataFrame:
    """df with the token ids of text_col as array<int>; the text itself stays only if asked for."""

    def run(batches):
        bpe = load(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(at, OUT_ROWS)
                ids, ends = bpe.encode_batch([t or "" for t in batch.column(text_col).to_pylist()])
                if not keep_text:
                    batch = batch.drop_columns([text_col]) if text_col != ids_col else batch
                yield _put(batch, ids_col, pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), pa.array(ids, pa.int32())))

    schema = T.StructType([f for f in _schema(df, ids_col, T.ArrayType(T.IntegerType())).fields if keep_text or f.name != text_col or f.name == ids_col])
    return small_batches(df).mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with the text that ids_col stands for; null ids give an empty text, broken UTF-8 becomes U+FFFD."""

    def run(batches):
        bpe = load(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(at, OUT_ROWS)
                lists = batch.column(ids_col)
                ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                texts = bpe.decode_batch(lists.flatten().to_numpy(zero_copy_only=False), ends)
                yield _put(batch, text_col, pa.array(texts, pa.string()))

    return small_batches(df).mapInArrow(run, _schema(df, text_col, T.StringType()))


def digest(encoded: DataFrame) -> DataFrame:
    """The contract's columns from real ids and real decoded texts."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
