"""Language identification by cross-parsing entropy.

The labelled text of each language, a bounded sample, becomes a suffix automaton over UTF-8 bytes, with an
alphabet of its own, so that no script is cut. A text is parsed greedily into the longest phrases that each
automaton holds; the language with the least cross-entropy, phrases times the logarithm of its training
length, wins. Whole texts are parsed exactly: segments in lockstep at first, then every segment is parsed on
from the phrase that reaches into it until both parses begin a phrase at the same byte.

Defined cases: null text, or text without a letter, is `und` with score 0; ties go to the
alphabetically first language; without any labelled text every row is `und`; extra columns are
dropped; repeated rows get equal answers.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, small_batches

#: The bounded training sample: documents of a language (of all its rows, by hash) and characters of a passage of each. Where there are more
#: than MANY languages, passages are shorter in proportion, so that the automata of all stay in memory; no document of the sample is left out.
TRAIN_DOCS, PASSAGE_CHARS, MANY = 200, 200, 25
#: Bytes of a segment, and of texts parsed at a time.
SEGMENT, AT_ONCE = 512, 8 << 20
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> dict[str, bytes]:
    """Training bytes by language: a passage from anywhere in TRAIN_DOCS documents of each language, chosen by hash among all rows.

    Only (lang, hash, id) is ranked, with Spark's limit for each group ahead of the shuffle; what comes to the driver is
    bounded by the parameters and the number of languages.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    order = F.xxhash64("doc_id", F.lit("lang"))
    first = known.select("lang", F.col("doc_id").alias("id"), order.alias("h")).withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))).where(F.col("r") <= TRAIN_DOCS)
    picked = F.broadcast(first.select("lang", "id").distinct())  # at most TRAIN_DOCS a language
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - PASSAGE_CHARS + 1, F.lit(1))).cast("int") + 1
    rows = known.join(picked, (known["doc_id"] == picked["id"]) & (known["lang"] == picked["lang"]), "left_semi").select("lang", order.alias("h"), F.substring(F.col("text"), at, F.lit(PASSAGE_CHARS)).alias("text")).distinct().collect()
    by: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["text"])):
        by.setdefault(r["lang"], []).append(r["text"])
    most = PASSAGE_CHARS if len(by) <= MANY else max(20, PASSAGE_CHARS * MANY // len(by))
    return {lang: letters(" ".join(t[:most] for t in texts)) for lang, texts in by.items()}


def letters(text: str) -> bytes:
    """Lower-case letters and marks as UTF-8; each run of anything else is one space."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


def automaton(codes: list[int], width: int) -> np.ndarray:
    """The suffix automaton of a code sequence as a table: next state by state and code; state 0 is none (and leads nowhere), 1 the start."""
    nxt: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.zeros((len(nxt), width), np.int32)
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            table[s, c] = t
    return table


class Parser:
    """The suffix automaton of one language over the bytes of its training text."""

    def __init__(self, text: bytes):
        used = sorted(set(text))
        self.code = np.zeros(256, np.int32)  # 0: a byte that the language lacks
        self.code[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.table = automaton(self.code[np.frombuffer(text, np.uint8)].tolist(), self.width).ravel()
        self.restart = self.table[self.width : 2 * self.width]
        self.bits = float(np.log2(len(text) + 256))  # a language with hardly any text gains nothing by that

    def _next(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states after codes c, whether a phrase began with them)."""
        go = self.table[state * self.width + c]
        new = go == 0
        return np.where(new, self.restart[c], go), new

    def segments(self, steps: np.ndarray, running: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each segment (column; long ones in front) parsed from its own start: where phrases begin, and the last states."""
        n = steps.shape[1]
        state, begins = np.zeros(n, np.int32), np.zeros(steps.shape, bool)
        for t in range(len(steps)):
            if not (m := running[t]):
                break
            state[:m], begins[t, :m] = self._next(state[:m], self.code[steps[t, :m]])
        return begins, state

    def joined(self, grid: np.ndarray, size: np.ndarray, first: np.ndarray, begins: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Phrases that begin in each segment of whole texts; rows are segments in order, `first` marks a text's first one."""
        after = begins[:, ::-1].cumsum(1, dtype=np.int32)[:, ::-1]  # beginnings from here on
        count, end = after[:, 0].copy(), last.copy()
        todo = np.nonzero(~first)[0]
        while len(todo):
            state, more, live, t = end[todo - 1], np.zeros(len(todo), np.int32), np.arange(len(todo)), 0
            ends = last[todo].copy()
            while len(live):
                rows = todo[live]
                over = size[rows] <= t
                if over.any():  # this phrase reaches beyond the segment
                    ends[live[over]] = state[live[over]]
                    count[rows[over]] = more[live[over]]
                    live = live[~over]
                    rows = todo[live]
                    if not len(live):
                        break
                state[live], new = self._next(state[live], self.code[grid[rows, t]])
                met = new & begins[rows, t]
                count[rows[met]] = more[live[met]] + after[rows[met], t]
                more[live] += new
                live = live[~met]
                t += 1
            changed = todo[ends != end[todo]]
            end[todo] = ends
            todo = changed[changed + 1 < len(first)] + 1
            todo = todo[~first[todo]]
        return count


class CrossParser:
    """The parsers of several languages."""

    def __init__(self, texts: tuple[tuple[str, bytes], ...]):
        self.langs = [lang for lang, _ in texts]
        self.parsers = [Parser(text) for _, text in texts]

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        parts = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
        n = int(parts.sum())
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if not n:
            return out
        grid, size, first = np.zeros((n, SEGMENT), np.uint8), np.full(n, SEGMENT, np.int64), np.zeros(n, bool)
        flat, at = grid.ravel(), 0
        for t, k in zip(texts, parts.tolist()):
            if k:
                flat[at * SEGMENT : at * SEGMENT + len(t)] = np.frombuffer(t, np.uint8)
                first[at] = True
                at += k
                size[at - 1] = len(t) - (k - 1) * SEGMENT
        order = np.argsort(-size, kind="stable")  # segments that still run stay in front
        steps = np.ascontiguousarray(grid[order].T)
        running = np.searchsorted(-size[order], -np.arange(1, SEGMENT + 1), side="right")
        owner, back = np.repeat(np.arange(len(texts)), parts), np.empty(n, np.int64)
        back[order] = np.arange(n)
        for i, p in enumerate(self.parsers):
            begins, last = p.segments(steps, running)
            count = p.joined(grid, size, first, np.ascontiguousarray(begins.T[back]), last[back])
            out[:, i] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [letters(t or "") for t in texts]
        langs, scores = [], []
        for lo, hi in slices([len(c) for c in coded], AT_ONCE):
            for text, row in zip(coded[lo:hi], self.phrases(coded[lo:hi])):
                if not self.langs or not text.strip():
                    langs.append("und")
                    scores.append(0.0)
                    continue
                bits = row * np.array([p.bits for p in self.parsers])
                p = np.exp(-np.minimum((bits - bits.min()) * min(1.0, 400 / len(text)) / 8, 50))
                langs.append(self.langs[int(np.argmin(bits))])
                scores.append(float(1 / p.sum()))
        return langs, scores


@lru_cache(maxsize=1)
def _parser(texts: tuple[tuple[str, bytes], ...]) -> CrossParser:
    return CrossParser(texts)


def predict(docs: DataFrame, trained: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score) from the texts alone; the automata are built once in each Python worker."""
    texts = tuple(sorted(trained.items()))
    shared = docs.sparkSession.sparkContext.broadcast(texts)  # TRAIN_DOCS passages a language at most

    def run(batches):
        parser = _parser(shared.value)
        for batch in batches:
            langs, scores = parser.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the documents that are not held out."""
    return predict(docs, sample(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
