"""Quality rules with adaptive thresholds from mergeable quantile sketches (native).

Each (lang, source) group gets KLL sketches of its documents' features; the quantiles of a group are
bent towards those of the merge of all sketches by how few rows it has. A document that no base rule
rejects is rejected when a feature lies far outside its group's quartiles. Nothing but DataFrame functions runs here.

Defined cases: null or blank text has no words and fails the base rules; null lang or source forms
a group of its own; repeated rows are judged alike; an empty table gives an empty result; extra
columns pass through filter_quality() and are dropped by judge().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed
from .sqlkit import SPACE_CHARS, let, words

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Features with (side, room): a value is rejected beyond the group's quartiles by more than FENCE times its own middle
#: half (which a quarter of junk cannot move) and `room`, what short clean texts need.
FEATURES = {"mean_word": ("both", 0.75), "symbol_rate": ("high", 0.1), "dup_line_rate": ("high", 0.2), "repeat_rate": ("high", 0.1)}
FENCE = 3.0
#: A group of n rows bends its quantiles towards those of all rows by the weight PRIOR / (n + PRIOR).
PRIOR = 100.0
SKETCH_K = 800
#: Groups (about 100 bytes each) that may be broadcast; with more, the thresholds are joined by shuffle.
BROADCAST_GROUPS = 50_000
GRAM = 5


def _repeat_words(w: Column) -> Column:
    """Words inside 5-word windows that the text holds at least twice."""

    def covered(h: Column) -> Column:
        keyed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def of(z: Column) -> Column:
            twin = F.filter(z, lambda x, i: (F.get(z, i - 1)["h"] == x["h"]) | (F.get(z, i + 1)["h"] == x["h"]))
            at = F.array_sort(F.transform(twin, lambda x: x["p"]))
            step = lambda acc, p: F.struct(
                (p + GRAM).alias("end"), (acc["n"] + p + GRAM - F.greatest(p, acc["end"])).alias("n")
            )
            return F.aggregate(at, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(keyed, of))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(w, i, GRAM)))
    return F.when(F.size(w) <= GRAM, F.lit(0)).otherwise(let(hashes, covered))


def features(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """docs with a struct column _q, the base counts and base_failed of each whole text, and the group's columns _l and _src."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    n_lines = let(lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    counts = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    raw = F.struct(
        counts.alias("w"), n_lines.alias("l"),
        F.char_length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )

    def derived(q: Column) -> Column:
        n = q["w"]["n_words"]
        some = F.greatest(n, F.lit(1))
        return F.struct(
            n.alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"),
            q["l"]["dup"].cast("long").alias("n_dup_lines"), q["w"]["n_repeat_words"].alias("n_repeat_words"),
            ((n < 10) | (100 * q["w"]["n_repeat_words"] > 20 * n)).alias("base_failed"),
            (q["word_chars"] / some).alias("mean_word"), (q["n_symbols"] / some).alias("symbol_rate"),
            (q["l"]["dup"] / F.greatest(q["l"]["all"], F.lit(1))).alias("dup_line_rate"), (q["w"]["n_repeat_words"] / some).alias("repeat_rate"),
        )

    # one struct column keeps clashing names of extra columns apart; one expression is never inlined field by field
    return docs.withColumns({"_q": let(raw, derived), "_l": F.col(lang_col), "_src": F.col(source_col)})


def _quantiles(sketch: Column) -> Column:
    """The quartiles of a sketch; null where it is empty."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(F.lit(0.25), F.lit(0.75))))


def thresholds(feats: DataFrame) -> DataFrame:
    """(lang, source, _t): the accepted range of each feature, a row per group.

    Sketches are built map-side per group and merged; the merge of all groups (one row of eight
    numbers) comes to the driver.
    """
    ok = ~F.col("_q.base_failed")  # a condition inside the aggregates: a filter would evaluate the features once more
    sketches = feats.groupBy("_l", "_src").agg(F.count_if(ok).alias("n"), *(F.kll_sketch_agg_double(F.when(ok, F.col(f"_q.{f}")), SKETCH_K).alias(f) for f in FEATURES))
    sketches = checkpointed(sketches)  # sketches draw random bits: they are made once
    every = sketches.agg(*(F.kll_merge_agg_double(f, SKETCH_K).alias(f) for f in FEATURES)).select(*(_quantiles(F.col(f)).alias(f) for f in FEATURES)).first()
    own, out = F.col("n") / (F.col("n") + PRIOR), []
    for f, (side, room) in FEATURES.items():
        fall = [float(x) for x in (every[f] or [0.0] * 2)]
        q1, q3 = (F.coalesce(F.get(_quantiles(F.col(f)), F.lit(i)) * own + F.lit(x) * (1 - own), F.lit(x)) for i, x in enumerate(fall))
        wide = (q3 - q1) * FENCE + room
        out += [(q1 - wide if side == "both" else F.lit(float("-inf"))).alias(f"{f}_lo"), (q3 + wide).alias(f"{f}_hi")]
    return sketches.select(F.col("_l").alias("_lang"), F.col("_src").alias("_source"), F.struct(*out).alias("_t"))


def _within() -> Column:
    """Whether nothing speaks against a document. One sum, so that no part of it is evaluated below the join again."""
    against = F.coalesce(F.col("_q.base_failed").cast("int"), F.lit(1))
    for f in FEATURES:
        ok = F.col(f"_q.{f}").between(F.col(f"_t.{f}_lo"), F.col(f"_t.{f}_hi"))
        against = against + F.coalesce((~ok).cast("int"), F.lit(0))
    return against == 0


def _judged(feats: DataFrame, limits: DataFrame) -> DataFrame:
    """Thresholds joined to the documents: broadcast while the groups are few, else Spark joins them and splits hot groups."""
    limits = checkpointed(limits)
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    return feats.join(limits, feats["_l"].eqNullSafe(limits["_lang"]) & feats["_src"].eqNullSafe(limits["_source"]), "left").withColumn("_kept", _within())


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for each document."""
    feats = checkpointed(features(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return _judged(feats, thresholds(feats)).select("doc_id", *(F.col(f"_q.{c}").alias(c) for c in base), F.col("_kept").alias("kept"))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    narrow = features(docs.select("lang", "source", "text")).drop("text")
    names = [f"_c{i}" for i in range(len(docs.columns))]  # the caller's names come back at the end
    wide = features(docs.toDF(*names), *(names[docs.columns.index(c)] for c in ("text", "lang", "source")))
    return _judged(wide, thresholds(narrow)).where("_kept").select(*names).toDF(*docs.columns)
