"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, branches, jaccard, langid, lines, lm, packing, pii, quality, repeats, secrets, whiten
from .common import table


def default_tokenizer() -> str:
    """The byte-level vocabulary file that the machine offers; any other path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    tokenizer = tokenizer or default_tokenizer()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(bpe.decode(bpe.encode(docs, tokenizer), tokenizer))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_lm(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op12_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branches.report(table(spark, sf_dir, "documents"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_repeats": op2_repeats,
        "op3_secrets": op3_secrets,
        "op4_langid": op4_langid,
        "op5_pii": op5_pii,
        "op6_neighbours": op6_neighbours,
        "op7_quality": op7_quality,
        "op8_lm": op8_lm,
        "op9_jaccard": op9_jaccard,
        "op10_packing": op10_packing,
        "op11_whiten": op11_whiten,
        "op12_merge": op12_merge,
        "op13_lines": op13_lines,
    }


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
