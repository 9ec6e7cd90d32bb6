"""Column helpers for the native operators: only built-in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of the contracts (space and U+0009 to U+000D).
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, also when body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text that is not null; no words: an empty array."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def match_spans(text: Column, pattern: str, matches: Column | None = None) -> Column:
    """array<struct<s,e,m>>: start, end (code points, end exclusive) and text of each leftmost non-overlapping match.

    The gaps between matches come from split() by the same pattern; starts are running sums of lengths.
    Matches must not be empty. A text without a match costs one pass.
    """

    def spans(found: Column) -> Column:
        def add(acc: Column, pair: Column) -> Column:
            s = acc["e"] + F.char_length(pair["gap"])
            e = s + F.char_length(pair["m"])
            return F.struct(e.alias("e"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), pair["m"].alias("m")))).alias("out"))

        none = F.array().cast("array<struct<s:int,e:int,m:string>>")
        pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
        return F.when(F.size(found) == 0, none).otherwise(F.aggregate(pairs, F.struct(F.lit(0).alias("e"), none.alias("out")), add, lambda acc: acc["out"]))

    return let(matches if matches is not None else F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
