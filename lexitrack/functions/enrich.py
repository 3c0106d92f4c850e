"""Fields derived from the sheet's own notation: lecture, difficulty marks, word class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexitrack.functions.text import narrow_digits, remove_chars

_LECTURE = r"(?U)^(\d+)週(\d+)日"
_MARKS = "＊*+（）()"
# Endings that make an unmarked word a verb.
_VERB_ENDINGS = ("る", "す", "く", "ぐ", "む", "ぶ", "つ", "う")


def _lecture_part(lecture: Column, group: int) -> Column:
    return narrow_digits(F.regexp_extract(lecture, _LECTURE, group)).try_cast("int")


def lecture_week(lecture: Column) -> Column:
    return _lecture_part(lecture, 1)


def lecture_day(lecture: Column) -> Column:
    return _lecture_part(lecture, 2)


def difficulty(raw: Column) -> Column:
    """3 for a double star, 2 for a star or plus, else 1."""
    return (
        F.when(raw.contains("＊＊") | raw.contains("**"), 3)
        .when(raw.contains("＊") | raw.contains("*") | raw.contains("+"), 2)
        .otherwise(1)
    )


def word_type(raw: Column, meaning: Column, strict_shii: bool = False) -> Column:
    """Word class by mark, then meaning, then ending. ``strict_shii`` leaves 〜しい words unclassified."""
    bare = remove_chars(raw, _MARKS)
    last = F.right(bare, F.lit(1))
    i_adjective = (last == "い") & (F.length(bare) > 1)
    if strict_shii:
        i_adjective = i_adjective & ~bare.endswith("しい")
    return (
        F.when(raw.contains("(な)") | raw.contains("（な）"), "な-adjective")
        .when(raw.isNotNull() & F.lower(meaning).startswith("to "), "verb")
        .when(i_adjective, "い-adjective")
        .when(last.isin(*_VERB_ENDINGS), "verb")
    )
