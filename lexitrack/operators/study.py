"""Quizzes and review queues. Every pick is a per-task top-k and one final merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import bracketed_example, days_before, shuffle_key

_WORD = ["kanji", "hiragana", "meaning_en"]


def random_quiz(
    words: DataFrame,
    n: int = 10,
    where: Column | None = None,
    seed: str | int | None = None,
    columns: list[str | Column] | None = None,
) -> DataFrame:
    """``n`` random words, optionally of those that meet a condition. A seed makes the pick repeatable."""
    if where is not None:
        words = words.filter(where)
    picked = words.orderBy(shuffle_key(seed, F.col("id")), "id").limit(n)
    return picked.select(*(columns or _WORD))


def example_quiz(words: DataFrame, level: str, n: int = 10, seed: str | int | None = None) -> DataFrame:
    """Random words of a level that have the text before the word, shown in context."""
    context = bracketed_example(F.col("example_before"), F.col("kanji"), F.col("example_after"))
    return random_quiz(
        words, n, F.col("example_before").isNotNull() & (F.col("level") == level), seed,
        [*_WORD, context.alias("context")],
    )


def random_within_level(words: DataFrame, n: int = 10, difficulty: int = 3, seed: str | int | None = None) -> DataFrame:
    """Random difficult words, filled from the lowest level first."""
    return (
        words.filter(F.col("difficulty_level") == difficulty)
        .orderBy("level", shuffle_key(seed, F.col("id")), "id")
        .limit(n)
        .select("level", *_WORD, "hint")
    )


def due_or_new(words: DataFrame, n: int = 20, as_of: datetime | str | None = None, days: int = 3) -> DataFrame:
    """Words never reviewed, then those reviewed longest ago (over ``days`` days)."""
    last = F.col("last_reviewed")
    return (
        words.filter((last < days_before(as_of, days)) | last.isNull())
        .orderBy(F.asc_nulls_first("last_reviewed"), "id")
        .limit(n)
        .select(*_WORD, "last_reviewed")
    )


def limit_rows(rows: DataFrame, n: int, by: str | None = None) -> DataFrame:
    """Any ``n`` rows, or the first by a column."""
    return (rows if by is None else rows.orderBy(F.asc_nulls_last(by))).limit(n)
