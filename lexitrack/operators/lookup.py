"""Selections, searches and word lists."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import days_before, example_text, marking_label
from lexitrack.operators.views import scheduled_words

_WORD = ["kanji", "hiragana", "meaning_en"]


def example() -> Column:
    return example_text(F.col("example_before"), F.col("kanji"), F.col("example_after"))


def project_rename(words: DataFrame) -> DataFrame:
    """Word card: headword, reading, meaning, rejoined example."""
    return words.select("kanji", "hiragana", "meaning_en", example().alias("example"))


def level_filter(words: DataFrame, **equals) -> DataFrame:
    """Rows equal to the given values in all the named columns."""
    for column, value in equals.items():
        words = words.filter(F.col(column) == value)
    return words


def difficult_words(words: DataFrame, difficulty: int = 3) -> DataFrame:
    return words.filter(F.col("difficulty_level") == difficulty)


def at_least(rows: DataFrame, column: str, threshold: int) -> DataFrame:
    return rows.filter(F.col(column) >= threshold)


def never_reviewed(words: DataFrame) -> DataFrame:
    return words.filter(F.col("times_reviewed") == 0)


def with_example(words: DataFrame) -> DataFrame:
    """Words with a sentence or the text before the word."""
    return words.filter(F.col("full_sentence").isNotNull() | F.col("example_before").isNotNull())


def marked_for_review(words: DataFrame) -> DataFrame:
    return words.filter(F.col("is_marked"))


def search_kanji(words: DataFrame, term: str) -> DataFrame:
    """Case-sensitive substring of the headword."""
    return words.filter(F.col("kanji").contains(term))


def search_reading(words: DataFrame, term: str, or_kanji: str | None = None) -> DataFrame:
    """Substring of the reading, or another one of the headword."""
    hit = F.col("hiragana").contains(term)
    if or_kanji is not None:
        hit = hit | F.col("kanji").contains(or_kanji)
    return words.filter(hit)


def search_meaning(words: DataFrame, *terms: str) -> DataFrame:
    """Any of the terms in the meaning, in any case."""
    return words.filter(reduce(or_, [F.col("meaning_en").ilike(f"%{t}%") for t in terms]))


# Quiz direction -> (columns of the question, columns of the answer).
QUIZ = {
    "kanji_to_reading": (["kanji", "meaning_en"], ["hiragana"]),
    "reading_to_kanji": (["hiragana", "meaning_en"], ["kanji"]),
    "meaning_to_word": (["meaning_en"], ["kanji", "hiragana"]),
}


def quiz_cards(words: DataFrame, direction: str, keys: DataFrame | list[int]) -> DataFrame:
    """Question and answer texts of the given word ids (a short list, or a table with ``id``)."""
    question, answer = QUIZ[direction]
    if isinstance(keys, DataFrame):
        picked = words.join(keys.select("id").distinct(), "id", "left_semi")
    else:
        picked = words.filter(F.col("id").isin(keys))
    return picked.select(
        "id",
        F.concat_ws(" / ", *question).alias("question"),
        F.concat_ws(" / ", *answer).alias("answer"),
    )


def due_markings(markings: DataFrame, as_of: datetime | str | None = None, days: int = 3) -> DataFrame:
    """Markings older than ``days`` days (strictly)."""
    return markings.filter(F.col("updated_at") < days_before(as_of, days))


def row_count(rows: DataFrame, info: str) -> DataFrame:
    """One labelled count."""
    return rows.agg(F.count("*").alias("count")).select(F.lit(info).alias("info"), "count")


def words_by_week(words: DataFrame, schedule: DataFrame, level: str, week: int) -> DataFrame:
    """Cards of a level's week in study order."""
    return (
        scheduled_words(words.filter(F.col("level") == level), schedule.filter(F.col("week") == week))
        .orderBy("day", F.asc_nulls_last("ref_no"), "id")
        .select(*_WORD, example().alias("example"), "week_day_label")
    )


def words_by_day(words: DataFrame, schedule: DataFrame, week: int, day: int) -> DataFrame:
    """Cards of one calendar day in sheet order."""
    one = schedule.filter((F.col("week") == week) & (F.col("day") == day))
    return (
        scheduled_words(words, one)
        .orderBy(F.asc_nulls_last("ref_no"), "id")
        .select(*_WORD, example().alias("example"))
    )


def _marked(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """One user's marked words. (user, word) is unique, so neither side repeats a join key."""
    own = markings.filter(F.col("user_id") == user_id).select("word_id", "marking", "updated_at")
    return words.join(own, words["id"] == own["word_id"])


def user_marked_words(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """Marked words with the label of the code, hardest first."""
    return (
        _marked(words, markings, user_id)
        .orderBy(F.desc_nulls_first("marking"), "level", "id")
        .select("level", *_WORD, "marking", marking_label(F.col("marking")).alias("marking_label"))
    )


def hardest_first(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """Words with a marking above 0, hardest first."""
    return (
        _marked(words, at_least(markings, "marking", 1), user_id)
        .orderBy(F.desc("marking"), "id")
        .select("level", *_WORD, "marking")
    )


def unknown_words(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """Words marked with code 5, newest marking first."""
    return (
        _marked(words, markings.filter(F.col("marking") == 5), user_id)
        .orderBy(F.desc_nulls_first("updated_at"), "id")
        .select("level", *_WORD, "hint", "updated_at")
    )


def due_words(
    words: DataFrame, markings: DataFrame, user_id: str, as_of: datetime | str | None = None, days: int = 3
) -> DataFrame:
    """Difficult words (code 3 and up) not touched for ``days`` days, oldest first."""
    due = due_markings(at_least(markings, "marking", 3), as_of, days)
    return (
        _marked(words, due, user_id)
        .orderBy("updated_at", "id")
        .select("level", *_WORD, "marking", "updated_at")
    )


def marking_per_word(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """Every word with one user's marking row, if any. The user filter precedes the join, so no word is lost."""
    own = markings.filter(F.col("user_id") == user_id).select(
        F.col("word_id").alias("id"), F.col("id").alias("marking_id"), "marking"
    )
    return words.select("id", "level").join(own, "id", "left")


def history_for_word(words: DataFrame, progress: DataFrame, kanji: str) -> DataFrame:
    """Review log of one headword, newest first."""
    one = words.filter(F.col("kanji") == kanji).select(F.col("id").alias("vocabulary_id"), "kanji")
    return (
        progress.join(one, "vocabulary_id")
        .orderBy(F.desc("review_date"), F.desc("id"))
        .select("kanji", "review_date", "result", "notes")
    )


def words_of_users_level(words: DataFrame, markings: DataFrame, user_id: str, level: str) -> DataFrame:
    """One user's marking rows of a level's words."""
    return markings.filter(F.col("user_id") == user_id).join(
        words.filter(F.col("level") == level).select(F.col("id").alias("word_id")), "word_id", "left_semi"
    )
