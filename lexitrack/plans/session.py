"""One study session: pick words, record the reviews and answers, see the week's progress."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import as_of_column
from lexitrack.operators.maintain import append_progress, record_review
from lexitrack.operators.study import random_quiz
from lexitrack.operators.views import vocabulary_full


def session_words(words: DataFrame, schedule: DataFrame, week: int, n: int = 10, seed: str | int | None = None) -> DataFrame:
    """Random words of a week with their ids."""
    return random_quiz(
        vocabulary_full(words, schedule), n, F.col("week") == week, seed, ["id", "kanji", "hiragana", "meaning_en"]
    )


def finish_session(
    words: DataFrame, progress: DataFrame, answers: DataFrame, as_of: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Words and review log after a session's answers (word_id, result)."""
    clock = as_of_column(as_of)
    reviews = answers.select("word_id", clock.alias("reviewed_at"))
    entries = answers.select(
        F.col("word_id").alias("vocabulary_id"), F.to_date(clock).alias("review_date"), "result"
    )
    return record_review(words, reviews), append_progress(progress, entries, as_of)
