"""Learner progress reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import flag, percent
from lexitrack.operators.lookup import marking_per_word
from lexitrack.operators.views import review_counts
from lexitrack.schema import MARKING_COLUMNS


def progress_by_level(words: DataFrame, markings: DataFrame, user_id: str) -> DataFrame:
    """Per level: words, the user's marked words, a count per marking code, percent marked."""
    codes = [F.sum(flag(F.col("marking") == code)).alias(name) for code, name in MARKING_COLUMNS.items()]
    return (
        marking_per_word(words, markings, user_id)
        .groupBy("level")
        .agg(F.count("*").alias("total_words"), F.count("marking_id").alias("marked_words"), *codes)
        .withColumn("percent_marked", percent(F.col("marked_words"), F.col("total_words")))
        .orderBy("level")
    )


def weekly_progress(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """Per week: words, reviewed words, percent done (NULL for a week without words)."""
    weeks = schedule.select(F.col("id").alias("schedule_id"), "week")
    return (
        weeks.join(review_counts(words), "schedule_id", "left")
        .groupBy("week")
        .agg(
            F.coalesce(F.sum("total_words"), F.lit(0)).alias("total_words"),
            F.coalesce(F.sum("reviewed_words"), F.lit(0)).alias("reviewed"),
        )
        .withColumn("percent_done", percent(F.col("reviewed"), F.col("total_words")))
        .orderBy("week")
    )


def overall_progress(words: DataFrame) -> DataFrame:
    return words.agg(
        F.count("*").alias("total_words"),
        F.coalesce(F.sum(flag(F.col("times_reviewed") > 0)), F.lit(0)).alias("reviewed_words"),
        F.coalesce(F.sum(flag(F.col("is_marked"))), F.lit(0)).alias("marked_words"),
    ).withColumn("percent_complete", percent(F.col("reviewed_words"), F.col("total_words")))


def top_markers(markings: DataFrame, n: int = 10) -> DataFrame:
    """Users with the most markings."""
    return (
        markings.groupBy("user_id")
        .agg(F.count("*").alias("total_markings"), F.sum(flag(F.col("marking") == 5)).alias("dont_know_count"))
        .orderBy(F.desc("total_markings"), "user_id")
        .limit(n)
    )


def frequent_wrong(words: DataFrame, progress: DataFrame) -> DataFrame:
    """Words answered wrong at least once, most wrong answers first.

    The log is counted per word first, so a word with very many reviews reaches the join as one row.
    """
    counts = (
        progress.groupBy("vocabulary_id")
        .agg(F.count("*").alias("review_count"), F.sum(flag(F.col("result") == "incorrect")).alias("wrong_count"))
        .filter(F.col("wrong_count") > 0)
    )
    return (
        words.join(counts, words["id"] == counts["vocabulary_id"])
        .orderBy(F.desc("wrong_count"), "id")
        .select("kanji", "hiragana", "review_count", "wrong_count")
    )
