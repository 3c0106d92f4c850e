"""The standing views over words and schedule.

The schedule is one row per calendar day. No join forces a broadcast: Spark broadcasts it when its size is under
``spark.sql.autoBroadcastJoinThreshold`` and joins by a shuffle beyond that, where AQE splits skewed days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.functions.text import flag

_DAY = ["week", "day", "week_day_label"]
_FULL = [
    "id", "level", "ref_no", "kanji", "hiragana", "meaning_en", "example_before", "example_after",
    "full_sentence", "hint", "page_no", "word_type", "difficulty_level",
]
_REVIEW = ["is_marked", "times_reviewed", "last_reviewed"]


def _days(schedule: DataFrame) -> DataFrame:
    return schedule.select(F.col("id").alias("schedule_id"), *_DAY)


def vocabulary_full(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """Words with their calendar day; words without one stay."""
    columns = [c for c in _FULL + _REVIEW if c in words.columns]
    return words.join(_days(schedule), "schedule_id", "left").select(*columns, *_DAY)


def scheduled_words(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """Words that have a calendar day, with all their columns."""
    return words.join(_days(schedule), "schedule_id")


def level_summary(words: DataFrame) -> DataFrame:
    return (
        words.groupBy("level")
        .agg(
            F.count("*").alias("total_words"),
            F.count(F.when(F.col("full_sentence").isNotNull(), 1)).alias("words_with_sentences"),
        )
        .orderBy("level")
    )


def words_per_day(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """Word count per level and calendar day. Words are counted per day before they meet the calendar."""
    counts = (
        words.filter(F.col("schedule_id").isNotNull())
        .groupBy("level", "schedule_id").agg(F.count("*").alias("word_count"))
    )
    return (
        counts.join(_days(schedule), "schedule_id")
        .select("level", "week_day_label", "week", "day", "word_count")
        .orderBy("level", "week", "day")
    )


def words_per_day_all(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """Word count per calendar day, empty days with 0."""
    counts = words.groupBy("schedule_id").agg(F.count("*").alias("n"))
    return (
        _days(schedule).join(counts, "schedule_id", "left")
        .select("week_day_label", "week", "day", F.coalesce("n", F.lit(0)).alias("word_count"))
        .orderBy("week", "day")
    )


def review_counts(words: DataFrame) -> DataFrame:
    """Per calendar day: words, marked words, reviewed words."""
    return words.groupBy("schedule_id").agg(
        F.count("*").alias("total_words"),
        F.sum(flag(F.col("is_marked"))).alias("marked_words"),
        F.sum(flag(F.col("times_reviewed") > 0)).alias("reviewed_words"),
    )


def study_summary(words: DataFrame, schedule: DataFrame, week: int | None = None) -> DataFrame:
    """Per calendar day: words, marked words, reviewed words; empty days with zeros."""
    days = _days(schedule)
    if week is not None:
        days = days.filter(F.col("week") == week)
    zero = F.lit(0)
    return (
        days.join(review_counts(words), "schedule_id", "left")
        .orderBy("week", "day")
        .select(
            "week_day_label",
            *[F.coalesce(c, zero).alias(c) for c in ("total_words", "marked_words", "reviewed_words")],
        )
    )


def register_tables(
    spark: SparkSession,
    words: DataFrame,
    schedule: DataFrame,
    markings: DataFrame | None = None,
    progress: DataFrame | None = None,
) -> None:
    """Tables and views under their SQL names, for queries written as SQL text."""
    named = {"vocabulary": words, "schedule": schedule, "user_markings": markings, "study_progress": progress}
    for name, rows in named.items():
        if rows is not None:
            rows.createOrReplaceTempView(name)
    register_views(spark, words, schedule)


def register_views(spark: SparkSession, words: DataFrame, schedule: DataFrame) -> None:
    """Temp views for SQL users. The review summary exists only where words carry review state."""
    vocabulary_full(words, schedule).createOrReplaceTempView("v_vocabulary_full")
    if "level" in words.columns:
        level_summary(words).createOrReplaceTempView("v_level_summary")
        words_per_day(words, schedule).createOrReplaceTempView("v_words_per_day")
    else:
        words_per_day_all(words, schedule).createOrReplaceTempView("v_words_per_day")
    if "times_reviewed" in words.columns:
        study_summary(words, schedule).createOrReplaceTempView("v_study_summary")
