"""Counts and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.conjugation import TILDE
from lexitrack.functions.enrich import lecture_week
from lexitrack.functions.text import difficulty_label, percent, strip


def count_total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total_words"))


def count_by_level(words: DataFrame) -> DataFrame:
    return words.groupBy("level").agg(F.count("*").alias("count")).orderBy("level")


def sentence_coverage(words: DataFrame) -> DataFrame:
    return (
        words.groupBy("level")
        .agg(F.count("*").alias("total"), F.count("full_sentence").alias("with_sentence"))
        .withColumn("without_sentence", F.col("total") - F.col("with_sentence"))
        .orderBy("level")
    )


def type_distribution(words: DataFrame, by_level: bool = True) -> DataFrame:
    """Words per word class. The groups are those of the raw class, so a class named Unknown stays apart."""
    keys = ["level"] if by_level else []
    return (
        words.groupBy(*keys, "word_type").agg(F.count("*").alias("count"))
        .orderBy(*keys, F.desc("count"), F.asc_nulls_last("word_type"))
        .select(*keys, F.coalesce("word_type", F.lit("Unknown")).alias("type"), "count")
    )


def difficulty_distribution(words: DataFrame) -> DataFrame:
    return (
        words.groupBy("difficulty_level").agg(F.count("*").alias("count"))
        .orderBy(F.asc_nulls_last("difficulty_level"))
        .select(difficulty_label(F.col("difficulty_level")).alias("difficulty"), "count")
    )


def duplicate_headwords(words: DataFrame) -> DataFrame:
    return (
        words.groupBy("kanji", "level").agg(F.count("*").alias("count"))
        .filter(F.col("count") > 1)
        .orderBy(F.desc("count"), "kanji", "level")
    )


def database_summary(words: DataFrame, levels: tuple[str, ...] = ("N1", "N2", "N3")) -> DataFrame:
    """One row: all words and a count per level, from one scan."""
    per_level = [F.count_if(F.col("level") == v).alias(f"{v.lower()}_count") for v in levels]
    counts = words.agg(F.count("*").alias("total_rows"), *per_level)
    return counts.select(F.lit("Vocabulary").alias("table_name"), *counts.columns)


def split_stats(enriched: DataFrame) -> DataFrame:
    """Per level: sentences, successful splits, splits whose tail begins with the ending sign, percent split."""
    has_sentence = strip(F.col("full_sentence")) != ""
    split = has_sentence & F.col("matched").isNotNull()
    return (
        enriched.groupBy("level")
        .agg(
            F.count_if(has_sentence).alias("total_with_sentence"),
            F.count_if(split).alias("auto_generated"),
            F.count_if(split & F.col("example_after").startswith(TILDE)).alias("conjugation_preserved"),
        )
        .withColumn("percent_split", percent(F.col("auto_generated"), F.col("total_with_sentence")))
        .orderBy("level")
    )


def week_histogram(sheet: DataFrame) -> DataFrame:
    """Sheet rows per week of the lecture note."""
    return (
        sheet.select(lecture_week(F.col("Lecture")).alias("week"))
        .filter(F.col("week").isNotNull() & (F.col("week") != 0))
        .groupBy("week").agg(F.count("*").alias("count"))
        .orderBy("week")
    )


def import_verify(words: DataFrame, schedule: DataFrame) -> DataFrame:
    """After a load: rows in total, with examples, per level and per calendar week (empty weeks with 0).

    The words are scanned once and counted per (level, day); the report rows are sums of those counts.
    """
    counts = words.groupBy("level", "schedule_id").agg(
        F.count("*").alias("n"), F.count("example_before").alias("examples")
    )
    days = schedule.select(F.col("id").alias("schedule_id"), "week")

    def line(check, item, value):
        return F.struct(F.lit(check).alias("check"), item.alias("item"), value.alias("value"))

    lines = counts.join(days, "schedule_id", "left").select(F.explode(F.array(
        line("total", F.lit(""), F.col("n")),
        line("with_examples", F.lit(""), F.col("examples")),
        line("level", F.col("level"), F.col("n")),
        line("week", F.col("week").cast("string"), F.col("n")),
    )).alias("r")).select("r.*").filter(F.col("item").isNotNull())
    empty = days.select(line("week", F.col("week").cast("string"), F.lit(0).cast("long")).alias("r")).select("r.*")
    return lines.unionByName(empty).groupBy("check", "item").agg(F.sum("value").alias("value")).orderBy("check", "item")
