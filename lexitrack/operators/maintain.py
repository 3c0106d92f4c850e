"""Table maintenance as table -> table transformations.

The upsert keeps one row per key by a max over an ordering struct. That is an aggregate, so the change log of a
hot key shrinks to one row per task before the shuffle; a window would send the whole key to one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import as_of_column
from lexitrack.operators.numbering import numbered, placed
from lexitrack.schema import DEFAULTS, NOW, STUDY_PROGRESS
from lexitrack.session import shared_dir

_KEY = ["user_id", "word_id"]


def latest_markings(log: DataFrame) -> DataFrame:
    """One row per (user, word) from a change log: the newest code and time under the first row's id.

    Rows count by ``batch`` (if the log has one), then time, then id, then code.
    """
    by_batch = ["batch"] if "batch" in log.columns else []
    newest = F.max(F.struct(*by_batch, "updated_at", "id", "marking"))
    first = F.min(F.struct(*by_batch, F.col("id").isNull().alias("no_id"), "id"))["id"] if by_batch else F.min("id")
    return (
        log.groupBy(*_KEY).agg(newest.alias("latest"), first.alias("id"))
        .select("id", *_KEY, "latest.marking", "latest.updated_at")
    )


def row_id(*columns: str) -> Column:
    """An id from the columns that name a row, the same in every run and above any id that counts rows.

    Values stand with their lengths and NULL as a mark of its own, so different names never give one text. The id has 60
    bits of that text's digest: two of a hundred million new names share one with a chance of one in two hundred.
    """
    def named(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.conv(F.substring(F.md5(F.concat(*[named(c) for c in columns])), 1, 15), 16, 10).cast("long") + F.lit(1 << 60)


def serial_ids(rows: DataFrame, above: int = 0, folder: str | None = None) -> DataFrame:
    """The rows, those without an id with the next ones above ``above`` and above all ids here, in the order of the rows.

    The rows are stored once and numbered by the counts of their partitions; none is shuffled or compared. Like a
    sequence, numbers may leave gaps.
    """
    spark = rows.sparkSession
    folder = folder or shared_dir(spark, "serial")
    placed(rows).write.parquet(folder)
    stored = spark.read.parquet(folder)
    used = stored.agg(F.max("id")).first()[0]
    start = max(above, used if used is not None else above) + 1
    return numbered(stored, "__number", start=start).withColumn("id", F.coalesce("id", "__number")).select(*rows.columns)


def upsert_markings(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert or overwrite on (user, word). An incoming row beats the stored one and keeps its id; a new row without
    an id gets one from its key."""
    if "id" not in incoming.columns:
        incoming = incoming.withColumn("id", F.lit(None).cast("long"))
    columns = ["id", *_KEY, "marking", "updated_at"]
    log = stored.select(*columns, F.lit(0).alias("batch")).unionByName(
        incoming.select(*columns, F.lit(1).alias("batch"))
    )
    return latest_markings(log).withColumn("id", F.coalesce("id", row_id(*_KEY)))


def week_markings(
    words: DataFrame, schedule: DataFrame, user_id: str, level: str, week: int, marking: int,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """One marking row for every word of a level's week."""
    days = schedule.filter(F.col("week") == week).select(F.col("id").alias("schedule_id"))
    return (
        words.filter(F.col("level") == level).join(days, "schedule_id", "left_semi")
        .select(
            F.lit(user_id).alias("user_id"), F.col("id").alias("word_id"),
            F.lit(marking).alias("marking"), as_of_column(as_of).alias("updated_at"),
        )
    )


def bulk_mark_week(
    markings: DataFrame, words: DataFrame, schedule: DataFrame, user_id: str, level: str, week: int, marking: int = 1,
    as_of: datetime | str | None = None,
) -> DataFrame:
    """The markings after marking a whole week with one code."""
    return upsert_markings(markings, week_markings(words, schedule, user_id, level, week, marking, as_of))


def reset_level(markings: DataFrame, words: DataFrame, user_id: str, level: str) -> DataFrame:
    """The markings without one user's rows of a level; rows of nobody stay. One scan, one anti join."""
    of_level = words.filter(F.col("level") == level).select(
        F.lit(user_id).alias("gone_user"), F.col("id").alias("gone_word")
    )
    gone = (F.col("user_id") == F.col("gone_user")) & (F.col("word_id") == F.col("gone_word"))
    return markings.join(of_level, gone, "left_anti")


def set_flag(words: DataFrame, kanji: str, marked: bool = True) -> DataFrame:
    """Set the attention flag of every word with the headword."""
    return words.withColumn(
        "is_marked", F.when(F.col("kanji") == kanji, F.lit(marked)).otherwise(F.col("is_marked"))
    )


def set_flags(words: DataFrame, changes: DataFrame) -> DataFrame:
    """Set flags from a table (kanji, is_marked, changed_at); the newest change of a headword counts."""
    newest = changes.groupBy("kanji").agg(
        F.max(F.struct("changed_at", "is_marked")).alias("c")
    ).select("kanji", F.col("c.is_marked").alias("changed"))
    return (
        words.join(newest, "kanji", "left")
        .withColumn("is_marked", F.coalesce("changed", "is_marked"))
        .select(*words.columns)
    )


def record_review(words: DataFrame, reviews: DataFrame) -> DataFrame:
    """Add a batch of reviews (word_id, reviewed_at) to the words' counters.

    The batch is counted per word first, so a word reviewed very often reaches the join as one row.
    """
    counts = reviews.groupBy(F.col("word_id").alias("id")).agg(
        F.count("*").cast("int").alias("new_reviews"), F.max("reviewed_at").alias("newest")
    )
    return (
        words.join(counts, "id", "left")
        .withColumn("times_reviewed", F.col("times_reviewed") + F.coalesce("new_reviews", F.lit(0)))
        .withColumn("last_reviewed", F.greatest("last_reviewed", "newest"))
        .select(*words.columns)
    )


def apply_defaults(rows: DataFrame, table: str, as_of: datetime | str | None = None) -> DataFrame:
    """Add the declared defaults for absent columns. A present NULL stays NULL."""
    for column, value in DEFAULTS[table].items():
        if column not in rows.columns:
            default: Column = as_of_column(as_of) if value is NOW else F.lit(value)
            rows = rows.withColumn(column, default)
    return rows


def append_progress(
    progress: DataFrame, entries: DataFrame, as_of: datetime | str | None = None, folder: str | None = None
) -> DataFrame:
    """The review log with new entries; absent columns get their default or NULL.

    Entries without an id get the next ids above all that are there, in their order.
    """
    entries = apply_defaults(entries, "study_progress", as_of)
    for f in STUDY_PROGRESS.fields:
        if f.name not in entries.columns:
            entries = entries.withColumn(f.name, F.lit(None).cast(f.dataType))
    used = progress.agg(F.max("id")).first()[0]
    return progress.unionByName(serial_ids(entries.select(*STUDY_PROGRESS.fieldNames()), used or 0, folder))
