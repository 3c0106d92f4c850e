"""The study calendar: so many weeks of seven days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS_PER_WEEK = 7
WEEKS = 11        # all levels
WEEKS_FIRST = 8   # the single-level calendar


def week_day_label(week: Column, day: Column) -> Column:
    return F.concat(week.cast("string"), F.lit("週"), day.cast("string"), F.lit("日"))


def schedule_dim(spark: SparkSession, weeks: int = WEEKS) -> DataFrame:
    """Schedule table (id, week, day, week_day_label), ids in calendar order from 1."""
    n = F.col("id").cast("int")
    week = F.floor(n / DAYS_PER_WEEK).cast("int") + 1
    day = n % DAYS_PER_WEEK + 1
    return spark.range(0, weeks * DAYS_PER_WEEK, numPartitions=1).select(
        (n + 1).alias("id"),
        week.alias("week"),
        day.alias("day"),
        week_day_label(week, day).alias("week_day_label"),
    )
