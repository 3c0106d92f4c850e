"""Stored tables: partitioned writes, rewrites of single folders and the ordered exports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexitrack.functions.text import example_text
from lexitrack.operators.maintain import apply_defaults, upsert_markings
from lexitrack.schema import MARKINGS_CSV, USER_MARKINGS

BUCKETS = 256

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_vocabulary(words: DataFrame, path: str) -> None:
    """The enriched table, one folder per level. No shuffle: every task writes its own rows."""
    words.write.mode("overwrite").partitionBy("level").parquet(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def user_bucket(user_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(user_id), F.lit(buckets)).cast("int")


_STORED = T.StructType([*USER_MARKINGS.fields, T.StructField("buckets", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


def _write(markings: DataFrame, path: str, buckets: int, overwrite: str) -> None:
    """Rows into ``buckets=<number of folders>/bucket=<folder>``.

    Rebalancing splits the folder of a user with very many rows over several tasks and files. Rows are sorted by user,
    so a read of one user skips the row groups of others.
    """
    (
        markings.withColumn("buckets", F.lit(buckets)).withColumn("bucket", user_bucket(F.col("user_id"), buckets))
        .hint("rebalance", "bucket").sortWithinPartitions("bucket", "user_id", "word_id")
        .write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy("buckets", "bucket").parquet(path)
    )


def write_markings(markings: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Markings in folders by a hash of the user, so one user's read opens one folder. What is at ``path`` is replaced."""
    _write(markings, path, buckets, "static")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(path)


def bucket_count(spark: SparkSession, path: str) -> int:
    """The number of folders a stored table was dealt into, as its folders' names say."""
    found = _stored(spark, path).select("buckets").first()
    return found[0] if found else BUCKETS


def read_buckets(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """The stored markings of some folders; files of others are not read."""
    return _stored(spark, path).filter(F.col("bucket").isin(sorted(numbers))).drop("buckets", "bucket")


def read_markings(spark: SparkSession, path: str, user_id: str | None = None) -> DataFrame:
    """The stored markings, or one user's, from that user's folder."""
    if user_id is None:
        return _stored(spark, path).drop("buckets", "bucket")
    own = buckets_of(spark.range(1).select(F.lit(user_id).alias("user_id")), bucket_count(spark, path))
    return read_buckets(spark, path, own).filter(F.col("user_id") == user_id)


def buckets_of(rows: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The folder numbers of the rows' users: at most ``buckets`` numbers."""
    return [r[0] for r in rows.select(user_bucket(F.col("user_id"), buckets)).distinct().collect()]


def upsert_into(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """Upsert a batch into stored markings: only the folders of the batch's users are read, and replaced when the job ends.

    Spark's dynamic partition overwrite writes them beside the table first, so a job that fails leaves it as it was. One
    writer at a time.
    """
    buckets = bucket_count(spark, path)
    incoming = incoming.persist()
    try:
        stored = read_buckets(spark, path, buckets_of(incoming, buckets))
        _write(upsert_markings(stored, incoming), path, buckets, "dynamic")
    finally:
        incoming.unpersist()


def rewrite_user(spark: SparkSession, path: str, user_id: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the folder that holds one user's rows by ``change`` of its rows, which may leave none; as in an upsert."""
    buckets = bucket_count(spark, path)
    (own,) = buckets_of(spark.range(1).select(F.lit(user_id).alias("user_id")), buckets)
    after = change(read_buckets(spark, path, [own])).persist(StorageLevel.DISK_ONLY)
    try:
        if after.isEmpty():  # a dynamic overwrite would leave the folder alone
            nothing = spark.createDataFrame([], USER_MARKINGS)
            nothing.write.mode("overwrite").parquet(f"{path}/buckets={buckets}/bucket={own}")
        else:
            _write(after, path, buckets, "dynamic")
    finally:
        after.unpersist()


# Exports. A global sort writes part files whose names follow the order of the rows.

def markings_export(markings: DataFrame, user_id: str) -> DataFrame:
    """One user's markings in CSV column order."""
    return (
        markings.filter(F.col("user_id") == user_id)
        .select(*MARKINGS_CSV.fieldNames())
        .orderBy(F.asc_nulls_last("word_id"))
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; timestamps as text with all their digits."""
    texts = [F.col(n).cast("string").alias(n) if t.startswith("timestamp") else F.col(n) for n, t in rows.dtypes]
    rows.select(*texts).write.mode("overwrite").options(**_CSV).csv(path)


def read_markings_csv(spark: SparkSession, path: str, as_of: datetime | str | None = None) -> DataFrame:
    """Markings CSV by column name, in any order; ``updated_at`` may be a date or a timestamp.

    Without a ``marking`` or ``updated_at`` column the declared defaults hold. The files of a folder must have
    the same header.
    """
    rows = spark.read.options(**_CSV).option("enforceSchema", False).csv(path)
    missing = {"user_id", "word_id"} - set(rows.columns)
    if missing:
        raise ValueError(f"{path} lacks {sorted(missing)}")
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MARKINGS_CSV.fields if f.name in rows.columns]
    return apply_defaults(rows.select(*typed), "user_markings", as_of).select(*MARKINGS_CSV.fieldNames())


def anki_export(words: DataFrame) -> DataFrame:
    """Flashcard lines: headword, tab, reading and meaning, in sheet order."""
    card = F.concat("kanji", F.lit("\t"), "hiragana", F.lit(" - "), "meaning_en")
    return words.orderBy(F.asc_nulls_last("ref_no"), "id").select(card.alias("anki_format"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def example_export(words: DataFrame) -> DataFrame:
    """Words with an example: the whole sentence, else the rejoined halves."""
    rejoined = example_text(F.col("example_before"), F.col("kanji"), F.col("example_after"))
    return (
        words.filter(F.col("full_sentence").isNotNull() | F.col("example_before").isNotNull())
        .orderBy(F.asc_nulls_last("ref_no"), "id")
        .select("kanji", "hiragana", "meaning_en", F.coalesce("full_sentence", rejoined).alias("example"))
    )


def vocab_with_markings_export(words: DataFrame, markings: DataFrame, user_id: str, level: str) -> DataFrame:
    """All words of a level with one user's marking, 0 where there is none."""
    own = markings.filter(F.col("user_id") == user_id).select("word_id", "marking")
    v = words.filter(F.col("level") == level).withColumnRenamed("id", "word_id")
    return (
        v.join(own, "word_id", "left")
        .select("word_id", "level", "kanji", "hiragana", "meaning_en", F.coalesce("marking", F.lit(0)).alias("marking"))
        .orderBy("word_id")
    )
