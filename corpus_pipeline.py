"""A corpus through five stages: language, near copies, benchmark passages, personal data, token ids.

Every stage takes all rows that the one before kept and returns the columns of documents, the last one token ids. Rows
are written to the shared folder between stages, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.llm import byte_bpe, decontaminate, jaccard_join, language_id, pii
from lexitrack.llm.common import held_out, importable, table
from lexitrack.session import shared_dir


def _same(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[f"`{c}`" for c in docs.columns])


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: null texts and texts without a letter go. The model learns from the rows themselves; where
    no row has a language, nothing is known about any text, and all stay."""
    importable(spark)
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    found = language_id.predict(docs, model, out="__language")
    return _same(found.filter(F.col("__language.lang") != language_id.UNKNOWN), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one of the smallest id, once. Others stay as they are.

    What goes is named by (doc_id, hashes of the text), null-safe, and so joined with the documents. Of documents of one
    id, or of none, in a component the one of the smallest hash stays.
    """
    importable(spark)
    found = jaccard_join.components_of(docs)
    names = [f"__row_{c}" for c in jaccard_join.ROW]
    found = found.select(*[F.col(c).alias(n) for c, n in zip(jaccard_join.ROW, names, strict=True)], "first")
    gone = found.filter(~F.col("first")).select(*names).distinct()
    twice = found.filter("first").groupBy(*names).count().filter(F.col("count") > 1).select(*names)
    if gone.count() <= jaccard_join.BROADCAST_ROWS:
        gone = F.broadcast(gone)
    own = [c.alias(f"__own_{n}") for c, n in zip(jaccard_join.row_key(F.col("doc_id"), F.col("text")), names, strict=True)]
    rows = docs.select("*", *own)
    same = [F.col(f"__own_{n}").eqNullSafe(F.col(n)) for n in names]
    kept = rows.join(gone, same, "left_anti")
    if twice.isEmpty():
        return _same(kept, docs)
    once = kept.join(twice, same, "left_semi").dropDuplicates([f"__own_{n}" for n in names])
    return _same(kept.join(twice, same, "left_anti").unionByName(once), docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), out="__benchmark")
    return _same(found.filter(~decontaminate.contaminated(F.col("__benchmark"))), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts generalised to its kind; n_chars counts the new text."""
    found = pii.find(docs, out="__spans")
    clean = found.withColumn("text", pii.masked(F.col("text"), F.col("__spans")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return _same(clean, docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, and how many."""
    importable(spark)
    found = byte_bpe.encode(docs, out="__ids")
    return found.select("doc_id", "lang", "source", F.col("__ids").alias("ids"), F.size("__ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language_id", with_language),
    ("jaccard_join", without_near_copies),
    ("decontaminate", without_benchmarks),
    ("pii", without_personal_data),
    ("byte_bpe", token_ids),
]

#: No SQL: models, components and token ids can't be expressed in it. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
