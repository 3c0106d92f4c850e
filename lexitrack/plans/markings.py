"""Import of one learner's markings CSV into the markings table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.operators.maintain import upsert_markings
from lexitrack.operators.quality import split_by_owner


class Import(NamedTuple):
    markings: DataFrame
    rejects: DataFrame


def import_markings(stored: DataFrame, words: DataFrame, incoming: DataFrame, owner: str) -> Import:
    """The table after the upsert, and the rows left out with the reason.

    Left out are rows of another owner, rows without a word, and rows whose word does not exist.
    """
    own, foreign = split_by_owner(incoming, owner)
    known = words.select(F.col("id").alias("word_id"))
    unknown = own.join(known, "word_id", "left_anti").select(*incoming.columns)
    accepted = own.join(known, "word_id", "left_semi").select(*incoming.columns)
    reason = F.when(F.col("word_id").isNull(), "no word").otherwise("unknown word")
    rejects = foreign.withColumn("reason", F.lit("other owner")).unionByName(unknown.withColumn("reason", reason))
    return Import(upsert_markings(stored, accepted), rejects)
