"""Ids as a sequence gives them: one for every inserted row, whatever its cells hold."""

import datetime as dt

from pyspark.sql import functions as F

from lexitrack.operators import maintain
from lexitrack.operators.numbering import numbered, placed
from lexitrack.plans import ingest
from lexitrack.schema import STUDY_PROGRESS, VOCABULARY

DAY = dt.date(2024, 1, 28)


def test_entries_that_differ_in_null_and_empty_get_ids_of_their_own(spark, frame):
    log = spark.createDataFrame([(41, 1, DAY, "correct", None, None)], STUDY_PROGRESS)
    entries = frame("vocabulary_id long, review_date date, result string, notes string", [
        (1, DAY, "correct", None), (1, DAY, "correct", ""), (1, DAY, "correct", None), (1, DAY, "correct", "-"), (None, DAY, "correct", "0:")])
    after = maintain.append_progress(log, entries, "2024-01-28 12:00:00").collect()
    ids = [r["id"] for r in after]
    assert len(set(ids)) == 6 and min(ids) == 41 and sorted(ids)[1] == 42


def test_given_ids_stay(spark, frame):
    log = spark.createDataFrame([], STUDY_PROGRESS)
    entries = frame("id long, vocabulary_id long, review_date date", [(7, 1, DAY), (None, 2, DAY), (None, 3, DAY)], 1)
    got = {r["vocabulary_id"]: r["id"] for r in maintain.append_progress(log, entries).collect()}
    assert got[1] == 7 and min(got[2], got[3]) > 7 and got[2] != got[3]
    assert maintain.append_progress(log, entries.limit(0)).count() == 0


def word(**cells):
    return tuple(cells.get(f.name) if f.nullable else cells.get(f.name, "x") for f in VOCABULARY.fields)


def test_words_that_differ_in_null_and_empty_get_ids_of_their_own(spark):
    rows = [word(id=5, hint=None), word(id=5, hint=""), word(id=5, hint=""), word(id=9), word(id=None), word(id=None)]
    words = spark.createDataFrame(rows, VOCABULARY).repartition(3)
    got = ingest.distinct_ids(words)
    ids = [r["id"] for r in got.collect()]
    assert got.columns == words.columns and len(set(ids)) == 6 and None not in ids
    assert 9 in ids and 5 not in ids and min(ids) == 9
    assert ingest.distinct_ids(words.limit(0)).count() == 0


def test_names_are_told_apart(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("-", "x"), ("1:a", ""), ("a", "0:")], "u string, w string")
    assert rows.select(maintain.row_id("u", "w").alias("id")).distinct().count() == 7


def test_numbers_follow_the_rows(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).filter(F.col("id") % 3 != 0).select((F.col("id") * 2).alias("x"), (F.col("id") % 2).alias("first"))
    placed(rows).write.parquet(str(tmp_path / "t"))
    got = numbered(spark.read.parquet(str(tmp_path / "t")), "n", start=10).orderBy("x").collect()
    assert [r["n"] for r in got] == list(range(10, 10 + len(got))) and got[0].asDict().keys() == {"x", "first", "n"}
    ordered = rows.select(F.when(F.col("x") % 5 > 0, F.col("x") % 5).alias("g"), "x").repartitionByRange(4, "g", "x").sortWithinPartitions("g", "x")
    placed(ordered).write.parquet(str(tmp_path / "g"))
    per_group = numbered(spark.read.parquet(str(tmp_path / "g")), "n", within=("g",)).collect()
    for g in {r["g"] for r in per_group}:
        own = sorted((r["x"], r["n"]) for r in per_group if r["g"] == g)
        assert [n for _, n in own] == list(range(len(own)))
