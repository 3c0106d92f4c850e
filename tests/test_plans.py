"""Plans of the registered queries, and runs with a hot key where no side may be broadcast."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from lexitrack.testbed import bindings as b
from lexitrack.operators import lookup, maintain, quality, study, views
from lexitrack.plans import ingest
from lexitrack.sources import tables
from lexitrack.sources.calendar import schedule_dim

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    """Of the study operators: those of the optional subpackage have styles of their own and tests beside theirs."""
    return {name: plan(query(spark, SF)) for name, query in e.queries().items() if name not in e._llm_queries()}


def test_no_python_and_no_cross_join(plans):
    for name, text in plans.items():
        tree = text.split("\n\n\n")[0]
        assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", tree), name


def test_windows_only_number_the_calendar(plans):
    """One window numbers the binding's 25 nations, one sums the rows of partitions (a row each); no operator sends a whole
    group to one task."""
    for name, text in plans.items():
        for window in re.findall(r"\(\d+\) Window.*?\n\n", text, re.S):
            assert "n_regionkey" in window or "of_part" in window, name


def test_calendar_is_broadcast(plans):
    for name in ("words_by_week", "vocabulary_full", "words_per_day", "page_and_schedule", "left_then_not_null"):
        assert "BroadcastHashJoin" in plans[name] and "SortMergeJoin" not in plans[name], name


def test_picks_are_top_k(plans):
    for name, text in plans.items():
        if name.startswith("random_") and name != "random_key" or name in ("top_markers", "nulls_first_due", "limit_rows"):
            assert "TakeOrderedAndProject" in text, name


def test_scans_read_few_columns(plans):
    assert "ReadSchema: struct<p_type:string>" in plans["count_by_level"]
    assert "ReadSchema: struct<l_partkey:bigint>" in plans["check_foreign_key"]
    assert "p_retailprice" not in plans["level_filter"]


def test_user_filter_goes_below_the_upsert(plans):
    tree = plans["owner_scope"].split("\n\n\n")[0]
    assert tree.rindex("SortAggregate") < tree.index("Filter") < tree.index("Scan parquet")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    tables.write_vocabulary(b.words(spark, SF), root + "/words")
    tables.write_markings(b.markings(spark, SF), root + "/markings")
    return root


def test_stored_words_are_pruned_and_filtered_in_the_scan(spark, stored):
    words = tables.read_vocabulary(spark, stored + "/words")
    hard = plan(lookup.difficult_words(lookup.level_filter(words, level="N1")).select("kanji"))
    assert re.search(r"PartitionFilters: \[[^\n]*level#\d+ = N1", hard)
    assert "EqualTo(difficulty_level,3)" in hard and "ReadSchema: struct<kanji:string,difficulty_level:int>" in hard
    quiz = plan(study.random_quiz(words, 10, F.col("level") == "N1", 1))
    assert "TakeOrderedAndProject" in quiz and "example_before" not in quiz


def test_one_users_markings_open_one_folder(spark, stored):
    own = plan(lookup.user_marked_words(
        tables.read_vocabulary(spark, stored + "/words"), tables.read_markings(spark, stored + "/markings", "u1"), "u1"))
    assert re.search(r"PartitionFilters: \[[^\n]*bucket#\d+ = \d+", own)
    assert "EqualTo(user_id,u1)" in own


def test_upsert_reads_only_touched_folders(spark, stored):
    batch = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "user_id string")
    numbers = tables.buckets_of(batch)
    assert len(numbers) == 2 and all(0 <= n < tables.BUCKETS for n in numbers)
    rows = tables.read_buckets(spark, stored + "/markings", numbers)
    filters = re.search(r"PartitionFilters: \[[^\n]*bucket#\d+ IN \(([\d,]+)\)", plan(rows)).group(1)
    assert {int(n) for n in filters.split(",")} == set(numbers)


def test_split_is_one_narrow_stage(plans):
    for name in ("split_sentence", "examples_or_fallback", "insert_script_export"):
        assert "Exchange" not in plans[name], name


def test_database_summary_scans_once(plans):
    assert plans["database_summary"].count("Location: ") == 1


# A hot key: a third of the rows, joined by shuffle only.

N = 60_000


@pytest.fixture
def shuffle_only(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=N):
    """Rows 0..n-1 in eight partitions with a key that is 7 for every third row."""
    return spark.range(0, n, 1, 8).withColumn("key", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))


def test_hot_calendar_day(spark, shuffle_only):
    words = hot(spark).select(
        "id", F.col("key").cast("int").alias("schedule_id"), F.lit("N1").alias("level"),
        F.repeat(F.col("id").cast("string"), F.lit(5)).alias("kanji"))
    full = views.scheduled_words(words, schedule_dim(spark))
    assert full.count() == N // 3 + sum(1 for i in range(1, 78) if i % 3)
    per_day = {r["schedule_id"]: r["n"] for r in full.groupBy("schedule_id").agg(F.count("*").alias("n")).collect()}
    assert per_day[7] == N // 3 + 1


def test_hot_word_in_markings(spark, shuffle_only):
    markings = hot(spark).select(
        "id", F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.col("key").alias("word_id"),
        F.lit(1).alias("marking"), F.lit("2026-01-18").cast("timestamp_ntz").alias("updated_at"))
    no_seven = spark.range(100).filter("id <> 7")
    assert quality.orphaned_markings(markings, no_seven).count() == N - sum(1 for i in range(100) if i % 3 and i != 7)
    assert quality.check_foreign_key(markings, "word_id", no_seven).first()["violations"] == N - sum(
        1 for i in range(100) if i % 3 and i != 7)


def test_hot_key_in_change_log_shrinks_before_the_shuffle(spark):
    log = spark.range(0, N, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("user_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("word_id"),
        (F.col("id") % 6).cast("int").alias("marking"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("updated_at"))
    newest = maintain.latest_markings(log)
    text = plan(newest)
    assert text.index("partial_max") and "Window" not in text
    got = newest.filter("user_id = 'hot'").first()
    assert (got["id"], got["marking"]) == (0, (N - 3) % 6)
    assert newest.select("user_id", "word_id").distinct().count() == newest.count()


def test_hot_headword_with_forms(spark, shuffle_only):
    rows = hot(spark).select(
        F.col("id").cast("string").alias("Sr no"),
        F.when(F.col("key") == 7, "愛する").otherwise(F.concat(F.lit("語"), F.col("id"))).alias("Kanji"),
        F.lit("彼を愛している").alias("Sentence"), F.lit(None).cast("string").alias("Supporting word 1"),
        F.lit(None).cast("string").alias("Supporting word 2"))
    tokens = spark.createDataFrame([("愛する", "愛し")] * 3, "word string, form string")
    out = ingest.examples(ingest.with_forms(rows, ingest.lemma_forms(tokens)))
    got = {r["matched"]: r["n"] for r in out.groupBy("matched").agg(F.count("*").alias("n")).collect()}
    assert got == {"愛し": N // 3 + 1, None: N - N // 3 - 1}


def test_hot_keys_split_a_skewed_join(spark, shuffle_only):
    words = hot(spark, 300_000).select(
        F.col("key").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("kanji"))
    marks = spark.range(0, 1000, 1, 2).select(F.col("id").alias("word_id"), F.lit("a").alias("user_id"), F.lit(1).alias("marking"),
                                             F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    joined = lookup._marked(words, marks, "a").select("kanji", "marking")
    rows = joined.collect()
    assert len(rows) == 100_000 + sum(1 for i in range(1000) if i % 3)
    assert "skew" in plan(joined).lower()


def test_a_word_with_a_million_forms(spark, shuffle_only):
    """Forms are rows: none of the word's forms are gathered in a list, and the longest one in the sentence is found."""
    forms = spark.range(0, 1_000_000, 1, 8).select(F.lit("愛する").alias("word"), F.concat(F.lit("愛"), F.col("id")).alias("form"))
    rows = spark.range(0, 200, 1, 4).select(
        F.col("id").cast("string").alias("Sr no"), F.lit("愛する").alias("Kanji"),
        F.concat(F.lit("彼を愛"), F.col("id") * 1000, F.lit("た")).alias("Sentence"),
        F.lit(None).cast("string").alias("Supporting word 1"), F.lit(None).cast("string").alias("Supporting word 2"))
    joined = ingest.with_forms(rows, ingest.lemma_forms(forms))
    got = {r["Sr no"]: r["matched"] for r in ingest.examples(joined).collect()}
    assert got == {str(i): f"愛{i * 1000}" for i in range(200)}
    assert "collect_set" not in plan(joined) and "collect_list" not in plan(joined)


def test_forms_of_equal_length_go_by_order(spark, frame):
    rows = frame("`Sr no` string, Kanji string, Sentence string", [("1", "足す", "bbaa"), ("2", "足す", None), ("3", "無", "aa")])
    forms = ingest.lemma_forms(frame("word string, form string", [("足す", "bb"), ("足す", "aa"), ("足す", "a"), (None, "aa")]))
    assert {r["Sr no"]: r["forms"] for r in ingest.with_forms(rows, forms).collect()} == {"1": ["aa"], "2": None, "3": None}


def test_a_table_is_checked_in_one_scan(spark, frame, tmp_path):
    path = str(tmp_path / "log")
    frame("id long, user_id string, word_id long", [(1, "a", 1), (1, "a", 1), (2, None, 1), (3, None, 1), (None, "b", None), (None, "c", 2)]).write.parquet(path)
    report = quality.check_table(spark.read.parquet(path), "user_markings")
    assert sorted(tuple(r) for r in report.collect()) == sorted([
        ("not null", "user_id", 2), ("not null", "word_id", 1), ("unique", "id", 1), ("unique", "user_id, word_id", 1)])
    assert plan(quality.check_table(spark.read.parquet(path), "user_markings")).split("\n\n\n")[0].count("Scan parquet") == 1
    empty = quality.check_table(spark.read.parquet(path).limit(0), "user_markings")
    assert [r["violations"] for r in empty.collect()] == [0] * 4
