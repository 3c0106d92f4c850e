"""SQL text over the registered tables and the functions give the same rows in the same order."""

import pytest
from pyspark.sql import functions as F

from lexitrack.functions.text import bracketed_example
from lexitrack.operators import lookup, progress, quality, stats, study, views
from lexitrack.sources import tables
from lexitrack.testbed import bindings as b

SF = "/root/testdata/sf0.001"

OWN = "own AS (SELECT word_id, id AS own_id, marking, updated_at FROM user_markings WHERE user_id = 'u1')"


@pytest.fixture(scope="module")
def t(spark):
    class Tables:
        words, schedule = b.words(spark, SF).cache(), b.schedule(spark, SF).cache()
        markings, progress, study = b.markings(spark, SF).cache(), b.progress(spark, SF).cache(), b.study_words(spark, SF).cache()

    views.register_tables(spark, Tables.words, Tables.schedule, Tables.markings, Tables.progress)
    return Tables


def same(spark, sql, rows):
    assert [tuple(r) for r in spark.sql(sql).collect()] == [tuple(r) for r in rows.collect()]


def test_words(spark, t):
    same(spark, "SELECT level, count(id) FROM vocabulary GROUP BY ALL ORDER BY 1", stats.count_by_level(t.words))
    same(spark, "FROM vocabulary |> WHERE lower(meaning_en) LIKE ANY ('%eco%', '%ring%') |> ORDER BY id",
         lookup.search_meaning(t.words, "eco", "RING").orderBy("id"))
    with_example = t.words.filter("example_before IS NOT NULL").orderBy("id")
    same(spark, "FROM vocabulary |> WHERE isnotnull(example_before) |> ORDER BY id "
                "|> SELECT concat(example_before, '【', kanji, '】', example_after)",
         with_example.select(bracketed_example(F.col("example_before"), F.col("kanji"), F.col("example_after"))))


def test_repeated_headwords(spark, t):
    counted = "(SELECT level, kanji, count(id) AS copies FROM vocabulary GROUP BY ALL)"
    same(spark, f"SELECT kanji, level, copies FROM {counted} WHERE copies >= 2 ORDER BY copies DESC, kanji, level",
         stats.duplicate_headwords(t.words))


def test_summary(spark, t):
    of_levels = ", ".join(f"count_if(level = '{level}')" for level in ("N1", "N2", "N3"))
    same(spark, f"SELECT 'Vocabulary', count(id), {of_levels} FROM vocabulary", stats.database_summary(t.words))


def test_calendar(spark, t):
    days = "(SELECT id AS schedule_id, day, week_day_label FROM schedule WHERE week = 1)"
    same(spark, f"SELECT kanji, hiragana, meaning_en, concat(example_before, kanji, example_after), week_day_label "
                f"FROM {days} JOIN vocabulary USING (schedule_id) WHERE level = 'N1' ORDER BY day, ref_no",
         lookup.words_by_week(t.words, t.schedule, "N1", 1))
    same(spark, "FROM v_words_per_day |> WHERE week = 1 |> ORDER BY level, day",
         views.words_per_day(t.words, t.schedule).filter("week = 1").orderBy("level", "day"))


def test_progress(spark, t):
    codes = ", ".join(f"count_if(marking = {code})" for code in range(1, 6))
    share = "CAST(round(CAST(count(own_id) AS DECIMAL(20, 4)) * 100 / count(vocabulary.id), 1) AS DOUBLE)"
    same(spark, f"WITH {OWN} SELECT level, count(vocabulary.id), count(own_id), {codes}, {share} "
                "FROM own RIGHT JOIN vocabulary ON vocabulary.id = word_id GROUP BY level ORDER BY level",
         progress.progress_by_level(t.words, t.markings, "u1"))


def test_due(spark, t):
    same(spark, f"WITH {OWN} SELECT level, kanji, hiragana, meaning_en, marking, updated_at FROM own, vocabulary "
                "WHERE word_id = vocabulary.id AND marking > 2 AND updated_at < TIMESTAMP_NTZ '1998-06-28 00:00:00' "
                "ORDER BY updated_at, word_id",
         lookup.due_words(t.words, t.markings, "u1", b.AS_OF_MARKINGS))


def test_export(spark, t):
    same(spark, f"WITH {OWN} SELECT vocabulary.id, level, kanji, hiragana, meaning_en, nvl(marking, 0) "
                "FROM own RIGHT JOIN vocabulary ON vocabulary.id = word_id WHERE level = 'N1' ORDER BY 1",
         tables.vocab_with_markings_export(t.words, t.markings, "u1", "N1"))


def test_learners(spark, t):
    same(spark, "FROM user_markings |> AGGREGATE count(word_id) AS n, count_if(marking = 5) AS unknown GROUP BY user_id "
                "|> ORDER BY n DESC, user_id |> LIMIT 10",
         progress.top_markers(t.markings))
    same(spark, "SELECT * FROM user_markings WHERE NOT EXISTS (SELECT 1 FROM vocabulary WHERE id = word_id) "
                "ORDER BY user_id, word_id",
         quality.orphaned_markings(t.markings, t.words).orderBy("user_id", "word_id"))


def test_mistakes(spark, t):
    counted = ("(SELECT vocabulary_id, count(id) AS reviews, count_if(result = 'incorrect') AS mistakes "
               "FROM study_progress GROUP BY vocabulary_id)")
    same(spark, f"SELECT kanji, hiragana, reviews, mistakes FROM {counted} JOIN vocabulary ON id = vocabulary_id "
                "WHERE mistakes > 0 ORDER BY mistakes DESC, id",
         progress.frequent_wrong(t.words, t.progress))


def test_random_sql(spark, t):
    assert spark.sql("FROM v_vocabulary_full |> WHERE week = 1 |> ORDER BY rand() |> LIMIT 10").count() == 10
    assert study.random_quiz(views.vocabulary_full(t.words, t.schedule), 10, F.col("week") == 1).count() == 10
