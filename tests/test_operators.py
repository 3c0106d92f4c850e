"""Lookups, reports, maintenance, checks and stored tables on small inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexitrack.functions.text import marking_label
from lexitrack.operators import lookup, maintain, progress, quality, stats, study, views
from lexitrack.plans import session
from lexitrack.plans.markings import import_markings
from lexitrack.sources import tables
from lexitrack.sources.calendar import schedule_dim

T0 = dt.datetime(2026, 1, 18)
AS_OF = "2026-01-21 00:00:00"
MARKINGS = "id long, user_id string, word_id long, marking int, updated_at timestamp_ntz"
WORDS = (
    "id long, level string, ref_no int, kanji string, hiragana string, meaning_en string, example_before string,"
    "example_after string, hint string, full_sentence string, page_no int, schedule_id int, word_type string, difficulty_level int"
)
WORD_ROWS = [
    (1, "N1", 2, "食べる", "たべる", "To Eat", "毎日", "。", None, "毎日食べる。", 1, 1, "verb", 3),
    (2, "N1", 1, "食べ物", "たべもの", "food", None, None, None, None, 2, 1, None, 1),
    (3, "N2", 1, "高い", "たかい", "high", "", "山", "h", None, 3, 9, "い-adjective", 2),
    (4, "N3", 1, "静か", "しずか", None, None, None, None, None, None, None, "Unknown", 3),
    (5, "N3", None, "食べる", None, "great", None, None, None, None, None, 77, None, 1),
]
MARKING_ROWS = [
    (1, "a", 1, 5, T0), (2, "a", 2, 0, T0), (3, "a", 3, 3, T0 - dt.timedelta(seconds=1)), (4, "a", 4, None, T0),
    (5, "b", 1, 1, T0), (6, "b", 99, 2, T0),
]


@pytest.fixture
def words(frame):
    return frame(WORDS, WORD_ROWS)


@pytest.fixture
def study_words(words):
    reviewed = F.col("id").isin(1, 3)
    return words.withColumn("is_marked", F.when(F.col("id") != 4, F.col("id") == 1)).withColumn(
        "times_reviewed", F.when(reviewed, 2).otherwise(0)
    ).withColumn(
        "last_reviewed", F.when(F.col("id") == 1, F.lit("2026-01-18").cast("timestamp_ntz"))
        .when(F.col("id") == 3, F.lit("2026-01-01").cast("timestamp_ntz"))
    )


@pytest.fixture
def markings(frame):
    return frame(MARKINGS, MARKING_ROWS)


@pytest.fixture
def schedule(spark):
    return schedule_dim(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_words_by_week_in_study_order(words, schedule):
    got = rows(lookup.words_by_week(words, schedule, "N1", 1))
    assert got == [("食べ物", "たべもの", "food", None, "1週1日"), ("食べる", "たべる", "To Eat", "毎日食べる。", "1週1日")]
    assert [r[0] for r in rows(lookup.words_by_day(words, schedule, 1, 1))] == ["食べ物", "食べる"]


def test_searches(words):
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(lookup.search_kanji(words, "食")) == [1, 2, 5]
    assert ids(lookup.search_reading(words, "たべ")) == [1, 2]
    assert ids(lookup.search_reading(words, "たか", or_kanji="静")) == [3, 4]
    assert ids(lookup.search_meaning(words, "eat", "FOOD")) == [1, 2, 5]
    assert ids(lookup.level_filter(words, level="N1", ref_no=1)) == [2]
    assert ids(lookup.with_example(words)) == [1, 3]


def test_quiz_by_list_and_table(spark, words):
    by_list = rows(lookup.quiz_cards(words, "kanji_to_reading", [1]))
    keys = spark.createDataFrame([(1,), (1,)], "id long")
    assert by_list == rows(lookup.quiz_cards(words, "kanji_to_reading", keys)) == [(1, "食べる / To Eat", "たべる")]


def test_views(words, schedule, study_words):
    assert len(rows(views.vocabulary_full(words, schedule))) == 5
    assert rows(views.words_per_day(words, schedule)) == [
        ("N1", "1週1日", 1, 1, 2), ("N2", "2週2日", 2, 2, 1), ("N3", "11週7日", 11, 7, 1)]
    days = rows(views.words_per_day_all(words, schedule))
    assert len(days) == 77 and sum(d[3] for d in days) == 4
    assert rows(views.study_summary(study_words, schedule, week=1))[:2] == [("1週1日", 2, 1, 1), ("1週2日", 0, 0, 0)]


def test_registered_views(spark, words, study_words, schedule):
    views.register_views(spark, words, schedule)
    assert spark.sql("SELECT sum(total_words) FROM v_level_summary").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM v_vocabulary_full WHERE week IS NULL").first()[0] == 1
    views.register_views(spark, study_words.drop("level"), schedule)
    assert spark.sql("SELECT count(*) FROM v_words_per_day").first()[0] == 77
    assert spark.sql("SELECT sum(reviewed_words) FROM v_study_summary").first()[0] == 2


def test_marked_words_hardest_first(words, markings):
    got = rows(lookup.user_marked_words(words, markings, "a"))
    assert [r[4] for r in got] == [None, 5, 3, 0]
    assert [r[5] for r in got] == [None, "❌ Dont know at all", "✍ Cant write", None]
    assert [r[4] for r in rows(lookup.hardest_first(words, markings, "a"))] == [5, 3]


def test_due_is_strict(words, markings):
    assert [r[1] for r in rows(lookup.due_words(words, markings, "a", AS_OF))] == ["高い"]
    assert {r["id"] for r in lookup.due_markings(markings, "2026-01-21 00:00:01").collect()} == {1, 2, 3, 4, 5, 6}


def test_marking_label(spark):
    c = spark.range(7).select(marking_label(F.col("id"))).collect()
    assert [r[0] is None for r in c] == [True, False, False, False, False, False, True]


def test_progress_by_level_keeps_unmarked_words(words, markings):
    assert rows(progress.progress_by_level(words, markings, "b")) == [
        ("N1", 2, 1, 1, 0, 0, 0, 0, 50.0), ("N2", 1, 0, 0, 0, 0, 0, 0, 0.0), ("N3", 2, 0, 0, 0, 0, 0, 0, 0.0)]


def test_review_progress(study_words, schedule):
    weeks = {r[0]: r[1:] for r in rows(progress.weekly_progress(study_words, schedule))}
    assert weeks[1] == (2, 1, 50.0) and weeks[3] == (0, 0, None) and len(weeks) == 11
    assert rows(progress.overall_progress(study_words)) == [(5, 2, 1, 40.0)]
    assert rows(progress.overall_progress(study_words.filter("id > 9"))) == [(0, 0, 0, None)]


def test_distributions(words):
    got = rows(stats.type_distribution(words, by_level=False))
    assert sorted(got) == sorted([("Unknown", 2), ("Unknown", 1), ("verb", 1), ("い-adjective", 1)])
    assert rows(stats.difficulty_distribution(words)) == [("Normal", 2), ("Medium (＊)", 1), ("Hard (＊＊)", 2)]
    assert rows(stats.duplicate_headwords(words)) == []
    assert rows(stats.duplicate_headwords(words.unionAll(words).unionAll(words.filter("id = 4"))))[0] == ("静か", "N3", 3)
    assert rows(stats.database_summary(words)) == [("Vocabulary", 5, 2, 1, 2)]


def test_top_and_wrong(frame, words, markings):
    assert rows(progress.top_markers(markings)) == [("a", 4, 1), ("b", 2, 0)]
    log = frame("id long, vocabulary_id long, review_date date, result string, notes string, created_at timestamp_ntz", [
        (i, w, dt.date(2026, 1, i + 1), r, None, T0) for i, (w, r) in enumerate(
            [(1, "incorrect"), (1, "correct"), (3, "correct"), (2, "incorrect"), (2, "incorrect"), (None, "incorrect")])])
    assert rows(progress.frequent_wrong(words, log)) == [("食べ物", "たべもの", 2, 2), ("食べる", "たべる", 2, 1)]
    assert [r[1].day for r in rows(lookup.history_for_word(words, log, "食べる"))] == [2, 1]


def test_random_picks_repeat_with_a_seed(words):
    first = rows(study.random_quiz(words, 3, seed=1))
    assert first == rows(study.random_quiz(words, 3, seed=1)) and len(first) == 3
    assert len(rows(study.random_quiz(words, 3))) == 3
    assert len(rows(study.limit_rows(words, 2))) == 2
    assert [r[0] for r in rows(study.random_within_level(words, 2, 3, seed=4))] == ["N1", "N3"]
    assert rows(study.example_quiz(words, "N1", seed=1)) == [("食べる", "たべる", "To Eat", "毎日【食べる】。")]


def test_due_or_new_puts_new_words_first(study_words):
    got = rows(study.due_or_new(study_words, 20, AS_OF))
    assert [r[3] for r in got] == [None, None, None, dt.datetime(2026, 1, 1)]
    assert len(rows(study.due_or_new(study_words, 2, AS_OF))) == 2


# Maintenance

def test_upsert(frame, markings):
    incoming = frame("user_id string, word_id long, marking int, updated_at timestamp_ntz", [
        ("a", 1, 2, T0 - dt.timedelta(days=9)),  # older than the stored row, and still the newer word on it
        ("a", 7, 1, T0), ("a", 7, 4, T0 + dt.timedelta(days=1)),
        ("b", 1, None, None),
    ])
    got = {(r["user_id"], r["word_id"]): r for r in maintain.upsert_markings(markings, incoming).collect()}
    assert len(got) == 7
    assert (got["a", 1]["marking"], got["a", 1]["id"], got["a", 1]["updated_at"]) == (2, 1, T0 - dt.timedelta(days=9))
    assert got["a", 7]["marking"] == 4 and got["a", 7]["id"] >= 1 << 60
    assert (got["b", 1]["marking"], got["b", 1]["id"]) == (None, 5)
    assert got["a", 3]["marking"] == 3


def test_upsert_twice_is_upsert_once(frame, markings):
    incoming = frame(MARKINGS, [(11, "a", 1, 2, T0), (12, "c", 1, 2, T0), (13, "c", 1, 3, T0)])
    once = maintain.upsert_markings(markings, incoming)
    twice = maintain.upsert_markings(once, incoming)
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice)))
    assert rows(quality.check_unique(once, ("user_id", "word_id"))) == []


def test_bulk_mark_and_reset(words, markings, schedule):
    marked = maintain.bulk_mark_week(markings, words, schedule, "a", "N1", 1, 1, AS_OF)
    mine = {r["word_id"]: r["marking"] for r in marked.filter("user_id = 'a'").collect()}
    assert mine == {1: 1, 2: 1, 3: 3, 4: None}
    left = maintain.reset_level(marked, words, "a", "N1")
    assert rows(lookup.user_marked_words(words.filter("level = 'N1'"), left, "a")) == []
    assert left.filter("user_id = 'b'").count() == 2


def test_reset_keeps_rows_of_nobody(frame, words):
    markings = frame(MARKINGS, [(1, "a", 1, 5, T0), (2, None, 1, 5, T0), (3, "b", 1, 5, T0), (4, "a", None, 5, T0)])
    assert sorted(r["id"] for r in maintain.reset_level(markings, words, "a", "N1").collect()) == [2, 3, 4]


def test_flags(frame, study_words):
    flags = lambda df: {r["id"]: r["is_marked"] for r in df.collect()}
    assert flags(maintain.set_flag(study_words, "食べる")) == {1: True, 2: False, 3: False, 4: None, 5: True}
    changes = frame("kanji string, is_marked boolean, changed_at timestamp_ntz", [
        ("食べる", True, T0), ("食べる", False, T0 + dt.timedelta(1)), ("静か", True, T0), ("無い", True, T0)])
    assert flags(maintain.set_flags(study_words, changes)) == {1: False, 2: False, 3: False, 4: True, 5: False}


def test_record_review(frame, study_words):
    reviews = frame("word_id long, reviewed_at timestamp_ntz", [(1, T0 - dt.timedelta(1)), (1, T0 - dt.timedelta(2)), (2, T0)])
    got = {r["id"]: (r["times_reviewed"], r["last_reviewed"]) for r in maintain.record_review(study_words, reviews).collect()}
    assert got[1] == (4, T0) and got[2] == (1, T0) and got[4] == (0, None)


def test_study_session(frame, study_words, schedule):
    log = frame("id long, vocabulary_id long, review_date date, result string, notes string, created_at timestamp_ntz", [
        (1, 1, dt.date(2026, 1, 1), "correct", "n", T0)])
    picked = session.session_words(study_words, schedule, 1, seed=3)
    assert picked.columns == ["id", "kanji", "hiragana", "meaning_en"] and picked.count() == 2
    after, entries = session.finish_session(study_words, log, frame("word_id long, result string", [(2, "incorrect")]), AS_OF)
    assert {r["id"]: r["times_reviewed"] for r in after.collect()}[2] == 1
    assert {(r["vocabulary_id"], r["result"], r["notes"]) for r in entries.collect()} == {(1, "correct", "n"), (2, "incorrect", None)}


def test_defaults_only_for_absent_columns(frame):
    got = maintain.apply_defaults(frame("user_id string, marking int", [("a", None)]), "user_markings", AS_OF).first()
    assert got["marking"] is None and got["updated_at"] == dt.datetime(2026, 1, 21)
    assert maintain.apply_defaults(frame("user_id string", [("a",)]), "user_markings").first()["marking"] == 0


# Checks

def test_checks(frame, words, markings):
    assert dict(rows(quality.check_not_null(words, ("level", "hiragana")))) == {"level": 0, "hiragana": 1}
    assert rows(quality.check_unique(words, ("kanji", "hiragana"))) == []
    assert rows(quality.check_unique(words, ("kanji",))) == [("食べる", 2)]
    assert dict(rows(quality.check_length(words, {"kanji": 2, "level": 5}))) == {"kanji": 3, "level": 0}
    assert rows(quality.check_foreign_key(markings, "word_id", words)) == [("word_id", 1)]
    progress_log = frame("vocabulary_id long", [(None,), (1,)])
    assert rows(quality.check_foreign_key(progress_log, "vocabulary_id", words)) == [("vocabulary_id", 0)]
    assert rows(quality.orphaned_markings(markings, words)) == [(6, "b", 99, 2, T0)]
    own, other = quality.split_by_owner(markings, "a")
    assert own.count() == 4 and other.count() == 2 == markings.count() - quality.owner_scope(markings, "a").count()


def test_length_counts_characters(frame):
    assert rows(quality.check_length(frame("kanji string", [("𠮷𠮷",)]), {"kanji": 2})) == [("kanji", 0)]


# Stored tables

def test_markings_csv_round_trip(spark, words, markings, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_csv(tables.markings_export(markings, "a"), path)
    back = tables.read_markings_csv(spark, path)
    assert sorted(map(str, rows(back))) == sorted(map(str, [r[1:] for r in MARKING_ROWS if r[1] == "a"]))


def test_markings_import_with_rejects(spark, words, markings, tmp_path):
    (tmp_path / "in.csv").write_text(
        "user_id,word_id,marking,updated_at\na,1,1,2026-01-18\na,5,5,2026-01-19 08:30:00\nb,2,2,2026-01-18\na,50,2,2026-01-18\na,,2,2026-01-18\n")
    result = import_markings(markings, words, tables.read_markings_csv(spark, str(tmp_path / "in.csv")), "a")
    got = {(r["user_id"], r["word_id"]): (r["marking"], r["updated_at"]) for r in result.markings.collect()}
    assert got["a", 1] == (1, T0) and got["a", 5] == (5, dt.datetime(2026, 1, 19, 8, 30)) and len(got) == 7
    assert {(r["word_id"], r["reason"]) for r in result.rejects.collect()} == {
        (2, "other owner"), (50, "unknown word"), (None, "no word")}


def test_markings_csv_goes_by_column_name(spark, tmp_path):
    (tmp_path / "in.csv").write_text("word_id,user_id,note\n1,a,x\n")
    got = tables.read_markings_csv(spark, str(tmp_path / "in.csv"), AS_OF).collect()
    assert [tuple(r) for r in got] == [("a", 1, 0, dt.datetime(2026, 1, 21))]
    (tmp_path / "bad.csv").write_text("word,user_id\n1,a\n")
    with pytest.raises(ValueError, match="word_id"):
        tables.read_markings_csv(spark, str(tmp_path / "bad.csv"))


def test_upsert_rewrites_only_the_buckets_it_touches(spark, frame, markings, tmp_path):
    path = tmp_path / "markings"
    many = frame(MARKINGS, [(i, f"u{i}", 1, 1, T0) for i in range(40)])
    tables.write_markings(many, str(path), buckets=4)

    def files():
        return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}

    before = files()
    tables.upsert_into(spark, str(path), frame(MARKINGS, [(None, "u7", 1, 5, T0), (None, "u7", 2, 3, T0)]))
    changed = {f.split("/")[1] for f in before ^ files()}
    assert len(changed) == 1 and tables.bucket_count(spark, str(path)) == 4
    stored = tables.read_markings(spark, str(path))
    assert stored.count() == 41
    got = {r["word_id"]: (r["marking"], r["id"]) for r in tables.read_markings(spark, str(path), "u7").collect()}
    assert got[1] == (5, 7) and got[2][0] == 3 and got[2][1] > 1 << 59
    tables.write_markings(many, str(path), buckets=2)
    assert tables.bucket_count(spark, str(path)) == 2 and tables.read_markings(spark, str(path)).count() == 40


def test_a_rewrite_that_fails_leaves_the_table(spark, frame, tmp_path):
    path = str(tmp_path / "markings")
    tables.write_markings(frame(MARKINGS, [(1, "a", 1, 1, T0), (2, "b", 2, 1, T0)]), path, buckets=2)
    old = rows(tables.read_markings(spark, path))
    broken = F.when(F.col("user_id") == "a", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("marking"))
    with pytest.raises(Exception, match="lost"):
        tables.rewrite_user(spark, path, "a", lambda r: r.withColumn("marking", broken))
    assert rows(tables.read_markings(spark, path)) == old
    tables.upsert_into(spark, path, frame(MARKINGS, []))
    assert rows(tables.read_markings(spark, path)) == old


def test_empty_markings_can_be_stored(spark, frame, tmp_path):
    path = str(tmp_path / "markings")
    tables.write_markings(frame(MARKINGS, []), path, buckets=3)
    assert tables.read_markings(spark, path).count() == 0
    tables.upsert_into(spark, path, frame(MARKINGS, [(9, "a", 1, 1, T0)]))
    assert [r["id"] for r in tables.read_markings(spark, path, "a").collect()] == [9]


def test_rewrite_may_empty_a_bucket(spark, frame, words, tmp_path):
    path = str(tmp_path / "markings")
    tables.write_markings(frame(MARKINGS, [(1, "a", 1, 1, T0), (2, "a", 2, 1, T0)]), path, buckets=2)
    tables.rewrite_user(spark, path, "a", lambda r: maintain.reset_level(r, words, "a", "N1"))
    assert tables.read_markings(spark, path).count() == 0


def test_exports_keep_their_order(spark, words, markings, tmp_path):
    tables.write_lines(tables.anki_export(words).filter("anki_format is not null"), str(tmp_path / "anki"))
    lines = "".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / "anki").glob("part-*"))).splitlines()
    assert lines == ["食べ物\tたべもの - food", "高い\tたかい - high", "食べる\tたべる - To Eat"]
    assert [r[3] for r in rows(tables.example_export(words))] == ["高い山", "毎日食べる。"]
    got = rows(tables.vocab_with_markings_export(words, markings, "b", "N1"))
    assert [(r[0], r[5]) for r in got] == [(1, 1), (2, 0)]


def test_vocabulary_table(spark, words, tmp_path):
    tables.write_vocabulary(words, str(tmp_path / "v"))
    assert {d.name for d in (tmp_path / "v").glob("level=*")} == {"level=N1", "level=N2", "level=N3"}
    assert tables.read_vocabulary(spark, str(tmp_path / "v")).count() == 5
