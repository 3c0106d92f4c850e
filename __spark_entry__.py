
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from lexitrack.functions import text
from lexitrack.functions.conjugation import CURRENT, FIRST, INTERIM
from lexitrack.functions.enrich import difficulty, lecture_day, lecture_week, word_type
from lexitrack.functions.split import candidate_forms, split_sentence
from lexitrack.operators import lookup, maintain, progress, quality, stats, study, views
from lexitrack.plans import ingest, session
from lexitrack.plans.markings import import_markings
from lexitrack.schema import MAX_LENGTHS, NOT_NULL
from lexitrack.session import shared_dir
from lexitrack.sources import calendar, scripts, sheets, tables
from lexitrack.testbed import bindings as b
from lexitrack.testbed import oracle

try:
    import corpus_pipeline
    from lexitrack.llm import queries as llm
except ImportError:  # the library works without that subpackage
    corpus_pipeline = llm = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"
SEED = 7


# Sheets ---------------------------------------------------------------------------------------------------------

_SHEET = [
    "sr_no", "kanji", "raw", "hiragana", "meaning", "hint", "sentence", "supporting_1", "supporting_2", "page_no", "lecture",
]
_LEVELS = ("N1", "N2", "N3")


def _valid(spark, d):
    return sheets.valid_rows(sheets.conform_schema(b.sheet(spark, d)))


def _enriched(spark, d, variant=CURRENT):
    return ingest.enrich(_valid(spark, d), variant)


_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _titled_sheet(rows, level, path, line=lambda text: text, titles=(b.TITLE,)):
    """Sheet files of one level, title lines and the header on top of each; ``line`` may change a row's text."""
    cells = [c for c in rows.columns if c != "level"]
    text = line(F.to_csv(F.struct(*[f"`{c}`" for c in cells]), _CSV))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of a task, so of a file
    titles = [t + "," * (len(cells) - 1) for t in titles]
    top = F.concat(F.lit("\n".join([*titles, ",".join(cells), ""])), text)
    rows = rows if level is None else rows.filter(F.col("level") == level)
    rows.select(F.when(first, top).otherwise(text)).write.text(path)


def read_sheet(spark, d):
    """The sheet below a title line, with one row that has the title's cells."""
    path = shared_dir(spark, "sheet")
    alike = spark.range(1).select(F.lit(b.TITLE).alias("Sr no"))
    _titled_sheet(b.sheet(spark, d).unionByName(alike, allowMissingColumns=True), None, path)
    return sheets.read_sheet(spark, path).drop(sheets.BAD_ROW).toDF(*_SHEET)


def read_sheet_titles(spark, d):
    """The sheet below two title lines and the header, with rows that equal each of the three."""
    path, rows = shared_dir(spark, "sheet"), b.sheet(spark, d).drop("level")
    titles = (b.TITLE, "Words")
    cells = [*[(t, *[None] * (len(rows.columns) - 1)) for t in titles], tuple(rows.columns)]
    alike = spark.createDataFrame(cells, ", ".join(f"`{c}` string" for c in rows.columns))
    _titled_sheet(rows.unionByName(alike), None, path, titles=titles)
    return sheets.read_sheet(spark, path, header_row=2).drop(sheets.BAD_ROW).toDF(*_SHEET)


def read_sheet_line_breaks(spark, d):
    """The sheet below a title of two lines; every hint has quotes, commas and line breaks behind it."""
    path, rows = shared_dir(spark, "sheet"), b.sheet(spark, d)
    rows = rows.withColumn("Hint", F.concat("Hint", F.lit('\n"'), "Raw", F.lit('",\n\nSr no,Kanji')))
    _titled_sheet(rows, None, path, titles=(f'"{b.TITLE}\nof all levels"',))
    return sheets.read_sheet(spark, path, multi_line=True).drop(sheets.BAD_ROW).toDF(*_SHEET)


def load_levels(spark, d):
    root = shared_dir(spark, "levels")
    b.sheet(spark, d).write.options(header=True, **_CSV).partitionBy("level").csv(root)
    paths = {level: f"{root}/level={level}" for level in (*_LEVELS, "N4")}  # there is no N4 sheet
    return sheets.load_levels(spark, paths, header_row=0).toDF(*_SHEET, "level")


def load_rejects(spark, d):
    """The rows of one source have a cell too many: their number, as it stands in the rejected text."""
    root, rows = shared_dir(spark, "rejects"), b.sheet(spark, d)
    wide = F.col("`Supporting word 1`") == f"before {b.WIDE_SOURCE}"
    for level in _LEVELS:
        _titled_sheet(rows, level, f"{root}/{level}", lambda text: F.when(wide, F.concat(text, F.lit(",x"))).otherwise(text))
    rejects = sheets.load_rejects(spark, {level: f"{root}/{level}" for level in _LEVELS})
    return rejects.select("level", F.substring_index(sheets.BAD_ROW, ",", 1).alias("sr_no"))


def valid_rows(spark, d):
    return sheets.valid_rows(b.sheet(spark, d)).drop("level").toDF(*_SHEET)


def conform_schema(spark, d):
    short = b.sheet(spark, d).select("Sr no", "Raw", "Meaning", "Sentence")
    wide = sheets.conform_schema(short)
    return sheets.valid_rows(wide).select(
        F.col("Sr no").alias("sr_no"), F.col("Kanji").alias("kanji"), F.col("Hiragana").alias("hiragana"),
        F.col("Meaning").alias("meaning"), F.col("Hint").alias("hint"), F.col("Sentence").alias("sentence"),
        F.col("Supporting word 1").alias("supporting_1"), F.col("`Page no.`").alias("page_no"),
        F.col("Lecture").alias("lecture"),
    )


def schedule_dim(spark, d):
    """The calendar with the number of sheet rows that name each day."""
    named = b.sheet(spark, d).groupBy(
        lecture_week(F.col("Lecture")).alias("week"), lecture_day(F.col("Lecture")).alias("day")
    ).agg(F.count("*").alias("n"))
    days = calendar.schedule_dim(spark)
    return days.join(named, ["week", "day"], "left").select(
        "id", "week", "day", "week_day_label", F.coalesce("n", F.lit(0)).alias("sheet_rows")
    )


# Scripts, tables and exports ------------------------------------------------------------------------------------

def vocab_sink(spark, d):
    path = shared_dir(spark, "vocabulary")
    words = ingest.ingest(_valid(spark, d), b.schedule(spark, d), as_of=b.AS_OF_REVIEWS)
    tables.write_vocabulary(ingest.distinct_ids(words), path)
    return tables.read_vocabulary(spark, path)


def distinct_ids(spark, d):
    """Every sheet row twice: as many ids as rows."""
    rows = _valid(spark, d)
    words = ingest.distinct_ids(ingest.ingest(rows.unionByName(rows), b.schedule(spark, d), as_of=b.AS_OF_REVIEWS))
    return words.agg(F.count("*").alias("words"), F.count_distinct("id").alias("ids"))


def distinct_ids_null_and_empty(spark, d):
    """Every sheet row three times: as it is, with an empty hint for a missing one, and with an empty hint and no number."""
    rows = _valid(spark, d)
    filled = rows.withColumn("Hint", F.coalesce("Hint", F.lit("")))
    unnumbered = filled.withColumn("Sr no", F.lit("none"))
    words = ingest.distinct_ids(ingest.ingest(
        rows.unionByName(filled).unionByName(unnumbered), b.schedule(spark, d), as_of=b.AS_OF_REVIEWS))
    bare = F.coalesce(F.col("hint"), F.lit("")) == ""
    return words.agg(
        F.count("*").alias("words"), F.count_distinct("id").alias("ids"), F.count_if(bare).alias("without_hint"),
        F.count_distinct(F.when(bare, F.col("id"))).alias("ids_without_hint"),
    )


def append_progress_ids(spark, d):
    """The review log with its entries again, their notes missing, empty, and missing once more: as many ids as entries."""
    log = b.progress(spark, d)
    entries = log.drop("id", "notes")
    notes = F.explode(F.array(F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("string"))).alias("notes")
    after = maintain.append_progress(log, entries.select("*", notes), b.AS_OF_REVIEWS)
    return after.agg(F.count("*").alias("entries"), F.count_distinct("id").alias("ids"))


def _script_round_trip(variant, with_level):
    def run(spark, d):
        stored, path = shared_dir(spark, "enriched"), shared_dir(spark, "script")
        _enriched(spark, d, variant).write.parquet(stored)
        scripts.write_script(spark.read.parquet(stored), path, with_level)
        return scripts.read_script(spark, path, with_level)

    return run


def insert_script_awkward(spark, d):
    """A script whose texts hold separators of tuples, ends of statements, comments and line breaks."""
    stored, path = shared_dir(spark, "enriched"), shared_dir(spark, "script")
    hint = F.concat("hint", F.lit("),\n    ('N1', 2,\n)\n;\n-- it's\n"))
    _enriched(spark, d).withColumn("hint", hint).write.parquet(stored)
    scripts.write_script(spark.read.parquet(stored), path)
    return scripts.read_script(spark, path)


def markings_import(spark, d):
    """One learner exports the markings, raises every code by one, and imports the file."""
    path = shared_dir(spark, "markings")
    stored = b.markings(spark, d)
    edited = tables.markings_export(stored, b.USER).withColumn("marking", (F.col("marking") + 1) % 6).withColumn(
        "updated_at", text.as_of_column(b.AS_OF_MARKINGS)
    )
    tables.write_csv(edited, path)
    return import_markings(stored, b.words(spark, d), tables.read_markings_csv(spark, path), b.USER).markings


def anki_export(spark, d):
    path = shared_dir(spark, "anki")
    tables.write_lines(tables.anki_export(b.words(spark, d)), path)
    return spark.read.text(path).withColumnRenamed("value", "anki_format")


def upsert_into_table(spark, d):
    """The later half of the change log, upserted into a stored table of the earlier half."""
    path = shared_dir(spark, "marking-table")
    log = b.marking_log(spark, d)
    cut = text.as_of_column(b.AS_OF_MARKINGS)
    tables.write_markings(maintain.latest_markings(log.filter(F.col("updated_at") < cut)), path, buckets=8)
    tables.upsert_into(spark, path, maintain.latest_markings(log.filter(F.col("updated_at") >= cut)))
    return tables.read_markings(spark, path)


def upsert_markings(spark, d):
    """Stored markings of the later half of the change log, and the earlier half, older times and repeated keys, as the batch."""
    log, cut = b.marking_log(spark, d), text.as_of_column(b.AS_OF_MARKINGS)
    stored = maintain.latest_markings(log.filter(F.col("updated_at") >= cut))
    return maintain.upsert_markings(stored, log.filter(F.col("updated_at") < cut))


def bulk_mark_progress(spark, d):
    """A learner without markings marks a week; the report counts the inserted rows."""
    words = b.words(spark, d)
    after = maintain.bulk_mark_week(b.markings(spark, d), words, b.schedule(spark, d), "newcomer", "N1", 1, 1, b.AS_OF_MARKINGS)
    return progress.progress_by_level(words, after, "newcomer").select(
        "level", "total_words", F.col("marked_words").alias("newly_marked")
    )


def reset_in_table(spark, d):
    """One learner's level removed from the stored markings."""
    path = shared_dir(spark, "marking-table")
    words = b.words(spark, d)
    tables.write_markings(b.markings(spark, d), path, buckets=8)
    tables.rewrite_user(spark, path, b.USER, lambda rows: maintain.reset_level(rows, words, b.USER, "N1"))
    return tables.read_markings(spark, path)


# Ingest ---------------------------------------------------------------------------------------------------------

def _split(variant):
    def run(spark, d):
        s = split_sentence(F.col("Kanji"), F.col("Sentence"), variant)
        return _valid(spark, d).select("level", F.col("Sr no").alias("sr_no"), s.alias("s")).select("level", "sr_no", "s.*")

    return run


def _candidates(variant):
    def run(spark, d):
        heads = _valid(spark, d).select(F.col("Kanji").alias("kanji")).distinct()
        forms = heads.select("kanji", F.posexplode(candidate_forms(F.col("kanji"), variant)).alias("position", "c"))
        return forms.select("kanji", "position", "c.form", "c.display")

    return run


def lemma_forms(spark, d):
    forms = ingest.forms_of_words(ingest.lemma_forms(b.analyser_tokens(spark, d)))
    return forms.select("word", F.array_join("forms", "|").alias("forms"))


def split_with_forms(spark, d):
    rows = ingest.with_forms(_valid(spark, d), ingest.lemma_forms(b.analyser_tokens(spark, d)))
    return ingest.examples(rows).select(
        F.col("Sr no").alias("sr_no"), "matched", "example_before", "example_after"
    )


def parse_week_day(spark, d):
    lecture = F.col("Lecture")
    return b.sheet(spark, d).select(
        lecture.alias("lecture"), lecture_week(lecture).alias("week"), lecture_day(lecture).alias("day")
    )


def _word_type(strict):
    def run(spark, d):
        raw, meaning = F.col("Raw"), F.col("Meaning")
        return b.sheet(spark, d).select(
            raw.alias("raw"), meaning.alias("meaning"), word_type(raw, meaning, strict).alias("word_type")
        )

    return run


def page_and_schedule(spark, d):
    rows = ingest.resolve_schedule(_enriched(spark, d), b.schedule(spark, d))
    return rows.select("ref_no", "page_no", "week", "day", "schedule_id")


# Functions ------------------------------------------------------------------------------------------------------

def context_concat(spark, d):
    parts = F.col("example_before"), F.col("kanji"), F.col("example_after")
    return b.words(spark, d).select(
        "id", text.example_text(*parts).alias("example"), text.bracketed_example(*parts).alias("context")
    )


def marked_share(spark, d):
    rows = b.markings(spark, d).groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum(text.flag(F.col("marking") == 5)).alias("hard")
    )
    return rows.select("user_id", text.percent(F.col("hard"), F.col("n")).alias("percent_hard"))


def string_functions(spark, d):
    t = F.col("Sentence")
    return b.sheet(spark, d).select(
        F.col("Sr no").alias("sr_no"),
        text.strip(t).alias("stripped"),
        F.lower(F.col("Meaning")).alias("meaning"),
        F.instr(t, "、").alias("comma_at"),
        F.substring_index(t, "、", 1).alias("head"),
        F.array_size(F.split(t, " ")).alias("pieces"),
        text.remove_chars(F.col("Raw"), "＊*+（）()").alias("bare"),
        F.col("Raw").endswith("い").alias("ends_i"),
    )


def _quiz(direction):
    """Cards of all words that were answered wrong."""
    def run(spark, d):
        wrong = b.progress(spark, d).filter(F.col("result") == "incorrect")
        return lookup.quiz_cards(b.words(spark, d), direction, wrong.select(F.col("vocabulary_id").alias("id")))

    return run


# Registry -------------------------------------------------------------------------------------------------------

_Query = Callable[[SparkSession, str], DataFrame]

_WORD = ["level", "kanji", "hiragana", "meaning_en"]


def queries() -> dict[str, _Query]:
    """One entry per operator; each reads the given tables whole."""
    w, sw, sched, mk, pg = b.words, b.study_words, b.schedule, b.markings, b.progress
    u = b.USER
    return _llm_queries() | {
        # sources and sinks
        "read_sheet": read_sheet,
        "read_sheet_titles": read_sheet_titles,
        "read_sheet_line_breaks": read_sheet_line_breaks,
        "load_levels": load_levels,
        "load_rejects": load_rejects,
        "valid_rows": valid_rows,
        "conform_schema": conform_schema,
        "schedule_dim": schedule_dim,
        "vocab_sink": vocab_sink,
        "distinct_ids": distinct_ids,
        "distinct_ids_null_and_empty": distinct_ids_null_and_empty,
        "insert_script_export": lambda s, d: scripts.insert_tuples(_enriched(s, d)),
        "insert_script_import": _script_round_trip(CURRENT, True),
        "insert_script_import_first": _script_round_trip(FIRST, False),
        "insert_script_awkward": insert_script_awkward,
        "markings_export": lambda s, d: tables.markings_export(mk(s, d), u),
        "markings_import": markings_import,
        "anki_export": anki_export,
        "example_export": lambda s, d: tables.example_export(w(s, d)),
        "vocab_with_markings_export": lambda s, d: tables.vocab_with_markings_export(w(s, d), mk(s, d), u, "N1"),
        "import_verify": lambda s, d: stats.import_verify(w(s, d), sched(s, d)),
        # projections, filters, predicates
        "project_rename": lambda s, d: lookup.project_rename(w(s, d)),
        "level_filter": lambda s, d: lookup.level_filter(
            views.vocabulary_full(w(s, d), sched(s, d)), level="N1", week=1, day=2).select("id", *_WORD),
        "difficult_words": lambda s, d: lookup.difficult_words(w(s, d)).select("id", *_WORD, "hint"),
        "threshold": lambda s, d: lookup.at_least(mk(s, d), "marking", 3),
        "not_reviewed": lambda s, d: lookup.never_reviewed(sw(s, d)).select("id", "kanji", "hiragana", "meaning_en"),
        "null_tests": lambda s, d: lookup.with_example(w(s, d)).select("id", "full_sentence", "example_before"),
        "boolean_flag": lambda s, d: lookup.marked_for_review(sw(s, d)).select("id", "kanji", "hiragana", "meaning_en", "hint"),
        "search_kanji": lambda s, d: lookup.search_kanji(w(s, d), "ring").select("id", *_WORD),
        "search_reading": lambda s, d: lookup.search_reading(w(s, d), "#2").select("id", *_WORD),
        "search_reading_or_kanji": lambda s, d: lookup.search_reading(w(s, d), "#1", or_kanji="bolt").select("id", *_WORD),
        "search_meaning": lambda s, d: lookup.search_meaning(w(s, d), "eco", "Ring").select("id", *_WORD),
        "point_lookup": _quiz("kanji_to_reading"),
        "point_lookup_reading": _quiz("reading_to_kanji"),
        "point_lookup_meaning": _quiz("meaning_to_word"),
        "due_interval": lambda s, d: lookup.due_markings(mk(s, d), b.AS_OF_MARKINGS),
        "literal_column": lambda s, d: lookup.row_count(w(s, d), "Vocabulary entries:"),
        # joins
        "words_by_week": lambda s, d: lookup.words_by_week(w(s, d), sched(s, d), "N1", 1),
        "words_by_day": lambda s, d: lookup.words_by_day(w(s, d), sched(s, d), 1, 1),
        "vocabulary_full": lambda s, d: views.vocabulary_full(w(s, d), sched(s, d)),
        "user_marked_words": lambda s, d: lookup.user_marked_words(w(s, d), mk(s, d), u),
        "left_join_on_residual": lambda s, d: lookup.marking_per_word(w(s, d), mk(s, d), u),
        "orphaned_markings": lambda s, d: quality.orphaned_markings(
            mk(s, d), b.table(s, d, "customer").select(F.col("c_custkey").alias("id"))),
        "left_then_not_null": lambda s, d: views.scheduled_words(w(s, d), sched(s, d)).select("id", "week", "day"),
        "in_subquery_delete_set": lambda s, d: lookup.words_of_users_level(w(s, d), mk(s, d), u, "N1"),
        "schedule_key_lookup": lambda s, d: ingest.resolve_schedule(
            parse_week_day(s, d).groupBy("week", "day").agg(F.count("*").alias("n")), sched(s, d)),
        "history_for_word": lambda s, d: lookup.history_for_word(w(s, d), pg(s, d), "red bolt"),
        "schedule_left_vocab": lambda s, d: views.words_per_day_all(w(s, d), sched(s, d)),
        # aggregations
        "count_total": lambda s, d: stats.count_total(w(s, d)),
        "count_by_level": lambda s, d: stats.count_by_level(w(s, d)),
        "level_summary": lambda s, d: views.level_summary(w(s, d)),
        "sentence_coverage": lambda s, d: stats.sentence_coverage(w(s, d)),
        "words_per_day": lambda s, d: views.words_per_day(w(s, d), sched(s, d)),
        "study_summary": lambda s, d: views.study_summary(sw(s, d), sched(s, d)),
        "study_summary_week": lambda s, d: views.study_summary(sw(s, d), sched(s, d), week=1),
        "progress_by_level": lambda s, d: progress.progress_by_level(w(s, d), mk(s, d), u),
        "weekly_progress": lambda s, d: progress.weekly_progress(sw(s, d), sched(s, d)),
        "overall_progress": lambda s, d: progress.overall_progress(sw(s, d)),
        "type_distribution": lambda s, d: stats.type_distribution(w(s, d)),
        "type_distribution_overall": lambda s, d: stats.type_distribution(w(s, d), by_level=False),
        "difficulty_distribution": lambda s, d: stats.difficulty_distribution(w(s, d)),
        "duplicate_headwords": lambda s, d: stats.duplicate_headwords(w(s, d)),
        "top_markers": lambda s, d: progress.top_markers(mk(s, d)),
        "frequent_wrong": lambda s, d: progress.frequent_wrong(w(s, d), pg(s, d)),
        "database_summary": lambda s, d: stats.database_summary(w(s, d)),
        "split_stats": lambda s, d: stats.split_stats(_enriched(s, d)),
        "week_histogram": lambda s, d: stats.week_histogram(b.sheet(s, d)),
        # sorts, limits, top-k, sampling
        "multi_key_sort": lambda s, d: lookup.user_marked_words(w(s, d), mk(s, d), "u3").select("level", "kanji", "marking"),
        "nulls_first_due": lambda s, d: study.due_or_new(sw(s, d), 20, b.AS_OF_REVIEWS),
        "limit_rows": lambda s, d: study.limit_rows(w(s, d), 10, by="id"),
        "random_quiz": lambda s, d: study.random_quiz(w(s, d), 10, F.col("level") == "N1", SEED),
        "random_quiz_week": lambda s, d: session.session_words(w(s, d), sched(s, d), 1, 10, SEED),
        "random_quiz_difficult": lambda s, d: study.random_quiz(
            w(s, d), 10, F.col("difficulty_level") == 3, SEED, ["kanji", "hiragana", "meaning_en", "hint"]),
        "random_quiz_example": lambda s, d: study.example_quiz(w(s, d), "N1", 10, SEED),
        "random_quiz_unreviewed": lambda s, d: study.random_quiz(sw(s, d), 20, F.col("times_reviewed") == 0, SEED),
        "random_within_level": lambda s, d: study.random_within_level(w(s, d), 10, 3, SEED),
        "hardest_first": lambda s, d: lookup.hardest_first(w(s, d), mk(s, d), u),
        "unknown_words": lambda s, d: lookup.unknown_words(w(s, d), mk(s, d), u),
        "due_words": lambda s, d: lookup.due_words(w(s, d), mk(s, d), u, b.AS_OF_MARKINGS),
        # scalar functions
        "context_concat": context_concat,
        "marking_label": lambda s, d: mk(s, d).select("id", text.marking_label(F.col("marking")).alias("marking_label")),
        "case_flag": lambda s, d: mk(s, d).select("id", text.flag(F.col("marking") == 5).alias("dont_know")),
        "coalesce_label": lambda s, d: w(s, d).select("id", F.coalesce("word_type", F.lit("Unknown")).alias("type")),
        "percent": marked_share,
        "like_ilike": lambda s, d: w(s, d).select(
            "id", F.col("kanji").like("%bolt%").alias("like_bolt"), F.col("meaning_en").ilike("%small%").alias("ilike_small")),
        "days_before": lambda s, d: mk(s, d).select(
            "id", (F.col("updated_at") < text.days_before(b.AS_OF_MARKINGS, 3)).alias("due")),
        "random_key": lambda s, d: w(s, d).select("id", text.shuffle_key(SEED, F.col("id")).alias("sort_key")),
        "sql_quote": lambda s, d: b.sheet(s, d).select(
            F.col("Sr no").alias("sr_no"), text.sql_quote(F.col("Hint")).alias("hint"),
            text.sql_quote(F.col("Sentence")).alias("sentence")),
        "cast_int": lambda s, d: b.sheet(s, d).select(
            F.col("`Page no.`").alias("page"), text.to_int(F.col("`Page no.`")).alias("page_no")),
        "string_functions": string_functions,
        # ingest
        "parse_week_day": parse_week_day,
        "difficulty": lambda s, d: b.sheet(s, d).select(F.col("Raw").alias("raw"), difficulty(F.col("Raw")).alias("difficulty_level")),
        "word_type": _word_type(False),
        "word_type_first": _word_type(True),
        "candidate_forms": _candidates(CURRENT),
        "candidate_forms_interim": _candidates(INTERIM),
        "candidate_forms_first": _candidates(FIRST),
        "split_sentence": _split(CURRENT),
        "split_sentence_interim": _split(INTERIM),
        "split_sentence_first": _split(FIRST),
        "examples_or_fallback": lambda s, d: _enriched(s, d).select("ref_no", "matched", "example_before", "example_after"),
        "page_and_schedule": page_and_schedule,
        "lemma_forms": lemma_forms,
        "split_with_forms": split_with_forms,
        # table maintenance
        "latest_markings": mk,
        "upsert_markings": upsert_markings,
        "upsert_into_table": upsert_into_table,
        "bulk_mark_week": lambda s, d: maintain.bulk_mark_week(
            mk(s, d), w(s, d), sched(s, d), u, "N1", 1, 1, b.AS_OF_MARKINGS),
        "bulk_mark_progress": bulk_mark_progress,
        "reset_level": lambda s, d: maintain.reset_level(mk(s, d), w(s, d), u, "N1"),
        "reset_in_table": reset_in_table,
        "set_flag": lambda s, d: maintain.set_flag(
            maintain.set_flag(sw(s, d), "red bolt", True), "blue rod", False).select("id", "kanji", "is_marked"),
        "set_flags": lambda s, d: maintain.set_flags(sw(s, d), pg(s, d).join(
            w(s, d).select(F.col("id").alias("vocabulary_id"), "kanji"), "vocabulary_id").select(
                "kanji", (F.col("result") == "incorrect").alias("is_marked"), F.col("created_at").alias("changed_at"))
            ).select("id", "kanji", "is_marked"),
        "record_review": lambda s, d: sw(s, d).select("id", "times_reviewed", "last_reviewed"),
        "append_progress": lambda s, d: maintain.append_progress(pg(s, d), mk(s, d).select(
            F.col("word_id").alias("vocabulary_id"), F.to_date("updated_at").alias("review_date"),
            F.when(F.col("marking") == 5, "incorrect").otherwise("correct").alias("result")
            ).orderBy("vocabulary_id", "review_date", "result"), b.AS_OF_REVIEWS),
        "append_progress_ids": append_progress_ids,
        # data-quality checks
        "check_not_null": lambda s, d: quality.check_not_null(
            _enriched(s, d), (*NOT_NULL["vocabulary"], "full_sentence", "page_no")),
        "check_unique": lambda s, d: quality.check_unique(b.marking_log(s, d), ("user_id", "word_id")),
        "check_table": lambda s, d: quality.check_table(b.marking_log(s, d), "user_markings"),
        "check_table_vocabulary": lambda s, d: quality.check_table(w(s, d), "vocabulary"),
        "check_foreign_key": lambda s, d: quality.check_foreign_key(
            b.marking_log(s, d), "word_id", b.table(s, d, "customer").select(F.col("c_custkey").alias("id"))),
        "check_table_schedule": lambda s, d: quality.check_table(sched(s, d), "schedule"),
        "check_foreign_key_schedule": lambda s, d: quality.check_foreign_key(w(s, d), "schedule_id", sched(s, d)),
        "check_foreign_key_progress": lambda s, d: quality.check_foreign_key(pg(s, d), "vocabulary_id", w(s, d)),
        "check_length": lambda s, d: quality.check_length(
            w(s, d), {**MAX_LENGTHS["vocabulary"], "meaning_en": 15}),
        "apply_defaults": lambda s, d: maintain.apply_defaults(
            w(s, d).select("id", "word_type"), "vocabulary", b.AS_OF_REVIEWS),
        "owner_scope": lambda s, d: quality.owner_scope(mk(s, d), u),
        "owner_rejects": lambda s, d: quality.split_by_owner(mk(s, d), u)[1],
    }


def _llm_queries() -> dict[str, _Query]:
    return {} if llm is None else {**llm.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """The SQL of every query that SQL can express."""
    if llm is None:
        return oracle.oracle_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**oracle.oracle_sql(), **llm.ORACLE, **pipeline}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: one learner's progress per level."""
    return queries()["progress_by_level"](spark, FLAGSHIP_DIR)
