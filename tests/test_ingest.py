"""Sheets, derived fields, scripts and the whole ingest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from lexitrack.functions import text
from lexitrack.functions.conjugation import FIRST
from lexitrack.functions.enrich import difficulty, lecture_day, lecture_week, word_type
from lexitrack.operators.stats import import_verify, split_stats, week_histogram
from lexitrack.plans import ingest
from lexitrack.sources import scripts, sheets
from lexitrack.sources.calendar import schedule_dim

HEADER = "Sr no,Kanji,Raw,Hiragana,Meaning,Hint,Sentence,Supporting word 1,Supporting word 2,Page no.,Lecture"
SHEET = [
    "word list" + "," * 10,
    HEADER,
    '1,足掻く,足掻く＊＊,あがく,"To struggle, to flail",,水中で足掻いて泳ぎました。,,,17.0,1週3日',
    "2,愛する,愛する,あいする,love,NaN,彼を愛している,彼を,ている,x,１週２日(復習)",
    "3,静か,静か（な）,しずか,quiet,,,a,b,0,",
    "4,,raw only,,,,,,,,",
    ",無番,無番,,,,,,,,",
    '0,悩みの種,悩みの種+,,"say ""hi""",it\'s,悩みの種,,,12,12週1日',
    "5,空文,空文,,,,   ,s1,s2,,0週1日",
]


@pytest.fixture
def sheet_path(tmp_path):
    (tmp_path / "n1.csv").write_text("\n".join(SHEET) + "\n", encoding="utf-8")
    return str(tmp_path / "n1.csv")


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_sheet_reads_header_from_second_row(spark, sheet_path):
    rows = sheets.read_sheet(spark, sheet_path)
    assert rows.columns == [*HEADER.split(","), sheets.BAD_ROW]
    got = {r["Sr no"]: r for r in rows.collect()}
    assert len(got) == 7 and "Sr no" not in got
    assert got["2"]["Hint"] is None  # a missing-value text
    assert got["0"]["Meaning"] == 'say "hi"'
    assert all(r[sheets.BAD_ROW] is None for r in got.values())


def test_sheet_keeps_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Sr no,Kanji\n1,語\n2,語,extra\n", encoding="utf-8")
    rows = {r["Sr no"]: r[sheets.BAD_ROW] for r in sheets.read_sheet(spark, str(tmp_path), header_row=0).collect()}
    assert rows == {"1": None, "2": "2,語,extra"}


def test_load_levels_skips_a_missing_file(spark, sheet_path, caplog):
    rows = sheets.load_levels(spark, {"N1": sheet_path, "N2": "/nonexistent/n2.csv"})
    assert {r["Sr no"] for r in rows.collect()} == {"0", "1", "2", "3", "5"}
    assert "N2" in caplog.text
    with pytest.raises(ValueError):
        sheets.load_levels(spark, {"N2": "/nonexistent/n2.csv"})


def test_sheet_without_kanji_or_optional_columns(frame):
    rows = sheets.valid_rows(sheets.conform_schema(frame("`Sr no` double, Raw string", [(1.0, "語＊"), (float("nan"), "x")])))
    (row,) = rows.collect()
    assert (row["Sr no"], row["Kanji"], row["Hiragana"], row["Lecture"]) == ("1.0", "語＊", "", None)


def test_whole_ingest(spark, sheet_path):
    rows = sheets.load_levels(spark, {"N1": sheet_path})
    words = ingest.ingest(rows, schedule_dim(spark))
    got = {r["kanji"]: r for r in words.collect()}
    a = got["足掻く"]
    assert (a["id"], a["ref_no"], a["level"]) == ((1 << 32) + 1, 1, "N1")
    assert (a["example_before"], a["example_after"], a["page_no"], a["schedule_id"]) == ("水中で", "～いて泳ぎました。", 17, 3)
    assert (a["word_type"], a["difficulty_level"]) == ("verb", 3)
    b = got["愛する"]  # no match: the supporting words
    assert (b["example_before"], b["example_after"], b["page_no"], b["schedule_id"]) == ("彼を", "ている", None, 2)
    c = got["静か"]  # no sentence: no example; page 0 is none
    assert (c["example_before"], c["example_after"], c["page_no"], c["word_type"]) == (None, None, None, "な-adjective")
    d = got["悩みの種"]  # the sentence is the word; number 0 is none; no week 12
    assert (d["ref_no"], d["example_before"], d["example_after"], d["schedule_id"], d["difficulty_level"]) == (None, None, None, None, 2)
    e = got["空文"]
    assert (e["example_before"], e["full_sentence"], e["schedule_id"]) == (None, "   ", None)


def test_split_stats(spark, sheet_path):
    rows = ingest.enrich(sheets.load_levels(spark, {"N1": sheet_path}))
    assert tuple(split_stats(rows).first()) == ("N1", 3, 2, 1, 66.7)


def test_week_histogram_drops_rows_without_week(frame):
    rows = frame("Lecture string", [("1週1日",), ("１週2日",), ("2週1日x",), ("週1日",), (None,), ("0週1日",)])
    assert {tuple(r) for r in week_histogram(rows).collect()} == {(1, 2), (2, 1)}


def test_import_verify_keeps_empty_weeks(spark, frame):
    words = frame("level string, schedule_id int, example_before string", [("N1", 1, "a"), ("N1", 8, None), ("N2", None, None)])
    got = {(r["check"], r["item"]): r["value"] for r in import_verify(words, schedule_dim(spark, 3)).collect()}
    assert got == {
        ("total", ""): 3, ("with_examples", ""): 1, ("level", "N1"): 2, ("level", "N2"): 1,
        ("week", "1"): 1, ("week", "2"): 1, ("week", "3"): 0,
    }


def test_schedule(spark):
    rows = [tuple(r) for r in schedule_dim(spark).orderBy("id").collect()]
    assert len(rows) == 77 and rows[0] == (1, 1, 1, "1週1日") and rows[-1] == (77, 11, 7, "11週7日")
    assert schedule_dim(spark, 8).count() == 56


@pytest.mark.parametrize("value, want", [
    ("12", 12), ("12.7", 12), ("-3.9", -3), (" 4 ", 4), ("1e2", 100), (".5", 0), ("１２", 12), ("　7 ", 7), ("x", None), ("12d", None), ("inf", None),
    ("nan", None), ("99999999999", None), ("", None), (None, None),
])
def test_to_int(spark, value, want):
    assert one(spark, text.to_int(F.lit(value).cast("string"))) == (want,)


@pytest.mark.parametrize("lecture, want", [
    ("1週1日", (1, 1)), ("１０週２日", (10, 2)), ("3週4日(復習)", (3, 4)), ("x3週4日", (None, None)), ("3週日", (None, None)), (None, (None, None)),
])
def test_lecture(spark, lecture, want):
    c = F.lit(lecture).cast("string")
    assert one(spark, lecture_week(c), lecture_day(c)) == want


@pytest.mark.parametrize("raw, want", [("語＊＊", 3), ("**語", 3), ("語＊*", 2), ("語+", 2), ("語", 1), (None, 1)])
def test_difficulty(spark, raw, want):
    assert one(spark, difficulty(F.lit(raw).cast("string"))) == (want,)


@pytest.mark.parametrize("raw, meaning, want, strict", [
    ("静か(な)", "to be", "な-adjective", "な-adjective"),
    ("静か（な）", None, "な-adjective", "な-adjective"),
    ("会議", "To meet", "verb", "verb"),
    ("美しい＊", None, "い-adjective", None),
    ("高い", "high", "い-adjective", "い-adjective"),
    ("い", None, None, None),
    ("走る+", None, "verb", "verb"),
    ("死ぬ", None, None, None),
    ("正す②", None, None, None),
    (None, "to go", None, None),
])
def test_word_type(spark, raw, meaning, want, strict):
    r, m = F.lit(raw).cast("string"), F.lit(meaning).cast("string")
    assert one(spark, word_type(r, m), word_type(r, m, True)) == (want, strict)


def test_strip_takes_all_whitespace_but_the_zero_width_space(spark):
    value = "　\x1c a​\xa0\n"
    assert one(spark, text.strip(F.lit(value))) == (value.strip(),) == ("a​",)


def test_whitespace_is_what_str_strip_removes():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_percent_rounds_half_up(spark):
    got = one(spark, *[text.percent(F.lit(a), F.lit(b)) for a, b in ((1, 3), (1, 16), (1, 2000), (5, 5), (0, 7), (3, 0))])
    assert got == (33.3, 6.3, 0.1, 100.0, 0.0, None)


def test_quoting(spark):
    assert one(spark, text.sql_quote(F.lit("it's")), text.sql_quote(F.lit(None).cast("string"))) == ("'it''s'", "NULL")


SCRIPT_SCHEMA = (
    "level string, ref_no int, kanji string, hiragana string, meaning_en string, example_before string, example_after string,"
    "hint string, full_sentence string, page_no int, week int, day int, word_type string, difficulty_level int"
)
SCRIPT_ROWS = [
    ("N1", 1, "語", "ご", "it's, 'quoted'", None, "'", "''", "'tis' the\n end, (NULL)", 3, 1, 2, "verb", 1),
    ("N1", 2, "NULL", "", "NULL", "a, b", "", ",", "SELECT 1);", None, None, None, None, 2),
    ("N2", 1, "（語）", None, None, None, None, None, None, 12, 11, 7, "な-adjective", 3),
    ("N2", None, "無番", "'", "x''y", "'", "''''", "()", "--", None, 2, 1, None, 1),
]


@pytest.mark.parametrize("parts", [1, 4])
def test_script_round_trip(spark, frame, tmp_path, parts):
    path = str(tmp_path / "script")
    scripts.write_script(frame(SCRIPT_SCHEMA, SCRIPT_ROWS, parts), path)
    assert sorted(map(str, (tuple(r) for r in scripts.read_script(spark, path).collect()))) == sorted(map(str, SCRIPT_ROWS))


def test_script_with_copies_of_the_last_word(spark, frame, tmp_path):
    path = tmp_path / "script"
    scripts.write_script(frame(SCRIPT_SCHEMA, SCRIPT_ROWS + SCRIPT_ROWS[2:3] * 4), str(path))
    assert scripts.read_script(spark, str(path)).count() == 8
    whole = "".join(f.read_text(encoding="utf-8") for f in sorted(path.glob("part-*")))
    assert whole.count("'（語）'") == 5 and whole.count("),\n    (") == 7


def test_script_is_read_in_pieces(spark, frame, tmp_path):
    """Cut anywhere, also inside a separator or a text, every tuple is read once."""
    path = str(tmp_path / "script")
    many = [(level, i, *SCRIPT_ROWS[i % 4][2:]) for level in ("N1", "N2") for i in range(1, 60)]
    scripts.write_script(frame(SCRIPT_SCHEMA, many, 1).coalesce(1), path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        rows = scripts.read_script(spark, path)
        assert rows.rdd.getNumPartitions() > 50
        assert sorted((r["level"], r["ref_no"]) for r in rows.collect()) == sorted((r[0], r[1]) for r in many)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sheet_folder_with_a_title_in_every_file(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"{i}.csv").write_text(f"my words\nSr no,Kanji\n{i},語{i}\n", encoding="utf-8")
    assert sorted(r["Kanji"] for r in sheets.read_sheet(spark, str(tmp_path)).collect()) == ["語1", "語2"]


def test_sheet_with_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Sr no,Kanji,Sentence\n1,語,"一行\n二行"\n', encoding="utf-8")
    (row,) = sheets.read_sheet(spark, str(tmp_path), header_row=0, multi_line=True).collect()
    assert (row["Sr no"], row["Sentence"], row[sheets.BAD_ROW]) == ("1", "一行\n二行", None)


def test_script_is_one_statement(frame, tmp_path):
    path = tmp_path / "script"
    scripts.write_script(frame(SCRIPT_SCHEMA, SCRIPT_ROWS), str(path))
    whole = "".join(f.read_text(encoding="utf-8") for f in sorted(path.glob("part-*")))
    assert whole.startswith("BEGIN;\n\nINSERT INTO vocabulary (\n    level, ref_no, kanji,")
    assert "page_no, schedule_id, word_type" in whole
    assert whole.rstrip().endswith(")\n;\n\nCOMMIT;")
    assert whole.count("\n    ('N") == 4 and whole.index("'N1', 1,") < whole.index("'N1', 2,") < whole.index("'N2', 1,")
    assert "(SELECT id FROM schedule WHERE week = 11 AND day = 7), 'な-adjective', 3),\n" not in whole.split(";\n\nCOMMIT")[0][-120:]


def test_script_runs_as_sql(frame, tmp_path):
    import duckdb

    path = tmp_path / "script"
    scripts.write_script(frame(SCRIPT_SCHEMA, SCRIPT_ROWS), str(path))
    whole = "".join(f.read_text(encoding="utf-8") for f in sorted(path.glob("part-*")))
    con = duckdb.connect()
    con.execute("CREATE TABLE schedule AS SELECT i AS id, (i - 1) // 7 + 1 AS week, (i - 1) % 7 + 1 AS day FROM range(1, 78) r(i)")
    con.execute("""CREATE TABLE vocabulary (level TEXT, ref_no INT, kanji TEXT, hiragana TEXT, meaning_en TEXT, example_before TEXT,
        example_after TEXT, hint TEXT, full_sentence TEXT, page_no INT, schedule_id INT, word_type TEXT, difficulty_level INT)""")
    for statement in ("BEGIN TRANSACTION;" + whole.removeprefix("BEGIN;"),):
        con.execute(statement)
    got = con.execute("SELECT level, kanji, meaning_en, full_sentence, schedule_id FROM vocabulary ORDER BY level, ref_no").fetchall()
    assert ("N1", "語", "it's, 'quoted'", "'tis' the\n end, (NULL)", 2) in got
    assert len(got) == 4


def test_script_without_tuple_is_an_error(spark, tmp_path):
    (tmp_path / "bad.sql").write_text("    (1, 'a'),\n    (2, 'b')\n;\n")
    with pytest.raises(Exception, match="no vocabulary tuple"):
        scripts.read_script(spark, str(tmp_path)).collect()


def test_first_release_rows(spark, sheet_path):
    rows = ingest.enrich(sheets.load_levels(spark, {"N1": sheet_path}), FIRST)
    got = {r["kanji"]: r for r in rows.collect()}
    assert got["足掻く"]["example_after"] == "泳ぎました。"


def test_lemma_forms(frame):
    forms = ingest.lemma_forms(frame("word string, form string", [("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", "")]))
    assert sorted(tuple(r) for r in forms.collect()) == [("a", "x"), ("a", "y")]


def test_lemma_forms_query_gathers_the_forms_of_a_word(spark, tmp_path):
    spark.range(30).select(F.col("id").alias("doc_id")).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["word"]: r["forms"] for r in e.lemma_forms(spark, str(tmp_path)).collect()}
    assert len(rows) == 24 and rows["足掻く"] == "足掻いて|足掻いてと|足掻く"


def test_created_at_has_no_zone(spark, sheet_path):
    words = ingest.ingest(sheets.load_levels(spark, {"N1": sheet_path}), schedule_dim(spark))
    assert dict(words.dtypes)["created_at"] == "timestamp_ntz"
    assert isinstance(words.first()["created_at"], dt.datetime)


def test_title_is_skipped_by_its_place(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Title,,\nSr no,Kanji,Raw\nTitle,,\n1,語,語\n", encoding="utf-8")
    got = [tuple(r)[:2] for r in sheets.read_sheet(spark, str(tmp_path)).collect()]
    assert got == [("Title", None), ("1", "語")]


def test_rows_that_do_not_fit_are_reported_not_loaded(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Title\nSr no,Kanji,Raw\n1,語,語\n2,語\n3,語,語,x\n", encoding="utf-8")
    paths = {"N1": str(path), "N2": "/nonexistent/n2.csv"}
    assert [r["Sr no"] for r in sheets.load_levels(spark, paths).select("Sr no").collect()] == ["1"]
    got = [tuple(r) for r in sheets.load_rejects(spark, paths).collect()]
    assert sorted(got) == [("N1", "2,語"), ("N1", "3,語,語,x")]


def test_every_word_has_an_id_of_its_own(spark, frame):
    cells = [("N1", "5", "語"), ("N1", "5", "話"), ("N1", "5", "話"), ("N1", "0", "字"), ("N1", "7a", "辞"), ("N4", "1", "文"),
             ("N1", "3000000000", "山"), ("N2", "1", "川")]
    sheet = sheets.valid_rows(sheets.conform_schema(frame("level string, `Sr no` string, Kanji string", cells)))
    words = ingest.distinct_ids(ingest.ingest(sheet, schedule_dim(spark), as_of="2024-01-01 00:00:00"))
    ids = [(r["kanji"], r["id"]) for r in words.collect()]
    assert len(ids) == 8 and len({i for _, i in ids}) == 8 and all(i is not None for _, i in ids)
    assert ("川", (2 << 32) + 1) in ids
    again = ingest.distinct_ids(ingest.ingest(sheet.repartition(5), schedule_dim(spark), as_of="2024-01-01 00:00:00"))
    others = [(r["kanji"], r["id"]) for r in again.collect()]  # new ids follow the order of the rows, the rest stay
    assert len({i for _, i in others}) == 8 and {x for x in ids if x[0] == "川"} <= set(others)


def test_script_of_several_statements(spark, frame, tmp_path):
    whole = ""
    for i in range(3):
        scripts.write_script(frame(SCRIPT_SCHEMA, SCRIPT_ROWS[i:i + 2], 1), str(tmp_path / f"part{i}"))
        whole += "".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / f"part{i}").glob("part-*")))
    (tmp_path / "all.sql").write_text(whole, encoding="utf-8")
    got = [tuple(r) for r in scripts.read_script(spark, str(tmp_path / "all.sql")).collect()]
    want = [r for i in range(3) for r in SCRIPT_ROWS[i:i + 2]]
    assert sorted(map(str, got)) == sorted(map(str, want))
