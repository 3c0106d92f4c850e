"""Records cut outside quotes: sheets and scripts whose texts hold line breaks, read by one task or by many."""

import csv
import io
import random
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexitrack.sources import scripts, sheets
from lexitrack.sources.records import SLICE_BYTES, _scanner, records
from test_ingest import SCRIPT_SCHEMA


@contextmanager
def splits_of(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1b"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


AWKWARD = [
    "),\n    (", ")\n;\n", "');\n    ('N1', 2, '", "-- it's\n", "\n--\n'", "\n\n    (", "END\n;\n\nCOMMIT;\n", "'", "''", "\n", "a\r\nb", "",
    "INSERT INTO x (\n    y\n) VALUES\n    ('z')\n;", " ", None, "),", "\\'", "(SELECT id FROM schedule WHERE week = 1 AND day = 2)",
]


def script_rows(seed, n):
    pick = random.Random(seed)
    return [
        ("N1", i, f"語{i}", *[pick.choice(AWKWARD) for _ in range(6)], pick.choice([None, 7]), pick.choice([None, 3]), pick.choice([None, 4]),
         pick.choice([None, "verb"]), 1) for i in range(1, n)
    ]


def expected(rows):
    """A day without a week has no schedule, nor a week without a day."""
    return sorted(repr((*r[:10], *(r[10:12] if None not in r[10:12] else (None, None)), *r[12:])) for r in rows)


@pytest.mark.parametrize("size", ["128m", "61b", "300b"])
@pytest.mark.parametrize("seed", [1, 2])
def test_scripts_read_back_whatever_their_texts_hold(spark, frame, tmp_path, size, seed):
    rows = script_rows(seed, 60)
    scripts.write_script(frame(SCRIPT_SCHEMA, rows, 1).coalesce(1), str(tmp_path / "s"))
    with splits_of(spark, size):
        got = scripts.read_script(spark, str(tmp_path / "s"))
        assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows)


def test_comments_may_hold_quotes(spark, tmp_path):
    (tmp_path / "s.sql").write_text(
        "-- don't\nBEGIN;\n-- it's 'n1'\nINSERT INTO vocabulary (\n    level\n) VALUES\n    ('N1', 1, '語', 'a\n-- isn''t\nb', NULL,\n     NULL, NULL, NULL, NULL,\n"
        "     NULL, NULL, NULL, 1)\n;\n-- wasn't\nCOMMIT;\n", encoding="utf-8")
    for size in ("128m", "17b"):
        with splits_of(spark, size):
            (row,) = scripts.read_script(spark, str(tmp_path)).collect()
            assert (row["kanji"], row["hiragana"], row["difficulty_level"]) == ("語", "a\n-- isn't\nb", 1)


def test_script_over_several_ranges(spark, tmp_path):
    """Commas between the parts of a sort that has many ranges, and one statement over all files."""
    rows = spark.range(2000).select(
        F.lit("N1").alias("level"), F.col("id").cast("int").alias("ref_no"), F.concat(F.lit("語"), F.col("id")).alias("kanji"),
        *[F.lit("x).\n").alias(c) for c in ("hiragana", "meaning_en", "example_before", "example_after", "hint", "full_sentence")],
        F.lit(1).alias("page_no"), F.lit(1).alias("week"), F.lit(2).alias("day"), F.lit("verb").alias("word_type"), F.lit(1).alias("difficulty_level"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scripts.write_script(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "s").glob("part-*"))
    whole = "".join(p.read_text(encoding="utf-8") for p in parts)
    assert len(parts) > 4 and whole.count("BEGIN;") == 1 and whole.endswith(")\n;\n\nCOMMIT;\n")
    assert whole.replace("\n", "").count("),    ('N1'") == 1999
    assert scripts.read_script(spark, str(tmp_path / "s")).select("ref_no").distinct().count() == 2000


def test_words_are_read_twice_by_a_script(spark, tmp_path):
    """Range bounds and rows: no further pass for the last word."""
    spark.sql(f"SELECT {', '.join(f'CAST(NULL AS {c.strip().split()[1]}) AS {c.strip().split()[0]}' for c in SCRIPT_SCHEMA.split(','))} FROM range(9)").write.parquet(
        str(tmp_path / "w"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    words = spark.read.parquet(str(tmp_path / "w"))
    scripts.write_script(words.mapInArrow(count, words.schema), str(tmp_path / "s"))
    assert seen.value == 18


SHEET_CELLS = ["", "a", "x,y", 'say "hi"', "two\nlines", '"\n"', "three\n\nlines,", "end\n", "1", "  ", "Title", "Sr no"]


def sheet_rows(seed, n):
    pick = random.Random(seed)
    return [[str(i), *[pick.choice(SHEET_CELLS) for _ in range(3)]] for i in range(n)]


@pytest.mark.parametrize("size", ["128m", "23b", "200b"])
@pytest.mark.parametrize("titles", [0, 2])
def test_sheets_with_line_breaks_in_cells(spark, tmp_path, size, titles):
    want = []
    for f in range(3):
        rows = sheet_rows(f, 40)
        want += [tuple(None if c == "" else c for c in r) for r in rows]
        out = io.StringIO()
        # A title of several lines, and a title and header that also occur as rows further down.
        top = [["Title", "with\na break", "", ""]] * titles + [["Sr no", "Kanji", "Raw", "Hint"]]
        csv.writer(out, lineterminator="\n").writerows([*top, *rows, *top])
        want += [tuple(c or None for c in r) for r in top]
        (tmp_path / f"{f}.csv").write_text(out.getvalue(), encoding="utf-8")
    with splits_of(spark, size):
        got = sheets.read_sheet(spark, str(tmp_path), header_row=titles, multi_line=True)
        if size == "200b":
            assert records(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        assert got.columns == ["Sr no", "Kanji", "Raw", "Hint", sheets.BAD_ROW]
        assert sorted(map(repr, (tuple(r)[:4] for r in got.collect()))) == sorted(map(repr, want))
        assert got.filter(F.col(sheets.BAD_ROW).isNotNull()).isEmpty()


@pytest.mark.parametrize("header_row", [0, 1, 3])
def test_rows_like_the_title_lines_are_kept(spark, tmp_path, header_row):
    top = [f"Title {i},," for i in range(header_row)] + ["Sr no,Kanji,Raw"]
    for f in range(2):
        (tmp_path / f"{f}.csv").write_text("\n".join([*top, "1,語,語", *top]) + "\n", encoding="utf-8")
    got = sheets.read_sheet(spark, str(tmp_path), header_row=header_row).drop(sheets.BAD_ROW)
    assert got.count() == 2 * (2 + header_row)
    assert got.filter("`Sr no` = 'Sr no'").count() == 2


def test_records_are_numbered_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1\n"2\n3"\n4\n', encoding="utf-8")
    for size in ("128m", "3b"):
        with splits_of(spark, size):
            assert sorted((r["number"], r["record"]) for r in records(spark, str(tmp_path)).collect()) == [(0, "1"), (1, '"2\n3"'), (2, "4")]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "empty.csv").write_text("")
    assert records(spark, str(tmp_path / "b")).count() == 0


def test_a_task_works_on_a_slice_of_its_lines_at_once():
    _, cutter = _scanner("'", "--", scripts.begins_record)
    texts = [f"    ('N1', {i}, '{'語' * 3000}\n    (''x''')," for i in range(1000)]
    lines = [line for t in texts for line in t.split("\n")]
    whole = pa.RecordBatch.from_arrays(
        [pa.array([1] * len(lines), pa.int64()), pa.array([0] * len(lines), pa.int64()), pa.array(lines)], ["file", "start", "value"])
    out = list(cutter(lambda split: (0, 0), True)(iter([whole])))
    assert [r for b in out for r in b.column("record").to_pylist()] == texts
    assert [n for b in out for n in b.column("number").to_pylist()] == list(range(1000))
    assert max(b.nbytes for b in out) < 2 * SLICE_BYTES < whole.nbytes / 4


def test_script_of_long_texts_is_written_by_slices(spark, frame, tmp_path):
    long = "it's 語,\n" * (SLICE_BYTES // 40)
    rows = [("N1", i, f"語{i}", "a", "b", None, long, None, long * (1 + i % 3), 7, 3, 4, "verb", 1) for i in range(1, 60)]
    scripts.write_script(frame(SCRIPT_SCHEMA, rows, 1).coalesce(1), str(tmp_path / "s"))
    got = scripts.read_script(spark, str(tmp_path / "s"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows)
