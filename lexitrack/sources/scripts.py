"""The vocabulary as a SQL script of VALUES tuples, written and read as text.

A tuple takes three lines, more if its texts hold line breaks. A reader cuts tuples outside quotes only, so texts may
hold anything that also stands between tuples; large scripts are read by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.functions.text import let, sql_number, sql_quote, strip, to_int, zero_to_null
from lexitrack.sources.records import records, slicer

_TEXTS = ["kanji", "hiragana", "meaning_en", "example_before", "example_after", "hint", "full_sentence"]
FIELDS = ["level", "ref_no", *_TEXTS, "page_no", "schedule", "word_type", "difficulty_level"]
OPENING = "    ("

_HEAD = """BEGIN;

INSERT INTO vocabulary (
    {columns}
) VALUES"""
_TAIL = """;

COMMIT;"""

# A noncharacter: never part of stored text.
_MARK = "\uffff"


def _schedule_lookup() -> Column:
    week, day = zero_to_null(F.col("week")).cast("string"), zero_to_null(F.col("day")).cast("string")
    lookup = F.concat(
        F.lit("(SELECT id FROM schedule WHERE week = "), week, F.lit(" AND day = "), day, F.lit(")")
    )
    return F.coalesce(lookup, F.lit("NULL"))


def insert_tuple(with_level: bool = True) -> Column:
    """One vocabulary row (with ``week`` and ``day``) as the text of a VALUES tuple."""
    first = [sql_quote(F.col("level"))] if with_level else []
    first += [sql_number(F.col("ref_no")), *[sql_quote(F.col(c)) for c in _TEXTS[:3]]]
    second = [sql_quote(F.col(c)) for c in _TEXTS[3:]]
    third = [
        sql_number(F.col("page_no")),
        _schedule_lookup(),
        sql_quote(F.col("word_type")),
        F.col("difficulty_level").cast("string"),
    ]
    lines = [F.concat_ws(", ", *part) for part in (first, second, third)]
    return F.concat(F.lit("    ("), F.concat_ws(",\n     ", *lines), F.lit(")"))


def insert_tuples(words: DataFrame, with_level: bool = True) -> DataFrame:
    """Sort keys and the tuple text of every word."""
    return words.select("level", "ref_no", insert_tuple(with_level).alias("tuple"))


def write_script(words: DataFrame, path: str, with_level: bool = True) -> None:
    """Write a script folder; its part files, read in name order, are one runnable script.

    Words stand in (level, ref_no) order, which names a word; copies of one stand in the order of a row hash.
    The rows are range-partitioned as stored and turned into text behind the sort. ``words`` is read twice (range bounds,
    rows), so pass a stored table rather than a long plan.
    """
    columns = ", ".join([f for f in FIELDS if with_level or f != "level"]).replace(" schedule,", " schedule_id,")
    order = [
        F.coalesce("level", F.lit("")), F.coalesce("ref_no", F.lit(0)),
        F.xxhash64("kanji", "hiragana", "meaning_en", "hint", "full_sentence"),
    ]
    head, slices = _HEAD.format(columns=columns), slicer()

    def with_commas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One range of the sort: a comma behind every tuple but its last, and one in front of its first. The first range,
        which is never empty, begins with the head instead."""
        waiting = None
        for b in batches:
            for own in slices(b, "value"):
                texts = own.column("value").to_pylist()
                if waiting is None:
                    texts[0] = f"{head}\n{texts[0]}" if own.column("first")[0].as_py() else f",\n{texts[0]}"
                else:
                    texts.insert(0, waiting)
                waiting = texts.pop()
                yield pa.RecordBatch.from_arrays([pa.array([f"{t}," for t in texts], pa.string())], ["value"])
        if waiting is not None:
            yield pa.RecordBatch.from_arrays([pa.array([waiting], pa.string())], ["value"])

    first = F.monotonically_increasing_id() == 0
    tuples = words.orderBy(*order).select(insert_tuple(with_level).alias("value"), first.alias("first"))
    tail = words.sparkSession.range(0, 1, 1, 1).select(F.lit(_TAIL).alias("value"))
    tuples.mapInArrow(with_commas, "value string").unionByName(tail).write.text(path)


def begins_record(lines: pa.Array) -> np.ndarray:
    """Outside quotes a tuple's first line begins a record, and so does any line that is not indented."""
    opening = pc.starts_with(lines, OPENING)
    other = pc.invert(pc.starts_with(lines, " "))
    return pc.or_(opening, other).to_numpy(zero_copy_only=False)


def _tokens(record: Column) -> Column:
    """Fields of a tuple: quoted texts keep a leading quote mark, other fields stand as written.

    The record is cut at every quote, so pieces at odd positions lie inside quotes. An empty piece between two
    of them is a doubled quote, part of the text; any other piece outside quotes ends the text before it.
    """
    def rejoined(pieces: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            doubled = (i > 0) & (i < F.size(pieces) - 1) & (p == "")
            return (
                F.when(i % 2 == 1, p)
                .when(doubled, F.lit("'"))
                .otherwise(F.concat(F.lit(_MARK), p, F.lit(_MARK)))
            )

        return F.split(F.array_join(F.transform(pieces, piece), ""), _MARK)

    def fields(spans: Column) -> Column:
        def span(s: Column, i: Column) -> Column:
            text = (i % 2 == 0) & (i > 0) & (i < F.size(spans) - 1)
            code = F.filter(F.transform(F.split(s, ","), lambda t: strip(t)), lambda t: t != "")
            return F.when(text, F.array(F.concat(F.lit("'"), s))).when(i % 2 == 1, code).otherwise(
                F.array().cast("array<string>")
            )

        return F.flatten(F.transform(spans, span))

    # Both ways give spans that alternate: '', code, text, code, text, ..., code, ''.
    edge = F.array(F.lit(""))
    spans = F.when(F.contains(record, F.lit("''")), let(F.split(record, "'"), rejoined)).otherwise(
        F.concat(edge, F.split(record, "'"), edge)
    )
    return let(spans, fields)


def read_script(spark: SparkSession, path: str, with_level: bool = True) -> DataFrame:
    """Read a script back into typed rows, the schedule as (week, day).

    A script may hold several INSERT statements. Whatever is no tuple is dropped: comments, statements around the tuples,
    empty lines. Where a tuple ends is told by its quotes, so texts may hold separators of tuples and ends of statements.
    """
    found = records(spark, path, quote="'", comment="--", begins=begins_record)
    record = F.rtrim(F.substr("record", F.lit(len(OPENING) + 1)), F.lit("), ;\r\n"))
    names = [f for f in FIELDS if with_level or f != "level"]
    complete = F.when(F.size("t") == len(names), F.col("t")).otherwise(
        F.raise_error(F.concat(F.lit("no vocabulary tuple: "), F.array_join("t", " | ")))
    )
    rows = found.filter(F.col("record").startswith(OPENING)).select(let(record, _tokens).alias("t")).select(complete.alias("t"))
    raw = {n: F.get("t", F.lit(i)) for i, n in enumerate(names)}

    def text(name):
        return F.when(raw[name].startswith("'"), F.substr(raw[name], F.lit(2)))

    def part(name):
        return F.regexp_extract(raw["schedule"], rf"{name} = (\d+)", 1).try_cast("int")

    def number(name):
        return to_int(raw[name])

    out = []
    for n in names:
        if n == "schedule":
            out += [part("week").alias("week"), part("day").alias("day")]
        elif n in ("ref_no", "page_no", "difficulty_level"):
            out.append(number(n).alias(n))
        else:
            out.append(text(n).alias(n))
    return rows.select(*out)
