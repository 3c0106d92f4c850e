"""Word sheets: CSV exports of one level's workbook sheet, all cells as text."""

from __future__ import annotations

import csv
import io
import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.functions.text import na_to_null
from lexitrack.schema import SHEET_DEFAULTS, SHEET_REQUIRED
from lexitrack.sources.records import records

BAD_ROW = "bad_row"

log = logging.getLogger(__name__)


def read_sheet(spark: SparkSession, path: str, header_row: int = 1, multi_line: bool = False) -> DataFrame:
    """Read a sheet whose column names stand in row ``header_row`` (counted from 0) of every file.

    The rows up to the header are left out by their place in their file; only they are looked at on the driver. Rows that do
    not fit the header keep their text in ``bad_row``. Cells that hold a missing-value text become NULL. With
    ``multi_line`` cells may hold line breaks: a row ends where its quotes are closed, and a large file is still read by
    many tasks. Without it every line is a row, and the lines up to the header stand in a file's first split.
    """
    rows = records(spark, path, quote='"' if multi_line else None)
    if multi_line:
        top = rows.filter(F.col("number") == header_row).select("record").head(1)
    else:
        top = spark.read.text(path).head(header_row + 1)[header_row:]
    if not top:
        raise ValueError(f"{path} has no row {header_row} to take the column names from")
    names = next(csv.reader(io.StringIO(top[0][0])), [])
    line = F.rtrim(F.col("record"), F.lit("\r"))
    cells = F.from_csv(line, _ddl([*names, BAD_ROW]), {
        "quote": '"', "escape": '"', "columnNameOfCorruptRecord": BAD_ROW, "mode": "PERMISSIVE", "multiLine": "true",
    })
    parsed = rows.filter((F.col("number") > header_row) & (F.trim(line) != "")).select(cells.alias("c"))
    return parsed.select(*[na_to_null(F.col(f"c.`{n}`")).alias(n) for n in names], F.col(f"c.{BAD_ROW}").alias(BAD_ROW))


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def conform_schema(rows: DataFrame) -> DataFrame:
    """Text columns with NULL for missing cells; absent optional columns get their default."""
    present = rows.columns
    missing = [c for c in SHEET_REQUIRED if c not in present]
    if missing or not {"Kanji", "Raw"} & set(present):
        raise ValueError(f"sheet lacks {missing or 'both Kanji and Raw'}")
    kept = {n: na_to_null(F.col(f"`{n}`").cast("string")) for n in present if n != BAD_ROW}
    added = {n: F.lit(d).cast("string") for n, d in SHEET_DEFAULTS.items() if n not in present}
    return rows.select(*[c.alias(n) for n, c in {**kept, **added}.items()])


def valid_rows(rows: DataFrame) -> DataFrame:
    """Rows with a number and a headword; a sheet without ``Kanji`` takes the headword from ``Raw``."""
    rows = rows.filter(F.col("Sr no").isNotNull())
    if "Kanji" not in rows.columns:
        return rows.withColumn("Kanji", F.col("Raw"))
    rows = rows.filter(F.col("Kanji").isNotNull())
    return rows if "Raw" in rows.columns else rows.withColumn("Raw", F.col("Kanji"))


def _found_sheets(
    spark: SparkSession, paths: dict[str, str], header_row: int, multi_line: bool
) -> dict[str, DataFrame]:
    found = {}
    for level, path in paths.items():
        try:
            found[level] = read_sheet(spark, path, header_row, multi_line)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no sheet for %s at %s", level, path)
    if not found:
        raise ValueError("no sheet found")
    return found


def load_levels(spark: SparkSession, paths: dict[str, str], header_row: int = 1, multi_line: bool = False) -> DataFrame:
    """The valid rows of several levels' sheets, tagged with ``level``. A missing file is skipped with a warning.

    Rows that do not fit their header are left to ``load_rejects``.
    """
    fitting = {
        level: sheet.filter(F.col(BAD_ROW).isNull())
        for level, sheet in _found_sheets(spark, paths, header_row, multi_line).items()
    }
    return reduce(DataFrame.unionByName, [
        valid_rows(conform_schema(sheet)).withColumn("level", F.lit(level)) for level, sheet in fitting.items()
    ])


def load_rejects(spark: SparkSession, paths: dict[str, str], header_row: int = 1, multi_line: bool = False) -> DataFrame:
    """(level, bad_row): the text of every row that does not fit its sheet's header."""
    return reduce(DataFrame.unionByName, [
        sheet.filter(F.col(BAD_ROW).isNotNull()).select(F.lit(level).alias("level"), BAD_ROW)
        for level, sheet in _found_sheets(spark, paths, header_row, multi_line).items()
    ])
