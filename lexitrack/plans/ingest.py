"""From sheet rows to the vocabulary table: one narrow stage, then a lookup of the calendar day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.conjugation import CURRENT, Variant
from lexitrack.functions.enrich import difficulty, lecture_day, lecture_week, word_type
from lexitrack.functions.split import clean_headword, split_sentence
from lexitrack.functions.text import as_of_column, blank_to_null, strip, to_int, zero_to_null
from lexitrack.operators.maintain import row_id
from lexitrack.operators.numbering import NTH, PART, numbered, placed
from lexitrack.schema import VOCABULARY
from lexitrack.session import shared_dir

_SPLIT = "split"
# The sheet's own cells: they name a word that has no number.
_CELLS = ("level", "ref_no", "kanji", "hiragana", "meaning_en", "hint", "full_sentence", "page_no", "week", "day")


def lemma_forms(tokens: DataFrame) -> DataFrame:
    """Analyser output (word, form) as distinct rows. Copies of a row are dropped before the shuffle."""
    return tokens.filter(F.col("form").isNotNull() & (F.col("form") != "")).select("word", "form").distinct()


def forms_of_words(forms: DataFrame) -> DataFrame:
    """One row per word: its distinct forms as a sorted array."""
    return forms.groupBy("word").agg(F.array_sort(F.collect_set("form")).alias("forms"))


#: Copies of a word's forms, each for a share of the word's sheet rows.
SALTS = 16
#: A word with more forms than this has them dealt out without copies: its sheet rows are few by comparison.
MANY_FORMS = 1 << 16


def with_forms(rows: DataFrame, forms: DataFrame, salts: int = SALTS, folder: str | None = None) -> DataFrame:
    """Attach, as ``forms``, the analyser form of the cleaned headword that a sentence would be split at: the longest one in
    it, of equal length the first in order. Rows without one keep NULL.

    Forms and rows meet by headword and salt, and only pairs whose form is in the sentence come out of the join; a row's
    best form is an aggregate by its place. A headword with very many rows is spread over the salts, one with very many
    forms is spread by its forms, and no list of a word's forms is ever built.
    """
    spark = rows.sparkSession
    folder = folder or shared_dir(spark, "with-forms")
    placed(rows).write.parquet(folder)
    stored = spark.read.parquet(folder)

    many = forms.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") > MANY_FORMS).select("word", F.lit(True).alias("many"))
    own_salt, all_salts = F.pmod(F.xxhash64("form"), F.lit(salts)).cast("int"), F.sequence(F.lit(0), F.lit(salts - 1))
    # Of a word with many forms each has one salt and its rows have all; of others each row has one salt and its forms all.
    dealt = forms.select("word", "form").join(many, "word", "left").select(
        "word", "form", F.explode(F.when(F.col("many"), F.array(own_salt)).otherwise(all_salts)).alias("salt")
    )
    asked = stored.select(PART, NTH, clean_headword(F.col("Kanji")).alias("word"), F.col("Sentence").alias("sentence"))
    asked = asked.filter("sentence IS NOT NULL").join(many, "word", "left").select(
        PART, NTH, "word", "sentence",
        F.explode(F.when(F.col("many"), all_salts).otherwise(F.array(F.pmod(F.hash(NTH), F.lit(salts))))).alias("salt"),
    )
    f = dealt.select(F.col("word").alias("of"), F.col("salt").alias("at"), "form")
    hits = asked.join(f, (F.col("word") == F.col("of")) & (F.col("salt") == F.col("at")) & F.contains("sentence", "form"))
    best = hits.groupBy(PART, NTH).agg(F.min(F.struct((-F.length("form")).alias("size"), "form"))["form"].alias("best"))
    found = best.select(F.col(PART).alias("__p"), F.col(NTH).alias("__n"), F.array("best").alias("forms"))
    joined = stored.join(found, (F.col(PART) == F.col("__p")) & (F.col(NTH) == F.col("__n")), "left")
    return joined.select(*[f"`{c}`" for c in rows.columns], "forms")


def examples(rows: DataFrame, variant: Variant = CURRENT) -> DataFrame:
    """Add ``matched``, ``example_before`` and ``example_after``.

    Empty halves are NULL. A sentence without the word falls back to the sheet's supporting words; a row without
    a sentence has no example.
    """
    forms = F.col("forms") if "forms" in rows.columns else None
    has_sentence = strip(F.col("Sentence")) != ""
    split = split_sentence(F.col("Kanji"), F.col("Sentence"), variant, forms)
    rows = rows.withColumn(_SPLIT, F.when(has_sentence, split))

    def half(part: str, supporting: str) -> Column:
        return (
            F.when(F.col(_SPLIT).isNotNull(), blank_to_null(F.col(f"{_SPLIT}.{part}")))
            .when(has_sentence, F.col(f"`{supporting}`"))
        )

    return (
        rows.withColumn("matched", F.col(f"{_SPLIT}.matched"))
        .withColumn("example_before", half("before", "Supporting word 1"))
        .withColumn("example_after", half("after", "Supporting word 2"))
        .drop(_SPLIT)
    )


def enrich(rows: DataFrame, variant: Variant = CURRENT, strict_shii: bool | None = None) -> DataFrame:
    """Typed vocabulary columns of valid sheet rows, the calendar day as (week, day)."""
    strict = not variant.trims if strict_shii is None else strict_shii
    raw, lecture = F.col("Raw"), F.col("Lecture")
    return examples(rows, variant).select(
        "level",
        zero_to_null(to_int(F.col("Sr no"))).alias("ref_no"),
        F.col("Kanji").alias("kanji"),
        F.col("Hiragana").alias("hiragana"),
        F.col("Meaning").alias("meaning_en"),
        "matched",
        "example_before",
        "example_after",
        F.col("Hint").alias("hint"),
        F.col("Sentence").alias("full_sentence"),
        zero_to_null(to_int(F.col("`Page no.`"))).alias("page_no"),
        zero_to_null(lecture_week(lecture)).alias("week"),
        zero_to_null(lecture_day(lecture)).alias("day"),
        word_type(raw, F.col("Meaning"), strict).alias("word_type"),
        difficulty(raw).alias("difficulty_level"),
    )


def resolve_schedule(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Add ``schedule_id`` by (week, day), NULL where the calendar has no such day.

    One left join. The calendar is a few rows a week: Spark broadcasts it while it is under its threshold.
    """
    days = schedule.select(F.col("id").alias("schedule_id"), "week", "day")
    return rows.join(days, ["week", "day"], "left")


def level_id(level: Column, ref_no: Column, levels: tuple[str, ...] = ("N1", "N2", "N3")) -> Column:
    """Deterministic id in insertion order: levels in turn, sheet order inside. Needs no numbering pass.

    Unique where (level, ref_no) is.
    """
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), level)
    return F.shiftleft(F.nullif(position, F.lit(0)), 32) + ref_no


def ingest(
    rows: DataFrame, schedule: DataFrame, variant: Variant = CURRENT, levels: tuple[str, ...] = ("N1", "N2", "N3"),
    as_of: datetime | str | None = None,
) -> DataFrame:
    """The vocabulary table of valid, level-tagged sheet rows.

    A word without a number, or of a level that is not listed, gets an id from its cells. ``distinct_ids`` gives
    words of one id different ones.
    """
    words = resolve_schedule(enrich(rows, variant), schedule)
    numbered = level_id(F.col("level"), F.col("ref_no"), levels)
    words = words.withColumn("id", F.coalesce(numbered, row_id(*_CELLS))).withColumn("created_at", as_of_column(as_of))
    return words.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VOCABULARY.fields])


def distinct_ids(words: DataFrame, folder: str | None = None) -> DataFrame:
    """The words with an id each: words without an id, and all words of an id that repeats, get new ones above the rest.

    The words are stored once, so the ingest behind them runs once. Ids are counted by themselves, and new ones follow the
    order of the stored rows by their partitions' counts: no text is hashed, compared or sorted.
    """
    spark = words.sparkSession
    folder = folder or shared_dir(spark, "words")
    placed(words).write.parquet(folder)
    stored = spark.read.parquet(folder)
    counts = stored.groupBy("id").agg(F.count("*").alias("n"))
    repeated = counts.filter((F.col("n") > 1) | F.col("id").isNull()).select(F.col("id").alias("__repeated"), F.lit(True).alias("__new"))
    found = counts.agg(F.max("id").alias("last"), F.count_if((F.col("n") > 1) | F.col("id").isNull()).alias("repeated")).first()
    if not found["repeated"]:
        return stored.select(*words.columns)
    rows = numbered(stored, "__number", start=(found["last"] or 0) + 1)
    marked = rows.join(repeated, F.col("id").eqNullSafe(F.col("__repeated")), "left")
    return marked.withColumn("id", F.when(F.col("__new"), F.col("__number")).otherwise(F.col("id"))).select(*words.columns)
