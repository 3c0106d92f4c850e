"""The study tables as views of the given star-schema tables.

Every binding reads its whole source table; values are derived row by row, none is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lexitrack.operators.maintain import latest_markings, record_review
from lexitrack.sources.calendar import week_day_label

# Headword, reading, and two surface texts: one put in front of the document, one behind it.
HEADWORDS = [
    ("足掻く", "あがく", "足掻きながら", "足掻いて"),
    ("食べる", "たべる", "食べた", "食べている"),
    ("美しい", "うつくしい", "美しさ", "美しく"),
    ("静か（な）", "しずか", "静かで", "静かに"),
    ("飲む", "のむ", "飲んで", "飲みました"),
    ("待つ", "まつ", "待ち", "待たされた"),
    ("高い", "たかい", "高め", "高ければ"),
    ("焦る", "あせる", "焦らず", "焦って"),
    ("行く", "いく", "行って", "行きます"),
    ("愛する", "あいする", "愛している", "愛した"),
    ("愛想がいい", "あいそがいい", "愛想のない", "愛想がよい"),
    ("凝らす ", "こらす", "凝らす", "凝らして"),
    ("急ぐ", "いそぐ", "急げば", "急いだり"),
    ("死ぬ", "しぬ", "死んだら", "死なない"),
    ("遊ぶ", "あそぶ", "遊べ", "遊ぼう"),
    ("会う＊", "あう", "会う＊", "会わなかった"),
    ("相子", "あいこ", "引き分け", "相子"),
    ("正面②", "しょうめん", "正面", "正面②"),
    ("綺麗な", "きれい", "綺麗じゃない", "綺麗だった"),
    ("悩みの種", "なやみのたね", "種", "悩み"),
    ("気になる+", "きになる", "気になった", "気にならない"),
    ("な", "な", "な", "ではない"),
    ("矯正", "きょうせい", "矯正", "矯正"),
    ("話す", "はなす", "話さなかった", "話したら"),
]
# Marks written behind the headword in the Raw column, by text length.
MARKS = ["", "＊", "＊＊", "**", "+", "（な）", "(な)"]

AS_OF_MARKINGS = "1998-07-01 00:00:00"
AS_OF_REVIEWS = "2024-01-28 12:00:00"
USER = "u1"
TITLE = "Vocabulary"  # a sheet's title line; one data row has the same cells
WIDE_SOURCE = "src17"  # its rows get a cell too many where rejects are tested
# Above every part and supplier key of the given tables.
PART_KEYS = 2_000_003
SUPPLIER_KEYS = 10_007


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as calendar days: the region is the week, the place within the region the day."""
    place = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    week = F.col("n_regionkey") + 1
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), week.alias("week"), place.alias("day"),
        week_day_label(week, place).alias("week_day_label"),
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as vocabulary. Sizes and brands decide which optional columns a word has."""
    size, brand, kind = F.col("p_size"), F.col("p_brand"), F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(kind.isin("ECONOMY", "STANDARD"), "N1").when(kind.isin("MEDIUM", "PROMO"), "N2").otherwise("N3").alias("level"),
        (F.col("p_partkey") + 1).cast("int").alias("ref_no"),
        F.col("p_name").alias("kanji"),
        F.when(size != 7, F.lower(brand)).alias("hiragana"),
        F.concat(kind, F.lit(" "), F.col("p_name")).alias("meaning_en"),
        F.when(size <= 20, "the ").alias("example_before"),
        F.when(size.between(10, 30), F.concat(F.lit(" of "), brand)).alias("example_after"),
        F.when(F.col("p_retailprice") > 1000, kind).alias("hint"),
        F.when(size.between(15, 35), F.concat(F.lit("see the "), F.col("p_name"))).alias("full_sentence"),
        F.when(size <= 45, size + 11).alias("page_no"),
        F.when(size <= 22, size - 1).when(size <= 44, size - 23).alias("schedule_id"),
        F.when(brand.startswith("Brand#1"), "verb").when(brand.startswith("Brand#2"), "い-adjective")
        .when(brand.isin("Brand#3", "Brand#4"), "な-adjective").when(brand == "Brand#5", "Unknown").alias("word_type"),
        F.when(size <= 30, 1).when(size <= 42, 2).otherwise(3).alias("difficulty_level"),
    )


def marking_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as marking changes: the supplier is the learner, the part the word.

    Only order, line, part and supplier together name a line of the given tables; the id holds all four.
    """
    line = F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        ((line * PART_KEYS + F.col("l_partkey")) * SUPPLIER_KEYS + F.col("l_suppkey")).alias("id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("user_id"),
        F.col("l_partkey").alias("word_id"),
        (F.col("l_quantity").cast("int") % 6).alias("marking"),
        F.col("l_shipdate").alias("updated_at"),
    )


def markings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_markings(marking_log(spark, sf_dir))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the review log."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("vocabulary_id"),
        F.to_date("ts").alias("review_date"),
        F.when(kind == "error", "incorrect").when(kind == "view", "partial").otherwise("correct").alias("result"),
        F.col("props").alias("notes"),
        F.col("ts").alias("created_at"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("word_id"), F.col("ts").alias("reviewed_at"))


def study_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with review state; verbs carry the attention flag."""
    fresh = (
        words(spark, sf_dir)
        .withColumn("is_marked", F.col("word_type") == "verb")
        .withColumn("times_reviewed", F.lit(0))
        .withColumn("last_reviewed", F.lit(None).cast("timestamp_ntz"))
    )
    return record_review(fresh, reviews(spark, sf_dir))


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sheet rows: the sentence is the whole document between two forms of a headword."""
    entries = ", ".join(f"named_struct('word', '{w}', 'reading', '{r}', 'early', '{a}', 'late', '{b}')" for w, r, a, b in HEADWORDS)
    marks = ", ".join(f"'{m}'" for m in MARKS)
    d = table(spark, sf_dir, "documents")
    n, length, lang = F.col("doc_id"), F.col("n_chars"), F.col("lang")
    d = d.withColumn("h", F.expr(f"element_at(array({entries}), cast(doc_id % {len(HEADWORDS)} + 1 as int))"))
    d = d.withColumn("mark", F.expr(f"element_at(array({marks}), cast(n_chars % {len(MARKS)} + 1 as int))"))
    week, day = (n % 13).cast("string"), (n % 8).cast("string")
    whole = F.concat(
        F.lit("　"), F.col("h.early"), F.lit("、"), F.replace("text", F.lit("\n"), F.lit(" ")), F.col("h.late"), F.lit("と言う。 ")
    )
    return d.select(
        F.when(lang == "en", "N1").when(lang == "fr", "N2").otherwise("N3").alias("level"),
        F.when(F.col("source") != "src19", (n + 1).cast("string")).alias("Sr no"),
        F.when(F.col("source") != "src18", F.col("h.word")).alias("Kanji"),
        F.concat("h.word", "mark").alias("Raw"),
        F.col("h.reading").alias("Hiragana"),
        F.when(length % 3 == 0, F.concat(F.lit("To "), lang)).when(length % 3 == 1, lang).alias("Meaning"),
        F.when(length % 2 == 0, F.concat(F.lit("it's "), F.col("source"))).alias("Hint"),
        F.when(length < 300, None).when(length < 400, F.lit("   ")).otherwise(whole).alias("Sentence"),
        F.concat(F.lit("before "), F.col("source")).alias("Supporting word 1"),
        F.when(lang != "fr", "after").alias("Supporting word 2"),
        F.when(length % 5 == 0, (length % 150).cast("string"))
        .when(length % 5 == 1, F.concat((length % 150).cast("string"), F.lit(".7")))
        .when(length % 5 == 2, "0").when(length % 5 == 3, "p. 3").alias("Page no."),
        F.when(lang == "de", F.concat(F.translate(week, "0123456789", "０１２３４５６７８９"), F.lit("週"), day, F.lit("日")))
        .when(lang == "es", F.concat(F.lit("週"), day, F.lit("日")))
        .otherwise(F.concat(week, F.lit("週"), day, F.lit("日(復習)"))).alias("Lecture"),
    )


def analyser_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyser output (word, form): the last surface text of each document's headword."""
    entries = ", ".join(f"named_struct('word', '{w}', 'late', '{b}')" for w, _, _, b in HEADWORDS)
    h = F.expr(f"element_at(array({entries}), cast(doc_id % {len(HEADWORDS)} + 1 as int))")
    forms = F.array("h.word", F.concat("h.late", F.lit("と")), F.col("h.late"))
    return (
        table(spark, sf_dir, "documents").select(h.alias("h"))
        .select(F.translate("h.word", "＊*+（）()①②③④⑤ ", "").alias("word"), F.explode(forms).alias("form"))
    )
