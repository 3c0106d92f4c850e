"""Declared schemas and the fixed codes of the study tables."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEDULE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("week_day_label", T.StringType()),
])

VOCABULARY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("level", T.StringType(), False),
    T.StructField("ref_no", T.IntegerType()),
    T.StructField("kanji", T.StringType(), False),
    T.StructField("hiragana", T.StringType()),
    T.StructField("meaning_en", T.StringType()),
    T.StructField("example_before", T.StringType()),
    T.StructField("example_after", T.StringType()),
    T.StructField("hint", T.StringType()),
    T.StructField("full_sentence", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("schedule_id", T.IntegerType()),
    T.StructField("word_type", T.StringType()),
    T.StructField("difficulty_level", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# The single-level table keeps each learner's review state on the word itself.
STUDY_VOCABULARY = T.StructType(
    [f for f in VOCABULARY.fields if f.name not in ("level", "created_at")]
    + [
        T.StructField("is_marked", T.BooleanType()),
        T.StructField("times_reviewed", T.IntegerType()),
        T.StructField("last_reviewed", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

USER_MARKINGS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("word_id", T.LongType(), False),
    T.StructField("marking", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

# Column order of the markings CSV.
MARKINGS_CSV = T.StructType([f for f in USER_MARKINGS.fields if f.name != "id"])

STUDY_PROGRESS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("vocabulary_id", T.LongType()),
    T.StructField("review_date", T.DateType(), False),
    T.StructField("result", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# Sheet columns, read as text. The optional ones default to '' or NULL when a sheet lacks them.
SHEET_REQUIRED = ("Sr no",)
SHEET_DEFAULTS = {
    "Hiragana": "",
    "Meaning": "",
    "Hint": "",
    "Sentence": "",
    "Supporting word 1": None,
    "Supporting word 2": None,
    "Page no.": None,
    "Lecture": None,
}

# Declared lengths, NOT NULL columns, unique keys and defaults, per table.
MAX_LENGTHS = {
    "vocabulary": {"level": 5, "kanji": 100, "hiragana": 100, "word_type": 20},
    "schedule": {"week_day_label": 20},
    "study_progress": {"result": 20},
}
NOT_NULL = {
    "schedule": ("week", "day"),
    "vocabulary": ("level", "kanji"),
    "user_markings": ("user_id", "word_id"),
    "study_progress": ("review_date",),
}
UNIQUE_KEYS = {
    "schedule": (("id",), ("week", "day")),
    "vocabulary": (("id",),),
    "user_markings": (("id",), ("user_id", "word_id")),
    "study_progress": (("id",),),
}
NOW = object()  # default meaning "the load's clock"
DEFAULTS = {
    "vocabulary": {"difficulty_level": 1, "created_at": NOW},
    "study_vocabulary": {"difficulty_level": 1, "is_marked": False, "times_reviewed": 0, "created_at": NOW},
    "user_markings": {"marking": 0, "updated_at": NOW},
    "study_progress": {"created_at": NOW},
}

# Marking code -> label shown to the learner (0 has no label).
MARKING_LABELS = {
    1: "✓ Monthly Review",
    2: "💬 Cant use in conversation",
    3: "✍ Cant write",
    4: "🤔 Understand but cant use",
    5: "❌ Dont know at all",
}

# Marking code -> column of the progress report.
MARKING_COLUMNS = {
    1: "monthly_review",
    2: "cant_use_convo",
    3: "cant_write",
    4: "understand_cant_use",
    5: "dont_know",
}

# Difficulty code -> label.
DIFFICULTY_LABELS = {1: "Normal", 2: "Medium (＊)", 3: "Hard (＊＊)"}
