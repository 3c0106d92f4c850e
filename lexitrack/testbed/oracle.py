"""The queries as plain SQL over the given tables, for DuckDB.

Where the Spark side uses an array expression or an aggregate over a struct, the SQL uses joins and row numbers, so
both sides reach the result by different ways. Rule tables come from the same fixed values.
"""

from __future__ import annotations

from lexitrack.testbed import bindings as b
from lexitrack.functions.conjugation import CURRENT, FIRST, INTERIM, PARTICLES, Variant, rules
from lexitrack.schema import DIFFICULTY_LABELS, MARKING_COLUMNS, MARKING_LABELS, MAX_LENGTHS

U = b.USER
SEED = 7


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    def cell(v):
        return _text(v) if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)


SCHEDULE = """schedule AS (
  SELECT *, concat(week, '週', day, '日') AS week_day_label FROM (
    SELECT n_nationkey AS id, n_regionkey + 1 AS week,
           CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INT) AS day FROM nation))"""

WORDS = """words AS (
  SELECT p_partkey AS id,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'N1' WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'N2' ELSE 'N3' END AS level,
    CAST(p_partkey + 1 AS INT) AS ref_no,
    p_name AS kanji,
    CASE WHEN p_size <> 7 THEN lower(p_brand) END AS hiragana,
    p_type || ' ' || p_name AS meaning_en,
    CASE WHEN p_size <= 20 THEN 'the ' END AS example_before,
    CASE WHEN p_size BETWEEN 10 AND 30 THEN ' of ' || p_brand END AS example_after,
    CASE WHEN p_retailprice > 1000 THEN p_type END AS hint,
    CASE WHEN p_size BETWEEN 15 AND 35 THEN 'see the ' || p_name END AS full_sentence,
    CASE WHEN p_size <= 45 THEN p_size + 11 END AS page_no,
    CASE WHEN p_size <= 22 THEN p_size - 1 WHEN p_size <= 44 THEN p_size - 23 END AS schedule_id,
    CASE WHEN p_brand LIKE 'Brand#1%' THEN 'verb' WHEN p_brand LIKE 'Brand#2%' THEN 'い-adjective'
         WHEN p_brand IN ('Brand#3', 'Brand#4') THEN 'な-adjective' WHEN p_brand = 'Brand#5' THEN 'Unknown' END AS word_type,
    CASE WHEN p_size <= 30 THEN 1 WHEN p_size <= 42 THEN 2 ELSE 3 END AS difficulty_level
  FROM part)"""

LOG = f"""log AS (
  SELECT ((CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * {b.PART_KEYS} + l_partkey) * {b.SUPPLIER_KEYS} + l_suppkey AS id, concat('u', l_suppkey) AS user_id, l_partkey AS word_id,
         CAST(l_quantity AS INT) % 6 AS marking, l_shipdate AS updated_at FROM lineitem)"""

MARKINGS = LOG + """,
markings AS (
  SELECT f.id, n.user_id, n.word_id, n.marking, n.updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, word_id ORDER BY updated_at DESC, id DESC, marking DESC) AS rn
        FROM log) n
  JOIN (SELECT user_id, word_id, min(id) AS id FROM log GROUP BY user_id, word_id) f
    ON n.user_id = f.user_id AND n.word_id = f.word_id
  WHERE rn = 1)"""

PROGRESS = """progress AS (
  SELECT event_id AS id, user_id AS vocabulary_id, CAST(ts AS DATE) AS review_date,
         CASE event_type WHEN 'error' THEN 'incorrect' WHEN 'view' THEN 'partial' ELSE 'correct' END AS result,
         props AS notes, ts AS created_at FROM events)"""

STUDY = WORDS + """,
study AS (
  SELECT w.*, w.word_type = 'verb' AS is_marked, CAST(coalesce(n, 0) AS INT) AS times_reviewed, last_reviewed
  FROM words w LEFT JOIN (SELECT user_id, count(*) AS n, max(ts) AS last_reviewed FROM events GROUP BY user_id) e
    ON w.id = e.user_id)"""

SHEET = f"""heads(pos, word, reading, early, late) AS ({_values((i, *h) for i, h in enumerate(b.HEADWORDS))}),
marks(pos, mark) AS ({_values(enumerate(b.MARKS))}),
sheet AS (
  SELECT CASE lang WHEN 'en' THEN 'N1' WHEN 'fr' THEN 'N2' ELSE 'N3' END AS level,
    CASE WHEN source <> 'src19' THEN CAST(doc_id + 1 AS VARCHAR) END AS sr_no,
    CASE WHEN source <> 'src18' THEN word END AS kanji,
    word || mark AS raw,
    reading AS hiragana,
    CASE n_chars % 3 WHEN 0 THEN 'To ' || lang WHEN 1 THEN lang END AS meaning,
    CASE WHEN n_chars % 2 = 0 THEN 'it''s ' || source END AS hint,
    CASE WHEN n_chars < 300 THEN NULL WHEN n_chars < 400 THEN '   '
         ELSE '　' || early || '、' || replace(text, chr(10), ' ') || late || 'と言う。 ' END AS sentence,
    'before ' || source AS supporting_1,
    CASE WHEN lang <> 'fr' THEN 'after' END AS supporting_2,
    CASE n_chars % 5 WHEN 0 THEN CAST(n_chars % 150 AS VARCHAR) WHEN 1 THEN concat(n_chars % 150, '.7')
         WHEN 2 THEN '0' WHEN 3 THEN 'p. 3' END AS page_no,
    CASE lang WHEN 'de' THEN concat(translate(CAST(doc_id % 13 AS VARCHAR), '0123456789', '０１２３４５６７８９'), '週', doc_id % 8, '日')
         WHEN 'es' THEN concat('週', doc_id % 8, '日')
         ELSE concat(doc_id % 13, '週', doc_id % 8, '日(復習)') END AS lecture
  FROM documents JOIN heads h ON doc_id % {len(b.HEADWORDS)} = h.pos JOIN marks m ON n_chars % {len(b.MARKS)} = m.pos)"""

_STRIP = r"regexp_replace({0}, '^[\s　]+|[\s　]+$', '', 'g')"
_LECTURE = "TRY_CAST(translate(regexp_extract(lecture, '^([0-9０-９]+)週([0-9０-９]+)日', {0}), '０１２３４５６７８９', '0123456789') AS INT)"
_PAGE = "TRY_CAST(trunc(TRY_CAST(page_no AS DOUBLE)) AS INT)"
_DIFFICULTY = "CASE WHEN raw LIKE '%＊＊%' OR raw LIKE '%**%' THEN 3 WHEN raw LIKE '%＊%' OR raw LIKE '%*%' OR raw LIKE '%+%' THEN 2 ELSE 1 END"
_COLUMNS = "sr_no, kanji, raw, hiragana, meaning, hint, sentence, supporting_1, supporting_2, page_no, lecture"


def _word_type(strict: bool) -> str:
    bare = "regexp_replace(raw, '[＊*+（）()]', '', 'g')"
    shii = f"AND {bare} NOT LIKE '%しい'" if strict else ""
    return f"""CASE WHEN raw LIKE '%(な)%' OR raw LIKE '%（な）%' THEN 'な-adjective'
      WHEN lower(meaning) LIKE 'to %' THEN 'verb'
      WHEN {bare} LIKE '_%い' {shii} THEN 'い-adjective'
      WHEN regexp_matches({bare}, '[るすくぐむぶつう]$') THEN 'verb' END"""


def _candidates(variant: Variant, source: str, forms: bool = False) -> str:
    """All (key, grp, ord, sub, form, display) of the headwords in ``source`` (key, kanji)."""
    trim = _STRIP.format("kanji") if variant.trims else "kanji"
    rule_rows = _values((r.ending, i, r.suffix, r.display) for i, r in enumerate(rules(variant)))
    particles = _values(enumerate(PARTICLES.split()))
    dropped = "UNION ALL SELECT key, 7, p.pos, 1000, replace(c, p.particle, ''), '' FROM h JOIN particles p ON contains(c, p.particle)"
    analysed = "UNION ALL SELECT key, 3, 0, t.pos, t.form, '' FROM h JOIN analysed t ON h.c = t.word"
    return f"""rules(ending, pos, suffix, display) AS ({rule_rows}),
particles(pos, particle) AS ({particles}),
h AS (SELECT key, w, {_STRIP.format("regexp_replace(w, '[＊*+（）()①②③④⑤]', '', 'g')")} AS c
      FROM (SELECT key, {trim} AS w FROM {source})),
cand AS (
  SELECT * FROM (
    SELECT key, 1 AS grp, 0 AS ord, 0 AS sub, w AS form, '' AS display FROM h
    UNION ALL SELECT key, 2, 0, 0, c, '' FROM h
    {analysed if forms else ''}
    UNION ALL SELECT key, 4, r.pos, 0, left(c, length(c) - 1) || r.suffix, r.display
      FROM h JOIN rules r ON right(c, 1) = r.ending WHERE length(c) > 1 OR c = 'な'
    UNION ALL SELECT key, 7, p.pos, generate_subscripts(string_split(c, p.particle), 1), unnest(string_split(c, p.particle)), ''
      FROM h JOIN particles p ON contains(c, p.particle)
    {dropped if variant.drops_particle else ''}
  ) WHERE form <> '')"""


VALID = SHEET + ",\nvalid AS (SELECT * FROM sheet WHERE sr_no IS NOT NULL AND kanji IS NOT NULL)"

TOKENS = f"""tokens AS (
  SELECT DISTINCT regexp_replace(word, '[＊*+（）()①②③④⑤ ]', '', 'g') AS word, unnest([word, late || 'と', late]) AS form
  FROM documents JOIN heads h ON doc_id % {len(b.HEADWORDS)} = h.pos),
analysed AS (SELECT word, form, row_number() OVER (PARTITION BY word ORDER BY form) AS pos FROM tokens)"""


def _split(variant: Variant, forms: bool = False) -> str:
    trim = _STRIP.format("sentence") if variant.trims else "sentence"
    return (
        VALID + (",\n" + TOKENS if forms else "") + ",\n"
        "src AS (SELECT sr_no AS key, kanji FROM valid),\n" + _candidates(variant, "src", forms) + f""",
hit AS (
  SELECT sr_no, s, form, display, row_number() OVER (PARTITION BY sr_no ORDER BY length(form) DESC, grp, ord, sub) AS rn
  FROM (SELECT sr_no, {trim} AS s FROM valid) v JOIN cand ON v.sr_no = cand.key AND contains(s, form)),
split AS (
  SELECT sr_no, form AS matched, left(s, strpos(s, form) - 1) AS "before",
         display || substr(s, strpos(s, form) + length(form)) AS "after"
  FROM hit WHERE rn = 1)"""
    )


def _enriched(variant: Variant = CURRENT, forms: bool = False) -> str:
    def half(part, supporting):
        return f"CASE WHEN matched IS NOT NULL THEN nullif({part}, '') WHEN trim(sentence, ' 　') <> '' THEN {supporting} END"

    return _split(variant, forms) + f""",
enriched AS (
  SELECT level, CAST(sr_no AS INT) AS ref_no, kanji, hiragana, meaning AS meaning_en, matched,
    {half('"before"', 'supporting_1')} AS example_before, {half('"after"', 'supporting_2')} AS example_after,
    hint, sentence AS full_sentence, nullif({_PAGE}, 0) AS page_no,
    nullif({_LECTURE.format(1)}, 0) AS week, nullif({_LECTURE.format(2)}, 0) AS day,
    {_word_type(not variant.trims)} AS word_type, {_DIFFICULTY} AS difficulty_level, sr_no
  FROM valid LEFT JOIN split USING (sr_no))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _percent(part: str, whole: str) -> str:
    """100 * part / whole to one decimal, half up, in whole numbers."""
    return f"CAST((2000 * ({part}) + ({whole})) // (2 * nullif({whole}, 0)) AS DOUBLE) / 10"


def _quote(c: str) -> str:
    return f"coalesce('''' || replace({c}, '''', '''''') || '''', 'NULL')"


def _label(c: str, labels: dict) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in labels.items()) + " END"


_FLAG = "CAST(sum(CASE WHEN {0} THEN 1 ELSE 0 END) AS BIGINT)"
_FULL = """SELECT v.id, level, ref_no, kanji, hiragana, meaning_en, example_before, example_after, full_sentence, hint, page_no,
  word_type, difficulty_level, week, day, week_day_label FROM words v LEFT JOIN schedule s ON v.schedule_id = s.id"""
_EXAMPLE = "example_before || kanji || example_after"
_MARKED = f"FROM words v JOIN markings m ON v.id = m.word_id WHERE m.user_id = '{U}'"
_KEY = f"md5(concat('{SEED}:', id))"
_PICK = f"ORDER BY {_KEY}, id LIMIT"
_PROGRESS_SUMS = ", ".join(f"{_FLAG.format(f'm.marking = {k}')} AS {v}" for k, v in MARKING_COLUMNS.items())
_TUPLE = f"""concat('    (', concat_ws(', ', {_quote('level')}, coalesce(CAST(ref_no AS VARCHAR), 'NULL'), {_quote('kanji')}, {_quote('hiragana')}, {_quote('meaning_en')}),
  ',' || chr(10) || '     ', concat_ws(', ', {_quote('example_before')}, {_quote('example_after')}, {_quote('hint')}, {_quote('full_sentence')}),
  ',' || chr(10) || '     ', concat_ws(', ', coalesce(CAST(page_no AS VARCHAR), 'NULL'),
    coalesce('(SELECT id FROM schedule WHERE week = ' || week || ' AND day = ' || day || ')', 'NULL'),
    {_quote('word_type')}, CAST(difficulty_level AS VARCHAR)), ')')"""
_SCRIPT = """ref_no, kanji, hiragana, meaning_en, example_before, example_after, hint, full_sentence, page_no,
  CASE WHEN day IS NOT NULL THEN week END AS week, CASE WHEN week IS NOT NULL THEN day END AS day, word_type, difficulty_level FROM enriched"""


def _candidate_list(variant: Variant) -> str:
    return _with(
        VALID, "src AS (SELECT DISTINCT kanji AS key, kanji FROM valid)", _candidates(variant, "src"),
        "firsts AS (SELECT *, row_number() OVER (PARTITION BY key, form ORDER BY grp, ord, sub) AS rn FROM cand)",
    ) + """SELECT key AS kanji, CAST(row_number() OVER (PARTITION BY key ORDER BY grp, ord, sub) - 1 AS INT) AS position, form, display
FROM firsts WHERE rn = 1"""


def _quiz(question: str, answer: str) -> str:
    return _with(WORDS, PROGRESS) + f"""SELECT id, concat_ws(' / ', {question}) AS question, concat_ws(' / ', {answer}) AS answer
FROM words WHERE id IN (SELECT vocabulary_id FROM progress WHERE result = 'incorrect')"""


def _new_id(*columns: str) -> str:
    """The id of an inserted row."""
    named = " || ".join(f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', {c}), '-')" for c in columns)
    return f"CAST('0x' || left(md5({named}), 15) AS BIGINT) + {1 << 60}"


def oracle_sql() -> dict[str, str]:
    days = "CAST(ts AS DATE)"
    due = f"updated_at < TIMESTAMP '{b.AS_OF_MARKINGS}' - INTERVAL 3 DAY"
    own = f"(SELECT * FROM markings WHERE user_id = '{U}')"
    return {
        "read_sheet": _with(SHEET) + f"SELECT {_COLUMNS} FROM sheet".replace("sentence", "CASE WHEN sentence <> '' THEN sentence END AS sentence")
        + f" UNION ALL SELECT '{b.TITLE}'" + ", NULL" * 10,
        "read_sheet_titles": _with(SHEET) + f"SELECT {_COLUMNS} FROM sheet".replace("sentence", "CASE WHEN sentence <> '' THEN sentence END AS sentence")
        + "".join(f" UNION ALL SELECT '{t}'" + ", NULL" * 10 for t in (b.TITLE, "Words"))
        + " UNION ALL SELECT 'Sr no', 'Kanji', 'Raw', 'Hiragana', 'Meaning', 'Hint', 'Sentence', 'Supporting word 1', 'Supporting word 2', 'Page no.', 'Lecture'",
        "read_sheet_line_breaks": _with(SHEET) + f"SELECT {_COLUMNS} FROM sheet".replace(
            "hint", """hint || chr(10) || '"' || raw || '",' || chr(10) || chr(10) || 'Sr no,Kanji' AS hint"""
        ).replace("sentence", "CASE WHEN sentence <> '' THEN sentence END AS sentence"),
        "load_rejects": _with(SHEET) + f"SELECT level, sr_no FROM sheet WHERE supporting_1 = 'before {b.WIDE_SOURCE}'",
        "load_levels": _with(VALID) + f"SELECT {_COLUMNS}, level FROM valid",
        "valid_rows": _with(VALID) + f"SELECT {_COLUMNS} FROM valid",
        "conform_schema": _with(SHEET) + """SELECT sr_no, raw AS kanji, '' AS hiragana, meaning, '' AS hint, sentence,
  CAST(NULL AS VARCHAR) AS supporting_1, CAST(NULL AS VARCHAR) AS page_no, CAST(NULL AS VARCHAR) AS lecture
FROM sheet WHERE sr_no IS NOT NULL""",
        "schedule_dim": _with(
            SHEET, "days AS (SELECT CAST(i AS INT) AS id, CAST((i - 1) // 7 + 1 AS INT) AS week, CAST((i - 1) % 7 + 1 AS INT) AS day FROM range(1, 78) r(i))",
            f"named AS (SELECT {_LECTURE.format(1)} AS week, {_LECTURE.format(2)} AS day FROM sheet)",
        ) + """SELECT d.id, d.week, d.day, concat(d.week, '週', d.day, '日') AS week_day_label, count(n.week) AS sheet_rows
FROM days d LEFT JOIN named n ON d.week = n.week AND d.day = n.day GROUP BY d.id, d.week, d.day""",
        "distinct_ids": _with(VALID) + "SELECT 2 * count(*) AS words, 2 * count(*) AS ids FROM valid",
        "distinct_ids_null_and_empty": _with(VALID) + """SELECT 3 * count(*) AS words, 3 * count(*) AS ids,
  3 * count(*) FILTER (hint IS NULL) AS without_hint, 3 * count(*) FILTER (hint IS NULL) AS ids_without_hint FROM valid""",
        "vocab_sink": _with(_enriched(), SCHEDULE) + f"""SELECT CASE e.level WHEN 'N1' THEN 1 WHEN 'N2' THEN 2 ELSE 3 END * 4294967296 + ref_no AS id,
  e.level, ref_no, kanji, hiragana, meaning_en, example_before, example_after, hint, full_sentence, page_no, s.id AS schedule_id,
  word_type, difficulty_level, TIMESTAMP '{b.AS_OF_REVIEWS}' AS created_at FROM enriched e LEFT JOIN schedule s ON e.week = s.week AND e.day = s.day""",
        "insert_script_export": _with(_enriched()) + f"SELECT level, ref_no, {_TUPLE} AS tuple FROM enriched",
        "insert_script_import": _with(_enriched()) + f"SELECT level, {_SCRIPT}",
        "insert_script_import_first": _with(_enriched(FIRST)) + f"SELECT {_SCRIPT}",
        "insert_script_awkward": _with(_enriched()) + f"SELECT level, {_SCRIPT}".replace(" hint,", """
  hint || concat('),', chr(10), '    (''N1'', 2,', chr(10), ')', chr(10), ';', chr(10), '-- it''s', chr(10)) AS hint,"""),
        "markings_export": _with(MARKINGS) + f"SELECT user_id, word_id, marking, updated_at FROM markings WHERE user_id = '{U}' ORDER BY word_id",
        "markings_import": _with(MARKINGS) + f"""SELECT id, user_id, word_id,
  CASE WHEN user_id = '{U}' THEN (marking + 1) % 6 ELSE marking END AS marking,
  CASE WHEN user_id = '{U}' THEN TIMESTAMP '{b.AS_OF_MARKINGS}' ELSE updated_at END AS updated_at FROM markings""",
        "anki_export": _with(WORDS) + """SELECT coalesce(kanji || chr(9) || hiragana || ' - ' || meaning_en, '') AS anki_format FROM words
ORDER BY ref_no, id""",
        "example_export": _with(WORDS) + f"""SELECT kanji, hiragana, meaning_en, coalesce(full_sentence, {_EXAMPLE}) AS example
FROM words WHERE full_sentence IS NOT NULL OR example_before IS NOT NULL ORDER BY ref_no""",
        "vocab_with_markings_export": _with(WORDS, MARKINGS) + f"""SELECT v.id AS word_id, level, kanji, hiragana, meaning_en, coalesce(m.marking, 0) AS marking
FROM words v LEFT JOIN markings m ON v.id = m.word_id AND m.user_id = '{U}' WHERE level = 'N1' ORDER BY v.id""",
        "import_verify": _with(WORDS, SCHEDULE) + """SELECT 'total' AS "check", '' AS item, count(*) AS value FROM words
UNION ALL SELECT 'with_examples', '', count(*) FROM words WHERE example_before IS NOT NULL
UNION ALL SELECT 'level', level, count(*) FROM words GROUP BY level
UNION ALL SELECT 'week', CAST(s.week AS VARCHAR), count(v.id) FROM schedule s LEFT JOIN words v ON v.schedule_id = s.id GROUP BY s.week""",
        "project_rename": _with(WORDS) + f"SELECT kanji, hiragana, meaning_en, {_EXAMPLE} AS example FROM words",
        "level_filter": _with(WORDS, SCHEDULE) + f"SELECT id, level, kanji, hiragana, meaning_en FROM ({_FULL}) WHERE level = 'N1' AND week = 1 AND day = 2",
        "difficult_words": _with(WORDS) + "SELECT id, level, kanji, hiragana, meaning_en, hint FROM words WHERE difficulty_level = 3",
        "threshold": _with(MARKINGS) + "SELECT * FROM markings WHERE marking >= 3",
        "not_reviewed": _with(STUDY) + "SELECT id, kanji, hiragana, meaning_en FROM study WHERE times_reviewed = 0",
        "null_tests": _with(WORDS) + "SELECT id, full_sentence, example_before FROM words WHERE full_sentence IS NOT NULL OR example_before IS NOT NULL",
        "boolean_flag": _with(STUDY) + "SELECT id, kanji, hiragana, meaning_en, hint FROM study WHERE is_marked = TRUE",
        "search_kanji": _with(WORDS) + "SELECT id, level, kanji, hiragana, meaning_en FROM words WHERE kanji LIKE '%ring%'",
        "search_reading": _with(WORDS) + "SELECT id, level, kanji, hiragana, meaning_en FROM words WHERE hiragana LIKE '%#2%'",
        "search_reading_or_kanji": _with(WORDS) + "SELECT id, level, kanji, hiragana, meaning_en FROM words WHERE kanji LIKE '%bolt%' OR hiragana LIKE '%#1%'",
        "search_meaning": _with(WORDS) + "SELECT id, level, kanji, hiragana, meaning_en FROM words WHERE meaning_en ILIKE '%eco%' OR meaning_en ILIKE '%Ring%'",
        "point_lookup": _quiz("kanji, meaning_en", "hiragana"),
        "point_lookup_reading": _quiz("hiragana, meaning_en", "kanji"),
        "point_lookup_meaning": _quiz("meaning_en", "kanji, hiragana"),
        "due_interval": _with(MARKINGS) + f"SELECT * FROM markings WHERE {due}",
        "literal_column": _with(WORDS) + "SELECT 'Vocabulary entries:' AS info, count(*) AS count FROM words",
        "words_by_week": _with(WORDS, SCHEDULE) + f"""SELECT kanji, hiragana, meaning_en, {_EXAMPLE} AS example, week_day_label
FROM words v JOIN schedule s ON v.schedule_id = s.id WHERE level = 'N1' AND week = 1 ORDER BY day, ref_no""",
        "words_by_day": _with(WORDS, SCHEDULE) + f"""SELECT kanji, hiragana, meaning_en, {_EXAMPLE} AS example
FROM words v JOIN schedule s ON v.schedule_id = s.id WHERE week = 1 AND day = 1 ORDER BY ref_no""",
        "vocabulary_full": _with(WORDS, SCHEDULE) + _FULL,
        "user_marked_words": _with(WORDS, MARKINGS) + f"""SELECT level, kanji, hiragana, meaning_en, marking, {_label('marking', MARKING_LABELS)} AS marking_label
{_MARKED} ORDER BY marking DESC, level""",
        "left_join_on_residual": _with(WORDS, MARKINGS) + f"""SELECT v.id, level, m.id AS marking_id, marking
FROM words v LEFT JOIN markings m ON v.id = m.word_id AND m.user_id = '{U}'""",
        "orphaned_markings": _with(MARKINGS) + "SELECT m.* FROM markings m LEFT JOIN customer c ON m.word_id = c.c_custkey WHERE c.c_custkey IS NULL",
        "left_then_not_null": _with(WORDS, SCHEDULE) + """SELECT v.id, s.week, s.day FROM schedule s LEFT JOIN words v ON v.schedule_id = s.id WHERE v.id IS NOT NULL""",
        "in_subquery_delete_set": _with(WORDS, MARKINGS) + f"SELECT * FROM markings WHERE user_id = '{U}' AND word_id IN (SELECT id FROM words WHERE level = 'N1')",
        "schedule_key_lookup": _with(SHEET, SCHEDULE, f"k AS (SELECT {_LECTURE.format(1)} AS week, {_LECTURE.format(2)} AS day, count(*) AS n FROM sheet GROUP BY ALL)")
        + "SELECT k.week, k.day, k.n, (SELECT id FROM schedule s WHERE s.week = k.week AND s.day = k.day) AS schedule_id FROM k",
        "history_for_word": _with(WORDS, PROGRESS) + """SELECT kanji, review_date, result, notes FROM progress p JOIN words v ON v.id = p.vocabulary_id
WHERE kanji = 'red bolt' ORDER BY review_date DESC""",
        "schedule_left_vocab": _with(WORDS, SCHEDULE) + """SELECT week_day_label, week, day, count(v.id) AS word_count
FROM schedule s LEFT JOIN words v ON v.schedule_id = s.id GROUP BY s.id, week_day_label, week, day ORDER BY week, day""",
        "count_total": _with(WORDS) + "SELECT count(*) AS total_words FROM words",
        "count_by_level": _with(WORDS) + "SELECT level, count(*) AS count FROM words GROUP BY level ORDER BY level",
        "level_summary": _with(WORDS) + """SELECT level, count(*) AS total_words, count(CASE WHEN full_sentence IS NOT NULL THEN 1 END) AS words_with_sentences
FROM words GROUP BY level ORDER BY level""",
        "sentence_coverage": _with(WORDS) + """SELECT level, count(*) AS total, count(full_sentence) AS with_sentence,
  count(*) - count(full_sentence) AS without_sentence FROM words GROUP BY level ORDER BY level""",
        "words_per_day": _with(WORDS, SCHEDULE) + """SELECT level, week_day_label, week, day, count(v.id) AS word_count
FROM schedule s LEFT JOIN words v ON v.schedule_id = s.id WHERE v.id IS NOT NULL GROUP BY level, s.id, week_day_label, week, day""",
        "study_summary": _with(STUDY, SCHEDULE) + f"""SELECT week_day_label, count(v.id) AS total_words, {_FLAG.format('is_marked')} AS marked_words,
  {_FLAG.format('times_reviewed > 0')} AS reviewed_words FROM schedule s LEFT JOIN study v ON v.schedule_id = s.id GROUP BY s.id, week_day_label, week, day""",
        "study_summary_week": _with(STUDY, SCHEDULE) + f"""SELECT week_day_label, count(v.id) AS total_words, {_FLAG.format('is_marked')} AS marked_words,
  {_FLAG.format('times_reviewed > 0')} AS reviewed_words FROM schedule s LEFT JOIN study v ON v.schedule_id = s.id WHERE week = 1 GROUP BY s.id, week_day_label, week, day""",
        "progress_by_level": _with(WORDS, MARKINGS) + f"""SELECT level, count(*) AS total_words, count(m.id) AS marked_words, {_PROGRESS_SUMS},
  {_percent('count(m.id)', 'count(*)')} AS percent_marked
FROM words v LEFT JOIN markings m ON v.id = m.word_id AND m.user_id = '{U}' GROUP BY level ORDER BY level""",
        "weekly_progress": _with(STUDY, SCHEDULE) + f"""SELECT week, count(v.id) AS total_words, {_FLAG.format('times_reviewed > 0')} AS reviewed,
  {_percent(_FLAG.format('times_reviewed > 0'), 'count(v.id)')} AS percent_done
FROM schedule s LEFT JOIN study v ON v.schedule_id = s.id GROUP BY week ORDER BY week""",
        "overall_progress": _with(STUDY) + f"""SELECT count(*) AS total_words, {_FLAG.format('times_reviewed > 0')} AS reviewed_words,
  {_FLAG.format('is_marked')} AS marked_words, {_percent(_FLAG.format('times_reviewed > 0'), 'count(*)')} AS percent_complete FROM study""",
        "type_distribution": _with(WORDS) + "SELECT level, coalesce(word_type, 'Unknown') AS type, count(*) AS count FROM words GROUP BY level, word_type",
        "type_distribution_overall": _with(WORDS) + "SELECT coalesce(word_type, 'Unknown') AS type, count(*) AS count FROM words GROUP BY word_type",
        "difficulty_distribution": _with(WORDS) + f"""SELECT {_label('difficulty_level', DIFFICULTY_LABELS)} AS difficulty, count(*) AS count
FROM words GROUP BY difficulty_level ORDER BY difficulty_level""",
        "duplicate_headwords": _with(WORDS) + "SELECT kanji, level, count(*) AS count FROM words GROUP BY kanji, level HAVING count(*) > 1",
        "top_markers": _with(MARKINGS) + f"""SELECT user_id, count(*) AS total_markings, {_FLAG.format('marking = 5')} AS dont_know_count
FROM markings GROUP BY user_id ORDER BY total_markings DESC, user_id LIMIT 10""",
        "frequent_wrong": _with(WORDS, PROGRESS) + f"""SELECT kanji, hiragana, count(p.id) AS review_count, {_FLAG.format("result = 'incorrect'")} AS wrong_count
FROM words v JOIN progress p ON p.vocabulary_id = v.id GROUP BY v.id, kanji, hiragana HAVING {_FLAG.format("result = 'incorrect'")} > 0""",
        "database_summary": _with(WORDS) + """SELECT 'Vocabulary' AS table_name, (SELECT count(*) FROM words) AS total_rows,
  (SELECT count(*) FROM words WHERE level = 'N1') AS n1_count, (SELECT count(*) FROM words WHERE level = 'N2') AS n2_count,
  (SELECT count(*) FROM words WHERE level = 'N3') AS n3_count""",
        "split_stats": _with(_enriched()) + f"""SELECT level, total_with_sentence, auto_generated, conjugation_preserved,
  {_percent('auto_generated', 'total_with_sentence')} AS percent_split FROM (
  SELECT level, count(*) FILTER (trim(full_sentence, ' 　') <> '') AS total_with_sentence, count(matched) AS auto_generated,
    count(*) FILTER (matched IS NOT NULL AND example_after LIKE '～%') AS conjugation_preserved FROM enriched GROUP BY level)""",
        "week_histogram": _with(SHEET) + f"SELECT week, count(*) AS count FROM (SELECT {_LECTURE.format(1)} AS week FROM sheet) WHERE week <> 0 GROUP BY week",
        "multi_key_sort": _with(WORDS, MARKINGS) + f"SELECT level, kanji, marking {_MARKED.replace(U, 'u3')} ORDER BY marking DESC, level",
        "nulls_first_due": _with(STUDY) + f"""SELECT kanji, hiragana, meaning_en, last_reviewed FROM study
WHERE last_reviewed < TIMESTAMP '{b.AS_OF_REVIEWS}' - INTERVAL 3 DAY OR last_reviewed IS NULL ORDER BY last_reviewed NULLS FIRST, id LIMIT 20""",
        "limit_rows": _with(WORDS) + "SELECT * FROM words ORDER BY id LIMIT 10",
        "random_quiz": _with(WORDS) + f"SELECT kanji, hiragana, meaning_en FROM words WHERE level = 'N1' {_PICK} 10",
        "random_quiz_week": _with(WORDS, SCHEDULE) + f"SELECT id, kanji, hiragana, meaning_en FROM ({_FULL}) WHERE week = 1 {_PICK} 10",
        "random_quiz_difficult": _with(WORDS) + f"SELECT kanji, hiragana, meaning_en, hint FROM words WHERE difficulty_level = 3 {_PICK} 10",
        "random_quiz_example": _with(WORDS) + f"""SELECT kanji, hiragana, meaning_en, example_before || '【' || kanji || '】' || example_after AS context
FROM words WHERE example_before IS NOT NULL AND level = 'N1' {_PICK} 10""",
        "random_quiz_unreviewed": _with(STUDY) + f"SELECT kanji, hiragana, meaning_en FROM study WHERE times_reviewed = 0 {_PICK} 20",
        "random_within_level": _with(WORDS) + f"SELECT level, kanji, hiragana, meaning_en, hint FROM words WHERE difficulty_level = 3 ORDER BY level, {_KEY}, id LIMIT 10",
        "hardest_first": _with(WORDS, MARKINGS) + f"SELECT level, kanji, hiragana, meaning_en, marking {_MARKED} AND marking > 0 ORDER BY marking DESC",
        "unknown_words": _with(WORDS, MARKINGS) + f"SELECT level, kanji, hiragana, meaning_en, hint, updated_at {_MARKED} AND marking = 5 ORDER BY updated_at DESC",
        "due_words": _with(WORDS, MARKINGS) + f"SELECT level, kanji, hiragana, meaning_en, marking, updated_at {_MARKED} AND marking >= 3 AND {due} ORDER BY updated_at",
        "context_concat": _with(WORDS) + f"SELECT id, {_EXAMPLE} AS example, example_before || '【' || kanji || '】' || example_after AS context FROM words",
        "marking_label": _with(MARKINGS) + f"SELECT id, {_label('marking', MARKING_LABELS)} AS marking_label FROM markings",
        "case_flag": _with(MARKINGS) + "SELECT id, CASE WHEN marking = 5 THEN 1 ELSE 0 END AS dont_know FROM markings",
        "coalesce_label": _with(WORDS) + "SELECT id, coalesce(word_type, 'Unknown') AS type FROM words",
        "percent": _with(MARKINGS) + f"SELECT user_id, {_percent('count(*) FILTER (marking = 5)', 'count(*)')} AS percent_hard FROM markings GROUP BY user_id",
        "like_ilike": _with(WORDS) + "SELECT id, kanji LIKE '%bolt%' AS like_bolt, meaning_en ILIKE '%small%' AS ilike_small FROM words",
        "days_before": _with(MARKINGS) + f"SELECT id, {due} AS due FROM markings",
        "random_key": _with(WORDS) + f"SELECT id, {_KEY} AS sort_key FROM words",
        "sql_quote": _with(SHEET) + f"SELECT sr_no, {_quote('hint')} AS hint, {_quote('sentence')} AS sentence FROM sheet",
        "cast_int": _with(SHEET) + f"SELECT page_no AS page, {_PAGE} AS page_no FROM sheet",
        "string_functions": _with(SHEET) + f"""SELECT sr_no, {_STRIP.format('sentence')} AS stripped, lower(meaning) AS meaning,
  CAST(strpos(sentence, '、') AS INT) AS comma_at, string_split(sentence, '、')[1] AS head,
  CAST(len(string_split(sentence, ' ')) AS INT) AS pieces,
  regexp_replace(raw, '[＊*+（）()]', '', 'g') AS bare, raw LIKE '%い' AS ends_i FROM sheet""",
        "parse_week_day": _with(SHEET) + f"SELECT lecture, {_LECTURE.format(1)} AS week, {_LECTURE.format(2)} AS day FROM sheet",
        "difficulty": _with(SHEET) + f"SELECT raw, {_DIFFICULTY} AS difficulty_level FROM sheet",
        "word_type": _with(SHEET) + f"SELECT raw, meaning, {_word_type(False)} AS word_type FROM sheet",
        "word_type_first": _with(SHEET) + f"SELECT raw, meaning, {_word_type(True)} AS word_type FROM sheet",
        "candidate_forms": _candidate_list(CURRENT),
        "candidate_forms_interim": _candidate_list(INTERIM),
        "candidate_forms_first": _candidate_list(FIRST),
        **{
            name: _with(_split(variant)) + 'SELECT level, sr_no, "before", matched, "after" FROM valid LEFT JOIN split USING (sr_no)'
            for name, variant in (("split_sentence", CURRENT), ("split_sentence_interim", INTERIM), ("split_sentence_first", FIRST))
        },
        "examples_or_fallback": _with(_enriched()) + "SELECT ref_no, matched, example_before, example_after FROM enriched",
        "page_and_schedule": _with(_enriched(), SCHEDULE) + """SELECT ref_no, page_no, e.week, e.day,
  (SELECT id FROM schedule s WHERE s.week = e.week AND s.day = e.day) AS schedule_id FROM enriched e""",
        "lemma_forms": _with(SHEET, TOKENS) + "SELECT word, string_agg(form, '|' ORDER BY form) AS forms FROM tokens GROUP BY word",
        "split_with_forms": _with(_enriched(CURRENT, forms=True)) + "SELECT sr_no, matched, example_before, example_after FROM enriched",
        "upsert_markings": _with(LOG) + f"""SELECT coalesce(s.id, i.first) AS id, coalesce(i.user_id, s.user_id) AS user_id,
  coalesce(i.word_id, s.word_id) AS word_id, coalesce(i.marking, s.marking) AS marking, coalesce(i.updated_at, s.updated_at) AS updated_at
FROM (SELECT user_id, word_id, min(id) AS id, arg_max(marking, (updated_at, id)) AS marking, max(updated_at) AS updated_at
      FROM log WHERE updated_at >= TIMESTAMP '{b.AS_OF_MARKINGS}' GROUP BY ALL) s
FULL JOIN (SELECT user_id, word_id, min(id) AS first, arg_max(marking, (updated_at, id)) AS marking, max(updated_at) AS updated_at
      FROM log WHERE updated_at < TIMESTAMP '{b.AS_OF_MARKINGS}' GROUP BY ALL) i
  ON s.user_id = i.user_id AND s.word_id = i.word_id""",
        "latest_markings": _with(MARKINGS) + "SELECT * FROM markings",
        "upsert_into_table": _with(MARKINGS) + f"""SELECT coalesce(o.id, m.id) AS id, m.user_id, m.word_id, m.marking, m.updated_at
FROM markings m LEFT JOIN (SELECT user_id, word_id, min(id) AS id FROM log WHERE updated_at < TIMESTAMP '{b.AS_OF_MARKINGS}' GROUP BY ALL) o
  ON m.user_id = o.user_id AND m.word_id = o.word_id""",
        "bulk_mark_week": _with(WORDS, SCHEDULE, MARKINGS, "w AS (SELECT v.id FROM words v JOIN schedule s ON v.schedule_id = s.id WHERE level = 'N1' AND week = 1)") + f"""
SELECT * FROM markings WHERE user_id <> '{U}' OR word_id NOT IN (SELECT id FROM w)
UNION ALL SELECT coalesce(m.id, {_new_id(f"'{U}'", "w.id")}), '{U}', w.id, 1, TIMESTAMP '{b.AS_OF_MARKINGS}' FROM w LEFT JOIN {own} m ON m.word_id = w.id""",
        "reset_level": _with(WORDS, MARKINGS) + f"SELECT * FROM markings WHERE NOT (user_id = '{U}' AND word_id IN (SELECT id FROM words WHERE level = 'N1'))",
        "reset_in_table": _with(WORDS, MARKINGS) + f"SELECT * FROM markings WHERE NOT (user_id = '{U}' AND word_id IN (SELECT id FROM words WHERE level = 'N1'))",
        "set_flag": _with(STUDY) + "SELECT id, kanji, CASE kanji WHEN 'red bolt' THEN TRUE WHEN 'blue rod' THEN FALSE ELSE is_marked END AS is_marked FROM study",
        "set_flags": _with(STUDY, PROGRESS) + """SELECT s.id, s.kanji, coalesce(c.marked, s.is_marked) AS is_marked FROM study s LEFT JOIN (
  SELECT kanji, result = 'incorrect' AS marked,
    row_number() OVER (PARTITION BY kanji ORDER BY p.created_at DESC, (result = 'incorrect') DESC) AS rn
  FROM progress p JOIN words v ON v.id = p.vocabulary_id) c ON s.kanji = c.kanji AND c.rn = 1""",
        "record_review": _with(STUDY) + "SELECT id, times_reviewed, last_reviewed FROM study",
        "append_progress": _with(PROGRESS, MARKINGS) + f"""SELECT id, vocabulary_id, review_date, result, notes, created_at FROM progress
UNION ALL SELECT (SELECT max(id) FROM progress) + row_number() OVER (ORDER BY word_id, day, result), word_id, day, result, NULL,
  TIMESTAMP '{b.AS_OF_REVIEWS}' FROM (
    SELECT word_id, CAST(updated_at AS DATE) AS day, CASE WHEN marking = 5 THEN 'incorrect' ELSE 'correct' END AS result FROM markings)""",
        "append_progress_ids": "SELECT 4 * count(*) AS entries, 4 * count(*) AS ids FROM events",
        "bulk_mark_progress": _with(WORDS, SCHEDULE, MARKINGS) + f"""SELECT v.level, count(DISTINCT v.id) AS total_words,
  count(DISTINCT v.id) FILTER (level = 'N1' AND s.week = 1) AS newly_marked FROM words v LEFT JOIN schedule s ON v.schedule_id = s.id
GROUP BY v.level""",
        "check_not_null": _with(_enriched()) + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS violations FROM enriched" for c in ("level", "kanji", "full_sentence", "page_no")),
        "check_unique": _with(LOG) + "SELECT user_id, word_id, count(*) AS count FROM log GROUP BY user_id, word_id HAVING count(*) > 1",
        "check_table": _with(LOG) + """SELECT 'not null' AS "check", 'user_id' AS "column", count(*) FILTER (user_id IS NULL) AS violations FROM log
UNION ALL SELECT 'not null', 'word_id', count(*) FILTER (word_id IS NULL) FROM log
UNION ALL SELECT 'unique', 'id', count(*) FROM (SELECT id FROM log GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'user_id, word_id', count(*) FROM (SELECT user_id, word_id FROM log GROUP BY user_id, word_id HAVING count(*) > 1)""",
        "check_table_vocabulary": _with(WORDS) + " UNION ALL ".join(
            [f"SELECT 'not null' AS \"check\", '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS violations FROM words" for c in ("level", "kanji")]
            + [f"SELECT 'length', '{c}', count(*) FILTER (length({c}) > {n}) FROM words" for c, n in MAX_LENGTHS["vocabulary"].items()]
            + ["SELECT 'unique', 'id', count(*) FROM (SELECT id FROM words GROUP BY id HAVING count(*) > 1)"]),
        "check_foreign_key": _with(LOG) + "SELECT 'word_id' AS \"column\", count(*) AS violations FROM log WHERE word_id NOT IN (SELECT c_custkey FROM customer)",
        "check_table_schedule": _with(SCHEDULE) + """SELECT 'not null' AS "check", 'week' AS "column", count(*) FILTER (week IS NULL) AS violations FROM schedule
UNION ALL SELECT 'not null', 'day', count(*) FILTER (day IS NULL) FROM schedule
UNION ALL SELECT 'length', 'week_day_label', count(*) FILTER (length(week_day_label) > 20) FROM schedule
UNION ALL SELECT 'unique', 'id', count(*) - count(DISTINCT id) FROM schedule
UNION ALL SELECT 'unique', 'week, day', count(*) - count(DISTINCT (week, day)) FROM schedule""",
        "check_foreign_key_schedule": _with(WORDS, SCHEDULE) + """SELECT 'schedule_id' AS "column", count(*) AS violations
FROM words WHERE schedule_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM schedule s WHERE s.id = words.schedule_id)""",
        "check_foreign_key_progress": _with(WORDS, PROGRESS) + """SELECT 'vocabulary_id' AS "column", count(*) AS violations
FROM progress p WHERE vocabulary_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM words w WHERE w.id = p.vocabulary_id)""",
        "check_length": _with(WORDS) + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (length({c}) > {n}) AS violations FROM words"
            for c, n in {"level": 5, "kanji": 100, "hiragana": 100, "word_type": 20, "meaning_en": 15}.items()),
        "apply_defaults": _with(WORDS) + f"SELECT id, word_type, 1 AS difficulty_level, TIMESTAMP '{b.AS_OF_REVIEWS}' AS created_at FROM words",
        "owner_scope": _with(MARKINGS) + f"SELECT * FROM markings WHERE user_id = '{U}'",
        "owner_rejects": _with(MARKINGS) + f"SELECT * FROM markings WHERE user_id <> '{U}'",
    }
