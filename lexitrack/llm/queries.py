"""The registered queries of this package: each operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.llm import (
    byte_bpe, decontaminate, fingerprint, hard_negatives, id_planes, jaccard_join, language_id, lm_score, merkle, pii, quality,
    secret_scan, suffix_dedup,
)
from lexitrack.llm.common import held_out, importable, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    found = language_id.predict(docs.select("doc_id", "text"), model, out="language")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.ambiguous").alias("ambiguous"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return lm_score.score(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = ~held_out(F.col("doc_id"))
    model = quality.train(docs.filter(learn), labels.filter(learn))
    found = quality.score(docs.select("doc_id", "text"), model, out="score")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), out="s")
    s = F.col("s")

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secret_scan.BASE), F.sha2(secret_scan.joined(s, secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.joined(s, secret_scan.KINDS).alias("spans"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find(docs.select("doc_id", "text"), items, out="b")
    return found.select(
        "doc_id", "b.n_words", "b.n_hit", F.size("b.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("b.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("b")).alias("contaminated"),
    )


def op6_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return id_planes.store_and_read(table(spark, sf_dir, "documents"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprint.with_next_text(table(spark, sf_dir, "documents"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    for text in ("text", "edited", "next_text"):
        pairs = fingerprint.sketch(pairs, text, f"{text}_sketch")
    own, edited, after = (F.col(f"{t}_sketch") for t in ("text", "edited", "next_text"))
    return pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.encoded(own).alias("fingerprint"), fingerprint.encoded(edited).alias("edited_fingerprint"),
        fingerprint.resemblance(own, edited).alias("near_edited"), fingerprint.resemblance(own, after).alias("near_next"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), out="s")
    s = F.col("s")

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.BASE), F.sha2(pii.joined(s, pii.BASE), 256).alias("base_sha256"),
        pii.joined(s, pii.KINDS).alias("spans"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    found = byte_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), out="bpe")
    return found.select("doc_id", "bpe.*")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select(F.col("vec_id").alias("id"), moved.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names = ("doc_id", "source", "lang", "n_chars")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = [F.col(c) for c in names]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(
        F.col("doc_id").alias("key"), F.col("source").alias("group"), merkle.row_digest(*own, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.row_digest(*own, lowered)).alias("changed"),
    )
    return merkle.climb(merkle.build(leaves)).withColumnRenamed("key", "doc_id")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_decontaminate": op5_decontaminate,
    "op6_id_planes": op6_id_planes,
    "op7_fingerprint": op7_fingerprint,
    "op8_pii": op8_pii,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_HARD_NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM scores WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS "rank",
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND s.label <> p.own
WHERE 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY "rank" <= 5"""


def _sql_field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_sql_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: The unsigned crc32 of the decimal doc_id, bit by bit.
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(ch)::BIGINT FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295)"""

_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MERKLE = f"""WITH RECURSIVE hashed AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_sql_leaf('text')} AS leaf,
    CASE WHEN {_SQL_CRC} % 5 = 0 THEN {_sql_leaf(_SMALL)} END AS changed FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
own AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM own WHERE n > 1 GROUP BY tree, level, pos // 16, n),
top AS (
  SELECT -1::BIGINT AS tree, 0 AS level, tree AS pos, count(*) OVER () AS n, digest FROM own WHERE n = 1
  UNION ALL SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY tree, level, pos // 16, n),
up AS (
  SELECT tree, level, pos, n, digest, list(digest) OVER (
    PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run
  FROM (SELECT * FROM own UNION ALL SELECT * FROM top)),
climb AS (
  SELECT tree AS tree0, pos AS pos0, tree, 0 AS level, pos, coalesce(changed, leaf) AS folded, '' AS siblings FROM leaves
  UNION ALL SELECT tree0, pos0, CASE WHEN n > 1 THEN c.tree ELSE -1 END, CASE WHEN n > 1 THEN c.level + 1 ELSE 0 END,
    CASE WHEN n > 1 THEN c.pos // 16 ELSE c.tree END,
    CASE WHEN n > 1 THEN sha256(array_to_string(list_concat(run[1 : c.pos % 16], [folded], run[c.pos % 16 + 2 : 16]), '')) ELSE folded END,
    CASE WHEN n > 1 THEN siblings || array_to_string(list_concat(run[1 : c.pos % 16], run[c.pos % 16 + 2 : 16]), '') ELSE siblings END
  FROM climb c JOIN up ON c.tree = up.tree AND c.level = up.level AND c.pos = up.pos WHERE n > 1 OR c.tree >= 0)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM climb c JOIN up r ON r.tree = -1 AND r.n = 1 AND c.tree = -1 AND c.level = r.level AND c.pos = r.pos
JOIN leaves l ON l.tree = c.tree0 AND l.pos = c.pos0 JOIN own s ON s.tree = c.tree0 AND s.n = 1"""

#: The operators that SQL can express.
ORACLE: dict[str, str] = {"op12_hard_negatives": _HARD_NEGATIVES, "op13_merkle_manifest": _MERKLE}
