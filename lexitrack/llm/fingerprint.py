"""Bottom-k fingerprints of documents, in DataFrame functions only.

A text's set has the hashes of its shingles of five words (all words as one shingle if there are fewer; none without
words); words are what stands between white space, in lower case. The fingerprint is the ``K`` smallest hashes in
order. Fingerprints of parts merge into that of the whole, and give estimates of resemblance, containment and the
number of distinct shingles, exact while sets have at most ``K`` shingles. Equal texts have equal fingerprints.

Nulls count as empty texts. Two empty sets resemble each other fully, an empty and another one not at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
SHINGLE = 5
_RANGE = 1 << 63


def sketch(rows: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """The rows with ``out``: the fingerprint of the text as an array of longs, smallest first."""
    w, h = f"{out}_words", f"{out}_hashes"
    positive = F.lit(_RANGE - 1)
    split = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    rows = rows.withColumn(w, F.array_remove(split, ""))
    rows = rows.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    n = F.size(h)
    shingles = F.transform(
        F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))),
        lambda i: F.xxhash64(F.slice(h, i, SHINGLE)).bitwiseAND(positive),
    )
    smallest = F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)
    return rows.withColumn(out, F.when(n > 0, smallest).otherwise(F.array().cast("array<bigint>"))).drop(w, h)


def merge(parts: list[Column], k: int = K) -> Column:
    """The fingerprint of the union of sets."""
    return F.slice(F.sort_array(reduce(F.array_union, parts)), 1, k)


def merge_groups(rows: DataFrame, keys: list[str], sketch_column: str, k: int = K) -> DataFrame:
    """The fingerprint of the union of the sets of each group.

    A hash is kept if it is among the group's k smallest distinct ones; hashes shrink to one row per group, value and
    task before the shuffle, and a group's values are ranked in at most k steps for each of its salts, then again.
    """
    values = rows.select(*keys, F.explode(sketch_column).alias("v"))
    values = values.groupBy(*keys, "v").agg(F.lit(1).alias("one"))
    salted = Window.partitionBy(*keys, F.pmod(F.xxhash64("v"), F.lit(64))).orderBy("v")
    some = values.withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k)
    whole = Window.partitionBy(*keys).orderBy("v")
    least = some.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("v")).alias(sketch_column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated size of the intersection over the size of the union."""
    union = merge([a, b], k)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.greatest(F.size(union), F.lit(1)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    density = (k - 1) / (F.element_at(a, F.lit(k)).cast("double") / float(_RANGE))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(density)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that is in the second."""
    shared = resemblance(a, b, k) * distinct_shingles(merge([a, b], k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def encoded(a: Column) -> Column:
    """A fingerprint as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each row with the text of the next one by id (nulls first), then by a hash of the
    text; the last one with that of the first. Rows that repeat id and text follow each other.

    Rows are dealt into ranges of ids, between approximate quantiles, so every text is shuffled once. The first row of
    each range also goes to the end of the range before.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("row_hash", F.xxhash64("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(q) for q in rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)})
    steps = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    part = F.size(F.filter(steps, lambda c: c <= F.col("doc_id")))
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row_hash")
    firsts = rows.groupBy("part").agg(F.min(place).alias("first"))  # a row for each range
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.max("part").over(whole))
    heads = firsts.select(before.alias("to"), "part", F.col("first.row_hash").alias("row_hash"), F.col("first.doc_id").alias("head"))
    sent = rows.join(heads, ["part", "row_hash"]).filter(F.col("doc_id").eqNullSafe(F.col("head")))
    both = rows.withColumn("sent", F.lit(False)).unionByName(
        sent.select("doc_id", "text", "row_hash", F.col("to").alias("part"), F.lit(True).alias("sent"))
    )
    order = Window.partitionBy("part").orderBy("sent", F.asc_nulls_first("doc_id"), "row_hash")
    following = both.withColumn("next_text", F.lead("text").over(order))
    return following.filter(~F.col("sent")).select("doc_id", "text", "next_text")
