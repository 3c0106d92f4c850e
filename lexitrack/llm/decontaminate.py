"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is a sequence of words. Of every ``WINDOW - GRAM + 1`` consecutive hashed grams the smallest is kept as a
fingerprint, so two texts that share ``WINDOW`` words share a fingerprint. Fingerprints of documents are joined with
those of the benchmark items; in a document with shared fingerprints, each is extended to all windows of ``WINDOW``
words that hold it, and these are joined with the items' windows. Items of fewer words than a window are one window:
for each of their (at most twelve) lengths all grams of that length are fingerprints, and the window is the gram.

Documents of one text are worked on once. The benchmark is joined, not collected; Spark broadcasts what it finds to
be small. Nulls and texts without words have no words, hits or items; an empty benchmark has no windows. Items of one
text count as many items. Rows of ``items`` with a null text or without words never occur.

Arrays are exploded with ``explode_outer``: for ``explode`` the optimizer would add a filter on the array's size, push
it to the scan, and compute the whole chain of arrays there many times over. The nulls drop out in the joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 13
GRAM = 5
#: Documents with at least this share of hit words are contaminated.
SHARE = 0.05

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEY = ["__text_hash", "__text_crc"]


def words(text: Column) -> Column:
    """The words of a text: A-Z made small, then all but ASCII other than letters and digits."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL), _BETWEEN, -1), "")


def _shifted(of: Column, by: int) -> Column:
    return F.slice(of, by + 1, F.greatest(F.size(of), F.lit(1)))


def _first(of: Column, n: Column) -> Column:
    return F.slice(of, 1, F.greatest(n, F.lit(0)))


def fingerprints(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows with words ``w`` and the distinct fingerprints ``f`` of them; none with fewer words than a window.

    Grams of five words are hashes of hashes of two and four; minima of nine come from minima of two, four and eight.
    """
    def mix(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    def least(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.least(x, y))

    if gram != 5 or window - gram != 8:
        raise ValueError("windows of 13 words and grams of five are supported")
    rows = rows.withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    rows = rows.withColumn("h2", mix(F.col("h1"), _shifted(F.col("h1"), 1)))
    rows = rows.withColumn("h4", mix(F.col("h2"), _shifted(F.col("h2"), 2)))
    rows = rows.withColumn("g", _first(mix(F.col("h4"), _shifted(F.col("h1"), 4)), F.size("h1") - gram + 1))
    rows = rows.withColumn("m2", least(F.col("g"), _shifted(F.col("g"), 1)))
    rows = rows.withColumn("m4", least(F.col("m2"), _shifted(F.col("m2"), 2)))
    rows = rows.withColumn("m8", least(F.col("m4"), _shifted(F.col("m4"), 4)))
    rows = rows.withColumn("f", F.array_distinct(
        _first(least(F.col("m8"), _shifted(F.col("g"), 8)), F.size("h1") - window + 1)
    ))
    return rows.drop("h1", "h2", "h4", "m2", "m4", "m8")


def _windows(size: int, at: Column, w: str = "w") -> list[Column]:
    """Two hashes of the window that begins at a word."""
    window = F.slice(w, at, size)
    return [F.xxhash64(window).alias("window_hash"), F.hash(window).alias("window_check")]


def _with_key(docs: DataFrame, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(dict(zip(_KEY, (F.xxhash64(value), F.crc32(value)), strict=True)))


def _hits(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Text key, first word, length and item of every window of an item that occurs in a text (key, text)."""
    long = items.filter(F.size("w") >= WINDOW)
    wanted = fingerprints(long).select(F.explode_outer("f").alias("f")).distinct()
    shared = (
        fingerprints(texts.select(*_KEY, words(F.col("text")).alias("w"))).select(*_KEY, F.explode_outer("f").alias("f"))
        .join(wanted, "f", "left_semi").groupBy(*_KEY).agg(F.collect_set("f").alias("shared"))
    )
    found = texts.join(shared, _KEY).dropDuplicates(_KEY)
    found = fingerprints(found.select(*_KEY, "shared", words(F.col("text")).alias("w")))
    # A gram at word p is in the windows that begin at words p - 8 to p.
    holds = F.filter(
        F.transform("g", lambda g, i: F.when(F.array_contains("shared", g), i + 1)), lambda p: p.isNotNull()
    )
    last = F.size("w") - WINDOW + 1
    starts = F.array_distinct(F.flatten(F.transform(holds, lambda p: F.sequence(
        F.greatest(p - (WINDOW - GRAM), F.lit(1)), F.least(F.greatest(p, F.lit(1)), F.greatest(last, F.lit(1)))))))
    found = found.select(*_KEY, "w", F.explode_outer(starts).alias("at"))
    of_items = long.select("item_id", "w", F.explode_outer(F.sequence(F.lit(1), F.size("w") - WINDOW + 1)).alias("at"))
    of_items = of_items.select("item_id", *_windows(WINDOW, F.col("at"))).distinct()
    hits = found.select(*_KEY, "at", *_windows(WINDOW, F.col("at"))).join(of_items, ["window_hash", "window_check"])
    return hits.select(*_KEY, "at", F.lit(WINDOW).alias("size"), "item_id")


def _short_hits(texts: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """The same for items of ``size`` words, fewer than a window."""
    wanted = items.filter(F.size("w") == size).select("item_id", *_windows(size, F.lit(1))).distinct()
    at = texts.select(*_KEY, words(F.col("text")).alias("w")).filter(F.size("w") >= size)
    at = at.select(*_KEY, "w", F.explode_outer(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    at = at.select(*_KEY, "at", *_windows(size, F.col("at")))
    hits = at.join(wanted, ["window_hash", "window_check"]).select(*_KEY, "at", F.lit(size).alias("size"), "item_id")
    return hits.distinct()  # copies of a text meet here


def find(docs: DataFrame, items: DataFrame, text: str = "text", out: str = "benchmark") -> DataFrame:
    """The rows with ``out``: words, hit words, and the items (sorted as strings) of which a window occurs.

    ``items`` has item_id and text. A column ``out`` is replaced. Names that begin with two underscores are used inside.
    """
    items = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    short = items.filter(F.size("w") < WINDOW).select(F.size("w").alias("n")).distinct()
    sizes = sorted(r["n"] for r in short.collect())  # at most twelve numbers
    texts = _with_key(docs.select(F.col(text).alias("text")), "text")
    parts = [_hits(texts, items), *(_short_hits(texts, items, n) for n in sizes)]
    hits = reduce(DataFrame.unionByName, parts)
    of_items = hits.select(*_KEY, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*_KEY).agg(
        F.sort_array(F.collect_list("item")).alias("items")
    )
    # Hit words are the union of the windows: each adds what lies behind the furthest end so far.
    spans = hits.groupBy(*_KEY, "at").agg((F.max(F.col("at") + F.col("size"))).alias("end"))
    before = Window.partitionBy(*_KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest(F.col("at"), reached), F.lit(0))
    covered = spans.select(*_KEY, new.alias("new")).groupBy(*_KEY).agg(F.sum("new").alias("n_hit"))
    found = covered.join(of_items, _KEY).withColumnsRenamed({k: f"found_{k}" for k in _KEY})
    found = found.withColumnsRenamed({"n_hit": "__n_hit", "items": "__items"})
    kept = [f"`{c}`" for c in docs.columns if c != out]
    joined = _with_key(docs.select(*kept), text).join(found, [F.col(k) == F.col(f"found_{k}") for k in _KEY], "left")
    return joined.select(*kept, F.struct(
        F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("__n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"),
    ).alias(out))


def contaminated(found: Column, share: float = SHARE) -> Column:
    """Whether a document has hits, and they are at least this share of its words."""
    per = round(1 / share)
    return (found["n_hit"] > 0) & (found["n_hit"] * per >= found["n_words"])
