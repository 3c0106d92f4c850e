"""Personal data: pattern spans, and terms that disclose them, in DataFrame functions only.

Base spans come from patterns for e-mail, IP, card and phone numbers. Information-theoretic sanitisation adds terms:
the corpus shows, for every protected entity (a value found by a pattern) and every word near it (``WINDOW`` characters
to either side, over line ends), in how many texts both and in how many the word alone occurs. A word whose presence
makes the entity at least ``DISCLOSURE`` likely and tells at least ``MIN_BITS`` about it (pointwise: log2 P(entity |
word) / P(entity)) discloses the entity; all its occurrences become spans of kind ``term``. An entity so frequent that
there is little more than ``MIN_BITS`` to tell is disclosed by a word that tells ``MOST`` of it, which is a test of
P(entity | word) alone. ``masked`` generalises spans to their kind. Copies of a text count once.

No entity is left out for being rare: P(entity | word) is smoothed instead. That the two met by chance is weighed
against that they belong together, which counts beforehand for ``TOGETHER``; so one text tells little in a small corpus
and more in a large one, where meeting by chance is less likely. Words have three letters at least, or begin with a
capital or a letter of a script without capitals, as short names do.

Positions are code points, the end exclusive. Spans are ordered by start, then by the order of ``KINDS``, then end.
Nulls count as empty texts, without spans; masking leaves a null. No pattern matches across a line end.

The patterns equal the plain ones in what they find: repeats are possessive where what follows can't match inside of
them, and an e-mail begins where a run of its characters does, or where the last find ended, because a later start in
one run meets the same end. So they are linear in the text and need no stack. Arrays are exploded with
``explode_outer``, for which the optimizer adds no filter that computes them again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.functions.text import let
from lexitrack.session import shared_dir

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "term")
DISCLOSURE = 0.5
MIN_BITS = 6.0
#: The share of what there is to tell about an entity that is enough if it is less than ``MIN_BITS``.
MOST = 0.9
#: The characters to either side of an entity whose words are near it.
WINDOW = 400
#: How likely a word and an entity near it belong together before texts are counted, and how likely the word then means the entity.
TOGETHER, _MEANT = 1 / 64, 0.75
#: A term's texts are counted in one of so many slices before all of them.
SLICES = 16
#: Terms of up to so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
_ROUNDING = 1e-9

_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a find that counts.
_GATES = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}", "phone": r"\+[0-9]"}
_TERM = r"[\p{L}][\p{L}\p{N}]{2,}+|(?<![\p{L}\p{N}])[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{N}]?+"
_CHUNK = 64
_SPAN = "array<struct<start: int, kind_no: int, end: int, kind: string, value: string>>"


def _luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.negate(i), F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)
    return n.between(12, 19) & F.when(n.between(12, 19), total % 10 == 0).otherwise(False)


def _counts(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.|$)){4}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _positions(rows: DataFrame, text: str, wanted: dict[str, tuple[str, str | None]]) -> DataFrame:
    """The rows with ``__found_<kind>``: start, end and value of all finds of a pattern.

    The text is cut at the finds; a find begins after the pieces and finds before it. Running sums go by chunks, so
    that a text with very many finds does not cost the square of their number.
    """
    value, none = F.coalesce(F.col(text), F.lit("")), F.array().cast("array<string>")
    finds = {}
    for kind, (pattern, gate) in wanted.items():
        has = value.rlike(gate) if gate else F.lit(True)
        finds[f"__m_{kind}"] = F.when(has, F.regexp_extract_all(value, F.lit(pattern), F.lit(0))).otherwise(none)
        finds[f"__p_{kind}"] = F.when(has, F.split(value, pattern, -1)).otherwise(none)
    rows = rows.withColumns(finds)
    rows = rows.withColumns({
        f"__l_{k}": F.zip_with(f"__p_{k}", f"__m_{k}", lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0))) for k in wanted
    })
    rows = rows.withColumns({f"__c_{k}": _chunk_sums(k) for k in wanted})
    rows = rows.withColumns({f"__b_{k}": _running(f"__c_{k}") for k in wanted})
    rows = rows.withColumns({f"__found_{k}": _finds(k) for k in wanted})
    return rows.drop(*(f"__{c}_{k}" for c in "mplcb" for k in wanted))


def _chunk_sums(kind: str) -> Column:
    lengths = f"__l_{kind}"
    chunks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(lengths) - 1, F.lit(0)) / _CHUNK).cast("int"))
    return F.transform(chunks, lambda j: F.aggregate(F.slice(lengths, j * _CHUNK + 1, _CHUNK), F.lit(0), lambda a, x: a + x))


def _running(sums: str) -> Column:
    return F.transform(sums, lambda _, j: F.aggregate(F.slice(sums, 1, j), F.lit(0), lambda a, x: a + x))


def _finds(kind: str) -> Column:
    lengths, before, pieces = f"__l_{kind}", f"__b_{kind}", f"__p_{kind}"

    def place(value: Column, i: Column) -> Column:
        chunk = F.floor(i / _CHUNK).cast("int")
        near = F.aggregate(F.slice(lengths, chunk * _CHUNK + 1, i - chunk * _CHUNK), F.lit(0), lambda a, x: a + x)
        start = F.get(before, chunk) + near + F.length(F.get(pieces, i))
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    return F.transform(f"__m_{kind}", place)


def base_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """The rows with ``out``: the base spans of the text in order."""
    rows = _positions(docs, text, {k: (_PATTERNS[k], _GATES[k]) for k in BASE})
    return rows.withColumn(out, F.array_sort(F.concat(*map(_kept, BASE)))).drop(*(f"__found_{k}" for k in BASE))


def _kept(kind: str) -> Column:
    good = F.filter(f"__found_{kind}", lambda s: _counts(kind, s["value"]))
    return F.transform(good, lambda s: _span(kind, s)).cast(_SPAN)


def _span(kind: str, s: Column) -> Column:
    return F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["value"].alias("value"),
    )


# Texts in pieces. A substring is found from a text's start, so many of them would cost the square of its length.

_PIECE = 4096


def _pieces(text: Column) -> Column:
    """The text in pieces of so many code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, from the pieces that hold it; empty where that is nothing."""
    first = F.floor(start / _PIECE).cast("int")
    count = F.floor((end - 1) / _PIECE).cast("int") - first + 1
    held = F.array_join(F.slice(pieces, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(end > start, F.substr(held, start - first * _PIECE + 1, end - start)).otherwise("")


def _reach(numbers: Column) -> Column:
    """For each of some numbers the greatest of those before it, 0 for the first. Maxima go by chunks, as sums do."""
    def most(some: Column) -> Column:
        return F.coalesce(F.array_max(some), F.lit(0))

    def chunked(ends: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(ends) - 1, F.lit(0)) / _CHUNK).cast("int"))
        return F.transform(chunks, lambda j: most(F.slice(ends, j * _CHUNK + 1, _CHUNK)))

    def each(ends: Column, before: Column) -> Column:
        def at(i: Column) -> Column:
            chunk = F.floor(i / _CHUNK).cast("int")
            return F.greatest(F.get(before, chunk), most(F.slice(ends, chunk * _CHUNK + 1, i - chunk * _CHUNK)))

        return F.transform(ends, lambda _, i: at(i))

    def earlier(maxima: Column) -> Column:
        return F.transform(maxima, lambda _, j: most(F.slice(maxima, 1, j)))

    # Every array is bound to a name: where it is used for each element, it must not be computed for each.
    return let(numbers, lambda ends: let(let(chunked(ends), earlier), lambda before: each(ends, before)))


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with ``by(span, end of those before)`` for what a span adds to those before it."""
    def build(pieces: Column, reach: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            at = F.get(reach, i)
            return F.when(s["end"] > at, F.concat(_between(pieces, at, s["start"]), by(s, at))).otherwise("")

        rest = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
        return F.concat(F.array_join(F.transform(spans, part), ""), _between(pieces, rest, F.length(text)))

    return let(_pieces(text), lambda p: let(_reach(F.transform(spans, lambda s: s["end"])), lambda r: build(p, r)))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span generalised to its kind; overlapping spans become one."""
    def mark(s: Column, at: Column) -> Column:
        return F.when(s["start"] >= at, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")

    return F.when((F.size(spans) > 0) & text.isNotNull(), _replaced(text, spans, mark)).otherwise(text)


# Disclosing terms

_KEY = ["__text_hash", "__text_crc"]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(dict(zip(_KEY, (F.xxhash64(value), F.crc32(value)), strict=True)))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), lambda t: F.lower(t)))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks for its spans; positions stay."""
    return _replaced(text, spans, lambda s, at: F.repeat(F.lit(" "), s["end"] - F.greatest(s["start"], at)))


def _entities(texts: DataFrame) -> DataFrame:
    """Text key, entity and the terms near it, for each occurrence of an entity."""
    gate = reduce(lambda a, b: a + "|" + b, _GATES.values())
    found = base_spans(texts.filter(F.col("text").rlike(gate)), "text")
    found = found.withColumn("rest", _blanked(F.col("text"), F.col("spans")))
    found = found.withColumns({"length": F.length("rest"), "rest": _pieces(F.col("rest"))})
    rest, length = F.col("rest"), F.col("length")

    def near(s: Column) -> Column:
        first = F.greatest(s["start"] - WINDOW, F.lit(0))
        before = _between(rest, first, s["start"])
        before = F.when(first > 0, F.regexp_replace(before, r"^[\p{L}\p{N}]++", "")).otherwise(before)
        after = _between(rest, s["end"], F.least(s["end"] + WINDOW, length))
        more = length > s["end"] + WINDOW
        after = F.when(more, F.regexp_replace(after, r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$", "")).otherwise(after)
        entity = F.xxhash64(s["kind"], F.lower(s["value"]))
        return F.struct(entity.alias("entity"), _terms(F.concat(before, F.lit(" "), after)).alias("terms"))

    return found.select(*_KEY, F.explode_outer(F.transform("spans", near)).alias("near")).select(
        *_KEY, "near.entity", "near.terms"
    ).filter(F.col("entity").isNotNull())


def _likely(share: Column, n_both: Column, n_term: Column) -> Column:
    """P(entity | word), smoothed: by the counts if they belong together, else the entity's share of all texts."""
    meant = F.greatest(F.lit(_MEANT), (1 + share) / 2)
    chance = F.greatest(1 - share, F.lit(_ROUNDING))
    odds = n_both * F.log(meant / share) + (n_term - n_both) * F.log((1 - meant) / chance) + F.log(F.lit(TOGETHER / (1 - TOGETHER)))
    together = 1 / (1 + F.exp(-odds))
    return together * (n_both + 1) / (n_term + 2) + (1 - together) * share


def disclosing_terms(texts: DataFrame, disclosure: float = DISCLOSURE, min_bits: float = MIN_BITS) -> DataFrame:
    """Terms that disclose an entity, from rows with a key of the text, and the text: the term alone.

    Counts are aggregates, so a frequent entity or term reaches a reducer as one row for each task and text. A term
    is counted in all texts only if it can still disclose: where it occurs in more texts of one slice of the keys than
    it may in all, it discloses nothing.
    """
    spark, folder = texts.sparkSession, shared_dir(texts.sparkSession, "disclosing")
    entities = _written(_entities(texts), f"{folder}/entities")
    often = entities.groupBy("entity").agg(F.count_distinct(*_KEY).alias("n_entity"))
    pairs = entities.select("entity", *_KEY, F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    together = pairs.groupBy("entity", "term").agg(F.count_distinct(*_KEY).alias("n_both")).join(often, "entity")
    together = _written(together, f"{folder}/together")
    all_texts = max(1, texts.select(*_KEY).distinct().count())
    most = _written(together.groupBy("term").agg(F.max("n_both").alias("most")), f"{folder}/most")
    in_slice = occurrences(texts.filter(F.col(_KEY[1]) % SLICES == 0), most.select("term")).groupBy("term").agg(
        F.count_distinct(*_KEY).alias("n_slice")
    )
    # The smoothed P is between the share, which is never enough, and this quotient.
    too_many = (F.coalesce("n_slice", F.lit(0)) + 2) * disclosure > F.col("most") + 1 + _ROUNDING
    candidates = _written(most.join(in_slice, "term", "left").filter(~too_many).select("term"), f"{folder}/candidates")
    alone = occurrences(texts, candidates).groupBy("term").agg(F.count_distinct(*_KEY).alias("n_term"))
    share = F.col("n_entity") / all_texts
    likely = _likely(share, F.col("n_both"), F.col("n_term"))
    bits = F.least(F.lit(min_bits), F.log2(1 / share) * MOST)
    judged = together.join(alone, "term").filter(F.col("n_entity") < all_texts)
    return judged.filter((likely >= disclosure) & (F.log2(likely / share) >= bits)).select("term").distinct()


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def occurrences(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Text key and term wherever one of the terms, stored ones, occurs. Terms beyond ``BROADCAST_BYTES`` are shuffled."""
    words = texts.select(*_KEY, F.explode_outer(_terms(F.col("text"))).alias("term"))
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    return words.join(F.broadcast(terms) if size <= BROADCAST_BYTES else terms, "term", "left_semi")


def find(docs: DataFrame, text: str = "text", out: str = "spans", **thresholds) -> DataFrame:
    """The rows with ``out``: base spans and those of disclosing terms. A column of that name is replaced."""
    texts = _keyed(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")), "text")
    spark = docs.sparkSession
    path = shared_dir(spark, "terms")
    disclosing_terms(texts, **thresholds).write.parquet(path)
    terms = spark.read.parquet(path)
    inside = occurrences(texts, terms).groupBy(*_KEY).agg(F.collect_set("term").alias("disclosing"))
    held = texts.join(inside, _KEY).dropDuplicates(_KEY)
    placed = _positions(held, "text", {"term": (_TERM, None)})
    hits = F.filter("__found_term", lambda s: F.array_contains("disclosing", F.lower(s["value"])))
    placed = placed.select(
        *[F.col(k).alias(f"found{k}") for k in _KEY],
        F.transform(hits, lambda s: _span("term", s)).cast(_SPAN).alias("__terms"),
    )
    kept = [f"`{c}`" for c in docs.columns if c != out]
    rows = base_spans(_keyed(docs.select(*kept), text), text, "__base")
    rows = rows.join(placed, [F.col(k) == F.col(f"found{k}") for k in _KEY], "left")
    every = F.array_sort(F.concat("__base", F.coalesce("__terms", F.array().cast(_SPAN))))
    rows = rows.withColumn("__all", every)
    term = KINDS.index("term")
    rows = rows.withColumn("__reach", _reach(F.transform("__all", lambda x: F.when(x["kind_no"] != term, x["end"]).otherwise(0))))
    outside = F.filter("__all", lambda x, i: (x["kind_no"] != term) | (F.get("__reach", i) < x["end"]))
    return rows.select(*kept, outside.alias(out))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
