"""Conjugation-aware sentence splitting as one native column expression.

Nothing here shuffles or leaves the JVM: the rules are a folded map literal keyed by the headword's last
character, the candidates an array of at most a few dozen forms per row.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexitrack.functions.conjugation import CURRENT, HEADWORD_MARKS, PARTICLES, Variant, rules
from lexitrack.functions.text import let, remove_chars, strip

_CANDIDATES = "array<struct<form:string,display:string>>"


@lru_cache(maxsize=None)
def _rules_sql(variant: Variant) -> str:
    by_ending: dict[str, list[str]] = {}
    for rule in rules(variant):
        by_ending.setdefault(rule.ending, []).append(
            f"named_struct('suffix', '{rule.suffix}', 'display', '{rule.display}')"
        )
    return "map(" + ", ".join(f"'{e}', array({', '.join(r)})" for e, r in by_ending.items()) + ")"


def _plain(form: Column) -> Column:
    return F.struct(form.alias("form"), F.lit("").alias("display"))


def _none() -> Column:
    return F.array().cast(_CANDIDATES)


def clean_headword(word: Column) -> Column:
    """The headword without the marks written into it."""
    return strip(remove_chars(word, HEADWORD_MARKS))


def _inflections(clean: Column, variant: Variant, within: Column | None) -> Column:
    last = F.right(clean, F.lit(1))
    stem = F.left(clean, F.length(clean) - 1)
    # Verbs and い-adjectives need a stem to inflect; な may stand alone.
    applies = (F.length(clean) > 1) | (last == "な")
    endings = F.try_element_at(F.expr(_rules_sql(variant)), last)

    def expand(s: Column) -> Column:
        found = endings
        if within is not None:
            found = F.filter(endings, lambda r: F.contains(within, F.concat(s, r["suffix"])))
        return F.transform(
            found, lambda r: F.struct(F.concat(s, r["suffix"]).alias("form"), r["display"].alias("display"))
        )

    if within is not None:
        # Every inflection begins with the stem, so a sentence without the stem has none of them.
        applies = applies & F.contains(within, stem)
    return F.coalesce(F.when(applies, let(stem, expand)), _none())


def _particle_parts(clean: Column, variant: Variant) -> Column:
    groups = []
    for particle in PARTICLES.split():
        parts = F.split(clean, particle)
        if variant.drops_particle:
            parts = F.concat(parts, F.array(remove_chars(clean, particle)))
        groups.append(F.when(clean.contains(particle), parts).otherwise(F.array().cast("array<string>")))
    some = clean.rlike("[" + PARTICLES.replace(" ", "") + "]")
    return F.when(some, F.transform(F.concat(*groups), _plain)).otherwise(_none())


def _candidates(word: Column, variant: Variant, forms: Column | None, within: Column | None) -> Column:
    def build(clean: Column) -> Column:
        analysed = _none() if forms is None else F.coalesce(F.transform(forms, _plain), _none())
        return F.concat(
            F.array(_plain(word), _plain(clean)),
            analysed,
            _inflections(clean, variant, within),
            _particle_parts(clean, variant),
        )

    return let(clean_headword(word), build)


def candidate_forms(word: Column, variant: Variant = CURRENT, forms: Column | None = None) -> Column:
    """Forms of a headword with their display endings, in the order they are tried, each form once.

    ``forms`` is an optional array of forms from a morphological analyser.
    """
    word = strip(word) if variant.trims else word

    def distinct(all_forms: Column) -> Column:
        texts = F.transform(all_forms, lambda c: c["form"])
        return F.filter(
            all_forms,
            lambda c, i: (c["form"] != "") & (F.array_position(texts, c["form"]) == i + 1),
        )

    return let(_candidates(word, variant, forms, None), distinct)


def split_sentence(word: Column, sentence: Column, variant: Variant = CURRENT, forms: Column | None = None) -> Column:
    """Struct (before, matched, after) around the longest form of the word in the sentence, NULL if none.

    Of equally long forms the one tried first wins; the split is at its first occurrence. Where the variant
    shows endings, ``after`` begins with the display ending.
    """
    if variant.trims:
        word, sentence = strip(word), strip(sentence)

    def pick(w: Column, s: Column) -> Column:
        hits = F.filter(
            _candidates(w, variant, forms, s),
            lambda c: (c["form"] != "") & F.contains(s, c["form"]),
        )
        ranked = F.transform(hits, lambda c, i: F.struct(
            F.length(c["form"]).alias("size"), (-i).alias("earliest"), c["form"].alias("form"), c["display"].alias("display"),
        ))
        return let(F.array_max(ranked), lambda best: cut(s, best))

    def cut(s: Column, best: Column) -> Column:
        before = F.call_function("substring_index", s, best["form"], F.lit(1))
        rest = F.length(before) + F.length(best["form"]) + 1
        return F.when(best.isNotNull(), F.struct(
            before.alias("before"),
            best["form"].alias("matched"),
            F.concat(best["display"], F.substr(s, rest)).alias("after"),
        ))

    return let(word, lambda w: let(sentence, lambda s: pick(w, s)))
