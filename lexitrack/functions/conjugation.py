"""Conjugation endings of Japanese headwords, as data."""

from __future__ import annotations

from typing import NamedTuple

# Fixed values. Endings a word's last character can turn into; ∅ is the bare stem.
VERB_SUFFIXES = {
    "る": "∅ て た ない ます れば よう られる させる ている ていた てる てた ず ずに たい たら たり ろ れ させ られ なかった ません ながら つつ",
    "く": "∅ いて いた かない きます けば こう かず きたい いたら いたり け かなかった き か きながら",
    "ぐ": "∅ いで いだ がない ぎます げば ごう がず ぎたい いだら いだり げ がなかった ぎ が ぎながら",
    "す": "∅ して した さない します せば そう さず したい したら したり せ さなかった し さ しながら",
    "つ": "∅ って った たない ちます てば とう たず ちたい ったら ったり て たなかった ち た ちながら",
    "ぬ": "∅ んで んだ なない にます ねば のう なず にたい んだら んだり ね ななかった に な にながら",
    "ぶ": "∅ んで んだ ばない びます べば ぼう ばず びたい んだら んだり べ ばなかった び ば びながら",
    "む": "∅ んで んだ まない みます めば もう まず みたい んだら んだり め まなかった み ま みながら",
    "う": "∅ って った わない います えば おう わず いたい ったら ったり え わなかった い わ いながら",
}
I_ADJECTIVE_SUFFIXES = "い く くて かった くない くなかった ければ さ そう すぎる すぎ み"
NA_ADJECTIVE_SUFFIXES = "∅ な に だ で だった ではない じゃない"
PARTICLES = "が を に で と の"
# Marks written into headwords that are no part of the word.
HEADWORD_MARKS = "＊*+（）()①②③④⑤"
# Sign that stands for the headword in front of a conjugation ending (U+FF5E).
TILDE = "～"


class Variant(NamedTuple):
    """One release of the splitting rules."""

    name: str
    trims: bool            # trim headword and sentence first
    shows_suffix: bool     # put the conjugation ending in front of the text after the match
    drops_particle: bool   # also try the headword with a particle left out
    extended: bool         # has the ながら / つつ endings, lists the full stems last
    polite_negative: bool  # has ません for る


CURRENT = Variant("current", True, True, False, True, True)
INTERIM = Variant("interim", True, False, True, False, True)
FIRST = Variant("first", False, False, True, False, False)
VARIANTS = {v.name: v for v in (CURRENT, INTERIM, FIRST)}


class Rule(NamedTuple):
    ending: str
    suffix: str
    display: str


def _verb_suffixes(ending: str, variant: Variant) -> list[str]:
    full = VERB_SUFFIXES[ending].split()
    if variant.extended:
        return full
    if ending == "る":
        late = {"ながら", "つつ"} if variant.polite_negative else {"ません", "ながら", "つつ"}
        return [s for s in full if s not in late]
    # The earlier releases try the two plain stems (か, き) before the longer endings.
    *others, i_stem, a_stem, _while = full[1:]
    return [a_stem, i_stem, *others, "∅"]


def rules(variant: Variant) -> list[Rule]:
    """All ending rules in the order they are tried."""
    out = []
    for ending in VERB_SUFFIXES:
        out += [(ending, s, "" if s == "∅" else TILDE + s) for s in _verb_suffixes(ending, variant)]
    out += [("い", s, "" if s == "い" else TILDE + s) for s in I_ADJECTIVE_SUFFIXES.split()]
    out.append(("い", "∅", TILDE))
    out += [("な", s, "" if s == "∅" else TILDE + s) for s in NA_ADJECTIVE_SUFFIXES.split()]
    return [Rule(e, "" if s == "∅" else s, d if variant.shows_suffix else "") for e, s, d in out]
