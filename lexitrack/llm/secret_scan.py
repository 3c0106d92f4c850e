"""Secret scans with assignment-aware lexing.

Three base patterns give the plain finds: assignments to a word for a secret, access keys, and hexadecimal runs. The
lexer adds literals: it reads source and configuration text (``name = value``, ``name: value``, ``"name": "value"``,
``name => value``, ``name := value``, ``<name>value</name>``, with a type as ``name: type = value`` or ``var name type =
value``) into names and terms; a value may be triple-quoted, a YAML block, or stand on the next line. It follows names to
the literals they were given, before or after their use (also through sums of terms), and scores each literal by how sensitive its target's name is and how random
the value looks. A literal of a high score that no base span covers becomes a span of kind ``literal``.

Positions are code points, the end exclusive. Nulls count as empty texts, which have no spans. Spans are ordered by
start, then by the order of ``KINDS``, then end. Every pattern is linear in the text: repeats are possessive or
followed by characters outside of their class.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "literal")
MIN_SCORE = 0.5

_ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# Lexing: a name with its operator, terms, and elements of markup.
_TARGET = re.compile(r"""(?<![\w$.-])([A-Za-z_$][\w$.-]*+)["']?\]?[\x20\t]*+(?:=>|:=|[:=])[\x20\t]*+""")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\n]++)</")
_TERM = re.compile(
    r'''(?:[bBfFrRuU]{1,2}(?=["']))?+(?:"{3}((?:[^"\\]|\\[\s\S]|"(?!""))*+)"{3}|'{3}((?:[^'\\]|\\[\s\S]|'(?!''))*+)'{3}|'''
    r'''"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`|([^\s,;"'`{}\[\]()<>+]++))'''
)
# A type and its "=" after "name:", a declaration before "type =", a value on the next line, and the head of a YAML block.
_TYPE = re.compile(
    r"""[&*]*+(?:'[a-z]++[\x20\t]++)?(?:mut[\x20\t]++)?([A-Za-z_][\w.]*+)(?:[<\[][^<>\[\]=\n"'`]{0,64}[>\]]){0,2}\??"""
    r"""(?:[\x20\t]*+\|[\x20\t]*+[A-Za-z_][\w.]*+){0,4}[\x20\t]*+=(?![=>])[\x20\t]*+"""
)
_DECLARED = re.compile(r"(?<![\w$])(?:var|const|let)[\x20\t]{1,8}([A-Za-z_]\w{0,99})[\x20\t]{1,8}[*\[\]]{0,4}$")
_NEXT = re.compile(r"""[(\\]?[\x20\t]*+\r?\n[\x20\t]++(?=["'`]|[^\s,;"'`{}\[\]()<>+]++[\x20\t]*+(?:\r?\n|\Z))""")
_BLOCK = re.compile(r"[|>][-+0-9]{0,2}[\x20\t]*+(?:\x20#[^\n]*+)?\r?\n(?:[\x20\t]*+\r?\n)*+([\x20\t]++)(?=\S)")
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----[^-]++-----END (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----")
_PLUS = re.compile(r"[\x20\t]*+\+[\x20\t]*+")
_NAME = re.compile(r"[A-Za-z_$][\w$.-]*").fullmatch
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

# How sensitive a word of a name is; words that say the value is only about a secret.
_SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "credential": 1.0, "credentials": 1.0,
    "token": 0.9, "apikey": 1.0, "bearer": 0.9, "auth": 0.7, "authorization": 0.8, "pass": 0.7, "pin": 0.6, "salt": 0.6,
    "signature": 0.5,
}
_KEY_OF = {"api", "access", "private", "secret", "auth", "encryption", "signing", "master", "service", "client", "account", "ssh"}
_ABOUT = {"url", "uri", "path", "file", "name", "id", "type", "count", "length", "size", "field", "label", "prompt", "hint",
          "expires", "expiry", "public", "policy", "regex", "pattern", "test", "example", "endpoint"}
_DULL = re.compile(r"(?i)example|changeme|change_me|placeholder|your[_-]?|dummy|redacted|\$\{|<|%\(|^(?:none|null|true|false|undefined)$").search
_FULL_BITS = 32  # of character entropy
_PIECE = 4096
_NAME_CHARS = 256


def sensitivity(name: str) -> float:
    """0 to 1: how surely a value given to the name is secret."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    best = max((_SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if "key" in parts and _KEY_OF & set(parts):
        best = max(best, 0.9)
    return best * 0.3 if parts and parts[-1] in _ABOUT else best


class Judged:
    """A running judgement of a text's randomness, 0 to 1: 1 from 32 bits of character entropy on, for the most random line.

    More text never lowers the bits of a line, so its characters are counted only until they are enough, and a text is
    judged as it grows without a look at what it held before.
    """

    __slots__ = ("counts", "full", "kinds", "dull", "best")

    def __init__(self, counts: Counter, full: bool = False, kinds: int = 0, dull: bool = False, best: float = 0.0):
        self.counts, self.full, self.kinds, self.dull, self.best = counts, full, kinds, dull, best

    def score(self) -> float:
        n = self.counts.total()
        if self.dull or not self.full and n < 8:
            return self.best
        bits = _FULL_BITS if self.full else sum(c * math.log2(n / c) for c in self.counts.values())
        few = (self.kinds & 7).bit_count() < 2 or self.kinds & 8
        return max(self.best, min(1.0, bits / _FULL_BITS) * (0.5 if few else 1.0))

    def _line(self, text: str) -> Judged:
        if len(text) > _PIECE:  # a long value is judged by pieces, until nothing more can raise it
            out, at = self, 0
            while at < len(text) and not (out.full and (out.kinds & 7).bit_count() > 1):
                out, at = out._line(text[at : at + _PIECE]), at + _PIECE
            return out
        kinds = self.kinds | any(map(str.islower, text)) | any(map(str.isupper, text)) << 1 | any(map(str.isdigit, text)) << 2 | (" " in text) << 3
        return self._with(Counter(text), False, kinds, bool(_DULL(text)), 0.0)

    def _with(self, counts: Counter, full: bool, kinds: int, dull: bool, best: float) -> Judged:
        counts = Counter() if self.full or full else self.counts + counts
        n = counts.total()
        if not self.full and not full and sum(c * math.log2(n / c) for c in counts.values()) >= _FULL_BITS and n >= 8:
            counts, full = Counter(), True
        return Judged(counts, self.full or full, kinds | self.kinds, self.dull or dull, max(self.best, best))

    def plus(self, text: str) -> Judged:
        """With more text behind."""
        lines = text.split("\n")
        if len(lines) == 1:
            return self._line(text)
        out = self._line(lines[0].strip())
        for line in lines[1:]:
            out = Judged(Counter(), best=out.score())._line(line.strip())
        return out

    def joined(self, other: Judged) -> Judged:
        """With another judged text behind."""
        return self._with(other.counts, other.full, other.kinds, other.dull, other.best)


def randomness(value: str) -> float:
    """0 to 1: how much a value looks drawn at random."""
    return Judged(Counter()).plus(value).score()


class Value:
    """What a name was given: literals of its own, and values of other names, which it shares instead of copying."""

    __slots__ = ("terms", "asked", "judged", "score")

    def __init__(self):
        self.terms: list[tuple[int, int] | Value] = []
        self.asked, self.judged, self.score = False, Judged(Counter()), 0.0

    def parts(self) -> list[Value]:
        return [t for t in self.terms if isinstance(t, Value)]

    def judge(self, text: str) -> None:
        for t in self.terms:
            self.judged = self.judged.joined(t.judged) if isinstance(t, Value) else self.judged.plus(text[t[0] : t[1]])


def _block_end(text: str, at: int, indent: str) -> int:
    """The end of the last line of a block that begins at ``at``, after its indent."""
    end = at
    while True:
        line = text.find("\n", at)
        stop = len(text) if line < 0 else line
        if text[at:stop].strip():
            end = stop
        if line < 0:
            return end
        at = line + 1
        following = text.find("\n", at)
        if not text.startswith(indent, at) and text[at : len(text) if following < 0 else following].strip():
            return end


def lex(text: str) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
    """Name and terms of every assignment in the text, in order; a term is its span and whether it is bare."""
    at = 0
    while target := _TARGET.search(text, at):
        at, terms, names = target.end(), [], [target[1]]
        before = text[max(0, target.start() - 128) : target.start()]
        if declared := _DECLARED.search(before):
            names.append(declared[1])
        if block := _BLOCK.match(text, at):
            at = _block_end(text, block.end(), block[1])
            yield target[1], [(block.end(), at, False)]
            continue
        if typed := _TYPE.match(text, at):
            names.append(typed[1])
            at = typed.end()
        if following := _NEXT.match(text, at):
            at = following.end()
        while term := _TERM.match(text, at):
            terms.append((*term.span(term.lastindex), term.lastindex == 6))
            at = term.end()
            plus = _PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if terms:
            for name in names:
                yield name, terms
            if terms[-1][2]:  # a bare value may itself be the name of the next pair
                at = terms[-1][0]
                if _TARGET.match(text, at) is None:
                    at = terms[-1][1]


def literals(text: str) -> list[tuple[int, int, float]]:
    """Literals that reach a sensitive target, directly or through constants: span and score. Linear in the terms."""
    found: dict[tuple[int, int], float] = {}

    def put(span: tuple[int, int], score: float) -> None:
        if score >= MIN_SCORE:
            found[span] = max(found.get(span, 0.0), score)

    if "=" in text or ":" in text:
        assigned = list(lex(text))
        made: list[Value] = []

        def resolve(terms: list[tuple[int, int, bool]], known: dict[str, Value], other: dict[str, Value]) -> Value:
            out = Value()
            for a, b, bare in terms:
                bare = bare and b - a <= _NAME_CHARS  # longer ones name nothing
                value = text[a:b] if bare else ""
                of = (known.get(value) or other.get(value)) if bare else None
                if of is not None:
                    if all(of is not t for t in out.terms):
                        out.terms.append(of)
                elif a < b and not (bare and len(terms) > 1 and _NAME(value)):
                    out.terms.append((a, b))
            made.append(out)
            return out

        # Backwards, every later definition is known before its use; forwards again, the last one before a use counts.
        defined: dict[str, Value] = {}
        for turn in (assigned, assigned[::-1], assigned):
            constants: dict[str, Value] = {}
            last = []
            for name, terms in turn:
                constants[name] = resolve(terms, constants, defined)
                last.append((name, constants[name]))
            defined = constants
        scores = [(value, score) for name, value in last if (score := sensitivity(name))]
        for value, _ in scores:
            value.asked = True
        # A value is made of earlier ones only: what a sensitive name needs is found from the last to the first, judged from
        # the first to the last, and handed on from the last to the first again.
        for value in reversed(made):
            if value.asked:
                for part in value.parts():
                    part.asked = True
        for value in made:
            if value.asked:
                value.judge(text)
        for value, score in scores:
            value.score = max(value.score, score * value.judged.score())
        for value in reversed(made):
            if value.score >= MIN_SCORE:
                for t in value.terms:
                    if isinstance(t, Value):
                        t.score = max(t.score, value.score)
                    else:
                        put(t, value.score)
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            found[m.span()] = 1.0
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            put(m.span(2), sensitivity(m[1]) * randomness(m[2]))
    return [(a, b, s) for (a, b), s in found.items()]


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text: kind, start, end, score (1 for the base patterns)."""
    out = [("assign", *m.span(), 1.0) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 12]
    out += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span(), 1.0) for m in _HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in out)
    starts, ends = [a for a, _ in base], list(accumulate((b for _, b in base), max))  # how far the spans up to each reach
    for a, b, score in literals(text):
        before = bisect_right(starts, a)
        if not before or ends[before - 1] < b:
            out.append(("literal", a, b, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        found = [spans(t.as_py() or "") for t in batch]
        yield pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in f] for f in found], _SPAN_TYPE)


def scan(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """The rows with ``out``: the spans of the text. A column of that name is replaced."""
    return docs.withColumn(out, F.arrow_udf(_scan, _SPANS).asNondeterministic()(F.col(text)))


def _masked(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        out = []
        for value in batch:
            text, at, parts = value.as_py(), 0, []
            for kind, a, b, _ in spans(text or ""):
                if b > at:
                    parts += [text[at : max(a, at)], f"<{kind}>" if a >= at else ""]
                    at = b
            out.append("".join([*parts, text[at:]]) if parts else text)
        yield pa.array(out, pa.string())


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each secret in the text replaced by its kind in angle brackets; a null stays null."""
    return docs.withColumn(text, F.arrow_udf(_masked, "string").asNondeterministic()(F.col(text)))


def joined(found: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    some = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
