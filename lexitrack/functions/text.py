"""Small column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexitrack.schema import DIFFICULTY_LABELS, MARKING_LABELS

# Every character the sheets' whitespace trimming removes: the Unicode White_Space set plus
# the four ASCII separators. The zero-width space (U+200B) is not one of them.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts a spreadsheet load takes as a missing cell (the documented pandas NA strings).
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_WIDE_DIGITS = "０１２３４５６７８９"


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace from both ends."""
    return F.trim(c, F.lit(WHITESPACE))


def narrow_digits(c: Column) -> Column:
    """Full-width digits as ASCII digits."""
    return F.translate(c, _WIDE_DIGITS, "0123456789")


def remove_chars(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TEXTS), c)


def to_int(c: Column) -> Column:
    """Truncating text -> int, NULL where the text is no number ('12.7' -> 12)."""
    text = narrow_digits(strip(c.cast("string")))
    return F.when(text.rlike(_NUMBER), text.try_cast("double").try_cast("int"))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with one decimal, half away from zero; NULL for an empty whole."""
    exact = F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact, 1).cast("double")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def _labelled(c: Column, labels: dict[int, str]) -> Column:
    return F.coalesce(*[F.when(c == code, label) for code, label in labels.items()])


def marking_label(c: Column) -> Column:
    """Label of a marking code; 0 and unknown codes have none."""
    return _labelled(c, MARKING_LABELS)


def difficulty_label(c: Column) -> Column:
    return _labelled(c, DIFFICULTY_LABELS)


def example_text(before: Column, word: Column, after: Column) -> Column:
    """The rejoined example, NULL if any part is."""
    return F.concat(before, word, after)


def bracketed_example(before: Column, word: Column, after: Column) -> Column:
    return F.concat(before, F.lit("【"), word, F.lit("】"), after)


def sql_quote(c: Column) -> Column:
    """SQL string literal with doubled quotes; the word NULL for a missing value."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def sql_number(c: Column) -> Column:
    """SQL number; NULL for a missing value and for zero."""
    return F.coalesce(zero_to_null(c).cast("string"), F.lit("NULL"))


def as_of_column(as_of: datetime | str | None) -> Column:
    """The report's clock: a fixed instant, or now."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def days_before(as_of: datetime | str | None, days: int) -> Column:
    return as_of_column(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def shuffle_key(seed: str | int | None, key: Column) -> Column:
    """Sort key of a random pick: repeatable for a seed, fresh without one."""
    if seed is None:
        return F.rand()
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
