"""Text cleaning. All expressions stay inside whole-stage codegen (no lambdas, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a word starts in title case, besides white space.
# The apostrophe is not one of them, so O'BRIEN becomes O'brien.
TITLE_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

_WORD_BREAK = "([\\s" + "".join("\\" + ch for ch in TITLE_DELIMITERS if ch != '"') + '"])'
_BREAK_MARK = "\u0001 "


def trimmed(c: Column) -> Column:
    return F.trim(c)


def upper_clean(c: Column) -> Column:
    """Trimmed upper case: the form in which codes are compared."""
    return F.upper(F.trim(c))


def lower_clean(c: Column) -> Column:
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def title_case(c: Column) -> Column:
    """Title case that also starts a word after punctuation: ``24-port`` -> ``24-Port``.

    Spark's ``initcap`` starts words at spaces only, so each break character gets a marked space
    behind it before ``initcap`` and loses it again afterwards.
    """
    marked = F.regexp_replace(F.trim(c), _WORD_BREAK, "$1" + _BREAK_MARK)
    return F.replace(F.initcap(marked), F.lit(_BREAK_MARK), F.lit(""))


def capitalize_first(c: Column) -> Column:
    """First letter upper, all others lower: ``Al-Rashid`` -> ``Al-rashid``."""
    name = F.trim(c)
    return F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.substr(name, F.lit(2))))


def full_name(first: Column, last: Column) -> Column:
    """``first last``; null as soon as one part is null."""
    return F.concat(first, F.lit(" "), last)


def contains_ci(c: Column, word: str) -> Column:
    """Case-insensitive containment as a flag; null text gives false."""
    return F.coalesce(F.contains(F.upper(c), F.lit(word.upper())), F.lit(False))
