"""Text to typed values.

``mode`` is ``"try"`` (unreadable text gives null) or ``"strict"`` (unreadable text fails the job).
Staging pairs ``"try"`` with ``operators.staging.rejected_rows``, so that nothing is lost silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"
US_DATE = "MM/dd/yyyy"
DATE_FORMATS = (ISO_DATE, US_DATE)

# Quantities that arrive spelled out.
NUMBER_WORDS = {"ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5}

MODES = ("try", "strict")


def cast_text(c: Column, to: str, mode: str = "try") -> Column:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return c.cast(to) if mode == "strict" else c.try_cast(to)


def parse_int(c: Column, mode: str = "try") -> Column:
    """Whole number; fractions round half up, as a text-to-integer cast does in SQL warehouses."""
    return cast_text(cast_text(c, "decimal(38,0)", mode), "int", mode)


def parse_boolean(c: Column, mode: str = "try") -> Column:
    """``1/0/true/false/yes/no`` in any case."""
    return cast_text(c, "boolean", mode)


def parse_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that fits, else null.

    Fixed-width numeric formats are rearranged to ISO order and cast: the cast reads digits without
    a formatter and without an exception per mismatch, which is what a mixed column costs otherwise.
    """
    return F.coalesce(*[_parse_one(c, fmt) for fmt in formats])


def _parse_one(c: Column, fmt: str) -> Column:
    fixed_width = sorted(ch for ch in fmt if ch.isalpha()) == sorted("yyyyMMdd") and all(
        part in fmt for part in ("yyyy", "MM", "dd")
    )
    if not fixed_width or "_" in fmt or "%" in fmt:
        return F.try_to_date(c, fmt)
    shape = "".join("_" if ch.isalpha() else ch for ch in fmt)
    year, month, day = (
        F.substring(c, fmt.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")
    )
    return F.when(c.like(shape), F.concat_ws("-", year, month, day).try_cast("date"))


def word_number(c: Column) -> Column:
    """``two`` -> 2, ``' 12 '`` -> 12, ``2.5`` -> 3, anything else null."""
    word = F.upper(F.trim(c))
    numeric = F.trim(c).try_cast("decimal(38,0)")
    spelled = None
    for name, number in NUMBER_WORDS.items():
        value = F.lit(number).cast("decimal(38,0)")
        spelled = F.when(word == name, value) if spelled is None else spelled.when(word == name, value)
    return spelled.otherwise(numeric)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("decimal(1,0)"))


def or_zero(c: Column, of_type: str) -> Column:
    """Null becomes zero; the type is named so that the literal does not widen the column."""
    return F.coalesce(c, F.lit(0).cast(of_type))
