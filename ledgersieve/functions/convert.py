"""Text-to-type conversion that yields NULL instead of failing, plus exact percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ISO_DATE = "yyyy-MM-dd"


def iso_date(text: Column) -> Column:
    """DATE for a YYYY-MM-DD text that is a real day, else NULL.

    A cast reads ten plain characters far faster than a date format does, which is left for the rest.
    """
    plain = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(plain, text.try_cast("date")).otherwise(F.try_to_date(text, ISO_DATE))


def money(text: Column) -> Column:
    """DECIMAL(18,2), half up; NULL when not numeric or out of range."""
    return text.try_cast(DecimalType(18, 2))


def whole_number(text: Column) -> Column:
    """Whole number. '2.5' becomes 3, which a cast to an integer type would turn into NULL."""
    return text.try_cast(DecimalType(38, 0))


DECIMAL_TEXT = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def number(text: Column) -> Column:
    """DOUBLE for a decimal text, else NULL; a bare cast would also take '12d' or '0x1p3'."""
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))


def code(text: Column) -> Column:
    """Upper-cased, trimmed code. Blank text stays '' (wrong), only NULL is missing."""
    return F.upper(F.trim(text))


def whole_match(text: Column, pattern: str) -> Column:
    """True when the whole text matches; rlike alone searches for a substring."""
    return text.rlike(rf"\A(?:{pattern})\z")


def line_key(po_id: Column, item_no: Column) -> Column:
    """po_id|item_no, NULL when either part is NULL."""
    return F.concat(po_id, F.lit("|"), item_no.cast("string"))


def padded(number_col: Column, width: int) -> Column:
    """Zero-padded number of at least `width` digits; longer numbers keep every digit."""
    text = number_col.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole rounded half up to `digits`, NULL for an empty whole.

    Done in integers: a rounded quotient that is rounded again can land on the wrong
    side of a tie, and engines disagree on rounding binary fractions.
    """
    scale = 10**digits
    whole = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    doubled = part.cast("bigint") * F.lit(200 * scale) + whole
    units = F.floor((doubled - F.pmod(doubled, whole * 2)) / (whole * 2))
    return units.cast("double") / F.lit(float(scale))
