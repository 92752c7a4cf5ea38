"""Quantities as text: thousands commas, currency signs, dashes, brackets."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(text: Column) -> Column:
    """Text that may be empty or a lone dash as a number; both are set aside first, as casting them costs an exception per row."""
    return F.nullif(F.nullif(text, F.lit("")), F.lit("-")).try_cast("double")


def signed_quantity(c: Column, paren_negative: bool = False) -> Column:
    """Keep digits, point and minus; what is then no number is NULL.

    ``(5)`` reads as 5 unless ``paren_negative`` asks for accounting style, and
    ``-0`` as plain zero.
    """
    value = _number(F.regexp_replace(c, r"[^0-9.\-]", "")) + F.lit(0.0)
    if paren_negative:
        value = F.when(c.rlike(r"^\s*\(.*\)\s*$"), -F.abs(value)).otherwise(value)
    return value


def unsigned_quantity(c: Column) -> Column:
    """Keep digits and point (a sign is lost), round half up to whole units; no number is 0."""
    value = _number(F.regexp_replace(c, r"[^0-9.]", ""))
    return F.coalesce(F.round(value, 0), F.lit(0.0))


def quantity_or_zero(c: Column, strip_commas: bool = False) -> Column:
    """A dash or an empty text is 0, other text is a number or NULL; NULL stays NULL."""
    text = F.replace(c, F.lit(","), F.lit("")) if strip_commas else c
    return F.when(c.isin("-", ""), F.lit(0.0)).otherwise(text.try_cast("double") + F.lit(0.0))


def rounded_half_even(c: Column) -> Column:
    """Number rounded half to even as a whole number; NULL and text are 0."""
    return F.coalesce(F.bround(c.try_cast("double"), 0).try_cast("bigint"), F.lit(0).cast("bigint"))
