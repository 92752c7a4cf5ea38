"""Item and SKU codes, period labels and placeholder text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code prefix per site, for columns that carry a SKU but no item.
ITEM_PREFIX = {
    "SAN": "600",
    "San Antonio": "600",
    "STER": "200",
    "Sterling": "200",
}

# Words that mark a row of a forecast sheet as no period.
JUNK_PERIOD_WORDS = "pallet|weight|cases"

# Cell texts that stand for zero.
ZERO_TEXTS = ["-", "–", "—", "", " ", "- 0", "0.0"]


def clean_item(c: Column) -> Column:
    """Trim; cut ``.0`` from a number. A number ending in ``.0`` is digits before it, signed or not."""
    return F.regexp_replace(F.trim(c), r"^([+-]?[0-9]*)\.0$", "$1")


def clean_code(c: Column) -> Column:
    """Cut ``.0`` from an all-digit code, leave every other code as it is."""
    return F.regexp_replace(c, r"^([0-9]+)\.0$", "$1")


def trim_code(c: Column) -> Column:
    """Trim, then cut a trailing ``.0`` from any text."""
    return F.regexp_replace(F.trim(c), r"\.0$", "")


def fill_item_prefix(item: Column, sku: Column, city: str) -> Column:
    """A missing item becomes the site's prefix and the SKU; sites without a prefix keep it missing."""
    if city not in ITEM_PREFIX:
        return item
    missing = item.isNull() | (F.trim(item) == "")
    return F.when(missing, F.concat(F.lit(ITEM_PREFIX[city]), sku)).otherwise(item)


def is_kept_item(item: Column) -> Column:
    """False for a missing item and for zero; an empty text is kept."""
    return item.isNotNull() & ~item.isin("0", "0.0")


def is_kept_period(period: Column) -> Column:
    """False for missing labels, for labels that name a pallet, weight or cases row, and for bare numbers."""
    return (
        period.isNotNull()
        & (period != "")
        & ~F.lower(period).rlike(JUNK_PERIOD_WORDS)
        & ~period.rlike("^[0-9.]+$")
    )


def placeholder_to_zero(c: Column) -> Column:
    """Dashes, blanks and spelled-out zeros become the text ``0``."""
    return F.when(c.isin(*ZERO_TEXTS), F.lit("0")).otherwise(c)


def placeholder_to_null(c: Column) -> Column:
    """A dash or a blank becomes NULL."""
    return F.when(~F.trim(c).isin("-", ""), c)
