"""Natural keys, site codes taken from table names, and names of files and objects."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a source table's name carries its site code.
PLAN_SITE = r"Vert_([A-Z]+)_Plan"
FORECAST_SITE = r"Forecast_([A-Z]+)_"
NO_SITE = "Unknown"

# Fixed value: text that stands for a missing item in a forecast key.
NO_ITEM = "NA"


def _site(table: Column, pattern: str) -> Column:
    code = F.regexp_extract(table, pattern, 1)
    return F.when(code != "", code).otherwise(F.lit(NO_SITE))


def plan_location(table: Column) -> Column:
    return _site(table, PLAN_SITE)


def forecast_location(table: Column) -> Column:
    code = F.upper(F.regexp_extract(table, FORECAST_SITE, 1))
    return F.when(code != "", code).otherwise(F.lit(NO_SITE))


def plan_key(null_token: str | None = None) -> Column:
    """Period, date, item and location joined by dashes.

    Missing parts are left out, so rows that differ only in which part is
    missing can share a key; ``null_token`` keeps them apart.
    """
    parts = [F.col("Period"), F.col("Date").cast("string"), F.col("Item"), F.col("Location")]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.concat_ws("-", *parts)


def forecast_key() -> Column:
    """As ``plan_key``, with a word for a missing item. The SKU is not part of it."""
    return F.concat_ws(
        "-",
        F.col("Period"),
        F.col("Date").cast("string"),
        F.coalesce(F.col("Item").cast("string"), F.lit(NO_ITEM)),
        F.col("Location"),
    )


def resource_name(file_name: Column) -> Column:
    """File name without its workbook extension."""
    return F.replace(file_name, F.lit(".xlsx"), F.lit(""))


def object_key(file_name: Column, prefix: str) -> Column:
    """Where a landed file is stored: prefix, resource name, file name."""
    return F.concat_ws("/", F.lit(prefix), resource_name(file_name), file_name)
