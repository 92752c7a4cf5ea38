"""Catalog tables in, and several of them as one."""

import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import forecast_location, plan_location


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_existing(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """The tables that exist, by name; a warning for each that does not. Other errors are raised."""
    found = {}
    for name in names:
        if spark.catalog.tableExists(name):
            found[name] = spark.table(name)
        else:
            warnings.warn(f"no table {name}, skipped", stacklevel=2)
    return found


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def short_name(table: str) -> str:
    return table.split(".")[-1]


def kind_of(table: str) -> str | None:
    """Plan or forecast, by the table's name."""
    name = short_name(table)
    return "plan" if name.startswith("Vert_") else "forecast" if name.startswith("Forecast_") else None


def union_sources(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no sources")
    return reduce(DataFrame.unionByName, frames)


def plan_columns(df: DataFrame, table: str) -> DataFrame:
    """A source in the planning layout: value from either column, city and state if it has them."""
    have = df.columns
    value = next((c for c in ("Planning_Value", "Forecast_Value") if c in have), None)
    if value is None:
        raise ValueError(f"neither Planning_Value nor Forecast_Value in {table}")

    def optional(name):
        return (F.col(name) if name in have else F.lit(None).cast("string")).alias(name)

    return df.select(
        "Period", "Date", "Item", F.col(value).alias("Planning_Value"),
        optional("City"), optional("State"),
        plan_location(F.lit(short_name(table))).alias("Location"),
    )


def forecast_columns(df: DataFrame, table: str) -> DataFrame:
    """A source in the forecast layout."""
    return df.select(
        "Period", "Date", "SKU", "Item", "Forecast_Value",
        forecast_location(F.lit(short_name(table))).alias("Location"),
    )
