"""Forecast sheets: periods down, SKUs across."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_code, fill_item_prefix, is_kept_period, unsigned_quantity
from ..sources.sheets import ROW, cell_columns
from .calendar import attach_calendar
from .labels import melt_cells, stacked_rows, strip

# How many rows may hold the headers, and what names the SKU row.
PREVIEW_ROWS = 25
NEAR_TOP = 200  # where these rows are looked for first, which spares reading the whole sheet
SKU = "sku"


def preview_rows(grid: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows that are there, in sheet order."""
    return grid.orderBy(ROW).limit(n)


@dataclass(frozen=True)
class Layout:
    """Positions of the SKU row, the row before it (if any) and the first period row."""

    sku: int
    item: int | None
    start: int


def find_layout(grid: DataFrame, preview: int = PREVIEW_ROWS) -> Layout:
    """Where a forecast grid's headers and data stand, within its first rows.

    The row before the SKU row is the row that survived before it, not the
    index before it; without one there are no items. The first cells of the
    preview rows come to the driver, as their positions shape the plan.
    """
    first = cell_columns(grid)[0]
    labelled = grid.select(ROW, strip(F.col(first)).alias("label"))
    head = preview_rows(labelled.filter(F.col(ROW) <= NEAR_TOP), preview).collect()
    if len(head) < preview:
        head = preview_rows(labelled, preview).collect()
    labels = sorted((row[ROW], row["label"] or "") for row in head)
    sku = next((row for row, label in labels if label.lower() == SKU), None)
    if sku is None:
        raise ValueError("no SKU header row")
    item = max((row for row, _ in labels if row < sku), default=None)
    start = next((row for row, label in labels if row > sku and label.startswith("F") and "-" in label), None)
    if start is None:
        raise ValueError("no forecast period row")
    return Layout(sku, item, start)


def rows_from(grid: DataFrame, position: int) -> DataFrame:
    return grid.filter(F.col(ROW) >= position)


def header_pairs(grid: DataFrame, layout: Layout) -> DataFrame:
    """Per cell column its ``item`` and ``sku``; columns with neither are left out.

    As many rows as the grid has columns. Without an item row every item is NULL.
    """
    pairs = stacked_rows(grid, item=layout.item, sku=layout.sku)

    def text(name):
        return F.when(F.col(name) != "", strip(F.col(name))).alias(name)

    pairs = pairs.select("col_idx", text("item"), text("sku"))
    return pairs.filter((F.coalesce("item", F.lit("")) != "") | (F.coalesce("sku", F.lit("")) != ""))


def forecast_cells(grid: DataFrame, city: str, layout: Layout | None = None) -> DataFrame:
    """``Period, SKU, Item, Forecast_Value`` per cell, before dates are attached."""
    layout = layout or find_layout(grid)
    first, *cells = cell_columns(grid)
    period = F.trim(first)
    rows = rows_from(grid, layout.start).filter(is_kept_period(period))
    above = header_pairs(grid, layout).withColumn("sku", clean_code(F.col("sku")))
    above = above.withColumn("item", fill_item_prefix(clean_code(F.col("item")), F.col("sku"), city))
    long = melt_cells(rows, [period.alias("Period")], cells)
    return long.join(F.broadcast(above), "col_idx").select(
        "Period",
        F.col("sku").alias("SKU"),
        F.col("item").alias("Item"),
        unsigned_quantity(F.col("cell")).alias("Forecast_Value"),
    )


def melt_forecast(grid: DataFrame, city: str, mondays: DataFrame) -> DataFrame:
    """A forecast grid as ``Period, Date, SKU, Item, Forecast_Value``."""
    dated = attach_calendar(forecast_cells(grid, city), mondays)
    return dated.select("Period", "Date", "SKU", "Item", "Forecast_Value")
