"""Sheets as tables of text.

A landed sheet is a table with ``row_idx`` (row number in the sheet, from 1) and
text columns ``_c0.._cN`` (from column A). A *grid* is a range cut out of it: the
same columns, counted from the range's left edge. ``row_idx`` is what gives rows
an order; nothing here depends on the order in which Spark reads them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import parse_range

ROW = "row_idx"


def cell_columns(grid: DataFrame) -> list[str]:
    return [c for c in grid.columns if c != ROW]


def quoted(names: list[str]) -> str:
    """Column names as a list in SQL. One text for hundreds of columns plans faster than as many objects."""
    return ", ".join(f"`{c}`" for c in names)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every cell is NULL.

    A plain filter over all cells would make Spark derive a version of it for
    every combination of renamed columns, which never ends on wide grids. The
    partition id, never negative, keeps the filter out of that.
    """
    never = "CASE WHEN spark_partition_id() < 0 THEN '' END"
    return df.filter(f"coalesce({quoted(cell_columns(df))}, {never}) IS NOT NULL")


def scan_range(sheet: DataFrame, cells: str, header: bool = False, drop_empty: bool = True) -> DataFrame:
    """The cells of a range as ``row_idx, _c0.._cN``.

    Rows and columns outside the range are cut by the scan itself. Columns that
    the sheet does not reach are blank. With ``header`` the first row that is
    left names the columns; those names are one row, read on the driver because
    a schema has to be known before the plan is. Readers that skip rows without
    a first cell anyway pass ``drop_empty=False``, which lets a later step read
    two columns instead of all.
    """
    wanted = parse_range(cells)
    have = set(sheet.columns)
    grid = sheet
    if wanted.first_row is not None:
        grid = grid.filter(F.col(ROW) >= wanted.first_row)
    if wanted.last_row is not None:
        grid = grid.filter(F.col(ROW) <= wanted.last_row)
    columns = []
    for position in range(wanted.width):
        name = f"_c{wanted.first_col + position}"
        columns.append(f"{name if name in have else 'CAST(NULL AS STRING)'} AS _c{position}")
    grid = grid.selectExpr(ROW, *columns)
    if drop_empty or header:
        grid = drop_empty_rows(grid)
    if not header:
        return grid
    top = grid.orderBy(ROW).limit(1).collect()
    if not top:
        raise ValueError(f"no header row in {cells}")
    names = [top[0][c] if top[0][c] is not None else c for c in cell_columns(grid)]
    return grid.filter(F.col(ROW) > top[0][ROW]).toDF(ROW, *names)


def scan_lookup(sheet: DataFrame, cells: str, code: str = "item") -> DataFrame:
    """A range with a header row, its code column as a whole number."""
    table = scan_range(sheet, cells, header=True).drop(ROW)
    number = F.col(code).try_cast("double").try_cast("bigint")
    return table.withColumn(code, number)


# Fixed value: where the calendar stands unless a source says otherwise.
CALENDAR_RANGE = "A2557:B2920"


def scan_calendar(sheet: DataFrame, cells: str | None = None) -> DataFrame:
    """The calendar range: raw date and period label."""
    grid = scan_range(sheet, cells or CALENDAR_RANGE)
    return grid.select(ROW, F.col("_c0").alias("raw_date"), F.trim("_c1").alias("Period"))


def inferred_types(grid: DataFrame) -> dict[str, str]:
    """The narrowest type that every filled cell of each column fits.

    One aggregate over the grid, one row of flags back.
    """
    names = cell_columns(grid)
    kinds = ["bigint", "double", "boolean", "date"]
    flags = [
        F.bool_and(F.when(F.col(c).isNotNull(), F.col(c).try_cast(k).isNotNull())).alias(f"{c}|{k}")
        for c in names
        for k in kinds
    ]
    row = grid.agg(*flags).first()
    return {c: next((k for k in kinds if row[f"{c}|{k}"]), "string") for c in names}


def scan_inferred(sheet: DataFrame, cells: str, header: bool = False) -> DataFrame:
    """A range with column types found from its cells instead of all text."""
    grid = scan_range(sheet, cells, header=header)
    types = inferred_types(grid)
    return grid.select(ROW, *[F.col(c).try_cast(t).alias(c) for c, t in types.items()])

