"""Rows of a grid that are found by what their first cell says."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mixed_date
from ..sources.sheets import ROW, cell_columns, quoted

PERIOD = "period"
DATE = "date"

# Fixed value: the label of a column whose period cell is blank.
NO_PERIOD = "Unknown"


def label_of(grid: DataFrame) -> Column:
    """The first cell as a label: trimmed, lower case."""
    return F.lower(F.trim(F.col(cell_columns(grid)[0])))


def strip(c: Column) -> Column:
    """Without white space of any kind around it, non-breaking blanks too."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def packed(cells: list[str]) -> Column:
    """Cells of a row as one array."""
    return F.expr(f"array({quoted(cells)})")


def label_positions(grid: DataFrame, labels: Sequence[str]) -> list[int | None]:
    """Per label the first row it names, if any.

    One small job that reads two columns of the grid, however wide it is. The
    numbers it brings back let later filters reach the scan as constants.
    """
    label = label_of(grid)
    found = [F.min(F.when(label == wanted.lower(), F.col(ROW))) for wanted in labels]
    return list(grid.agg(*found).first())


def label_position(grid: DataFrame, labels: Sequence[str]) -> int:
    """Where the first of ``labels`` that occurs is first found."""
    return _first_found(labels, label_positions(grid, labels))


def _first_found(labels: Sequence[str], positions: Sequence[int | None]) -> int:
    for position in positions:
        if position is not None:
            return position
    raise ValueError(f"no row is labelled {' or '.join(labels)}")


def rows_at(grid: DataFrame, *positions: int | None) -> DataFrame:
    """The rows at the positions that are known."""
    return grid.filter(F.col(ROW).isin([p for p in positions if p is not None]))


def find_label_row(grid: DataFrame, labels: Sequence[str]) -> DataFrame:
    return rows_at(grid, label_position(grid, labels))


def stacked_rows(grid: DataFrame, **positions: int | None) -> DataFrame:
    """Rows laid side by side, one row per cell column: ``col_idx`` and each row's cells under its name.

    A row without a position has NULL cells. The result is as long as the grid
    is wide.
    """
    cells = packed(cell_columns(grid)[1:])
    at = {name: F.lit(p).cast("bigint") for name, p in positions.items()}
    row = rows_at(grid, *positions.values()).select(ROW, cells.alias("cells"))
    one = row.agg(*[F.max(F.when(F.col(ROW) == p, F.col("cells"))).alias(name) for name, p in at.items()])
    width = len(cell_columns(grid)) - 1
    blank = F.array_repeat(F.lit(None).cast("string"), width)
    one = one.select(*[F.coalesce(name, blank).alias(name) for name in positions])
    side = one.select(F.posexplode(F.arrays_zip(*positions)).alias("pos", "cell"))
    return side.select((F.col("pos") + 1).alias("col_idx"), *[F.col(f"cell.{name}").alias(name) for name in positions])


def column_map(grid: DataFrame, week_label: str | None, period_dash: str = "-", repair_year: bool = True) -> DataFrame:
    """What stands above each cell column: ``col_idx, period, date_text, date``.

    Dates come from the date row or, without one, from the week row, and are
    parsed here, once per column. The result has one row per column of the
    grid, a number fixed by its schema.
    """
    dates = [DATE] if week_label is None else [DATE, week_label]
    period_at, *dates_at = label_positions(grid, [PERIOD, *dates])
    above = stacked_rows(grid, period=_first_found([PERIOD], [period_at]), date=_first_found(dates, dates_at))
    period = F.coalesce(strip(F.col("period")), F.lit(NO_PERIOD))
    if period_dash != "-":
        period = F.replace(period, F.lit("-"), F.lit(period_dash))
    date_text = strip(F.col("date"))
    return above.select(
        "col_idx",
        period.alias("period"),
        date_text.alias("date_text"),
        mixed_date(date_text, repair_year).alias("date"),
    )


def data_rows(grid: DataFrame, week_label: str | None) -> DataFrame:
    """Rows that are no label row and have a first cell."""
    labels = [PERIOD, DATE] + ([week_label.lower()] if week_label else [])
    first = F.col(cell_columns(grid)[0])
    return grid.filter(first.isNotNull() & ~label_of(grid).isin(*labels))


def melt_cells(grid: DataFrame, keep: list[Column], cells: list[str], value: str = "cell") -> DataFrame:
    """One row per cell: ``keep`` columns, ``col_idx`` from 1, and the cell.

    The cells are packed into one array before they are taken apart. Everything
    after that has a handful of columns and compiles; several hundred columns
    would not.
    """
    narrow = grid.select(*keep, packed(cells).alias("_cells"))
    names = [c for c in narrow.columns if c != "_cells"]
    long = narrow.select(*names, F.posexplode("_cells").alias("_pos", value))
    return long.select(*names, (F.col("_pos") + 1).alias("col_idx"), value)
