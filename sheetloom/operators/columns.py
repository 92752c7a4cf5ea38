"""Column names: cleaned, made unique, built from header rows, moved and dropped."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..sources.sheets import ROW, cell_columns
from .forecast_melt import preview_rows

# Characters of a name that become an underscore, and the names
# of the first three columns of a two-row header.
REPLACED = " .-/"
LEADING_NAMES = ["Category", "SubCategory", "Customer"]


def clean_name(name: str | None) -> str:
    return (name or "").strip().translate(str.maketrans(REPLACED, "_" * len(REPLACED)))


def unique_names(names: Sequence[str | None], ignore_case: bool = False) -> list[str]:
    """Number repeats from 1, passing over names that are already taken.

    ``ignore_case`` keeps apart names that Spark would take for one column.
    """
    same = str.lower if ignore_case else str
    taken: set[str] = set()
    last: dict[str, int] = {}
    unique = []
    for name in names:
        base = candidate = name or ""
        n = last.get(same(base), 0)
        while same(candidate) in taken:
            n += 1
            candidate = f"{base}_{n}"
        last[same(base)] = n
        taken.add(same(candidate))
        unique.append(candidate)
    return unique


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def unique_columns(df: DataFrame, names: Sequence[str | None]) -> DataFrame:
    return df.toDF(*unique_names(names))


def positional_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def swap_columns(df: DataFrame, one: str, other: str) -> DataFrame:
    change = {one: other, other: one}
    return df.selectExpr(*[f"`{change.get(c, c)}`" for c in df.columns])


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def _renamed(grid: DataFrame, names: list[str]) -> DataFrame:
    return grid.select(ROW, *cell_columns(grid)).toDF(ROW, *unique_names([clean_name(n) for n in names]))


def _header_rows(grid: DataFrame, n: int) -> list:
    rows = sorted(preview_rows(grid, n).collect(), key=lambda row: row[ROW])
    if len(rows) < n:
        raise ValueError(f"a grid needs at least {n} rows")
    return rows


def two_row_header(grid: DataFrame, leading: Sequence[str] = LEADING_NAMES, need: int = 3) -> DataFrame:
    """Name columns after their first two cells; all rows stay data.

    The first columns get fixed names. Names are part of the schema, so the
    ``need`` top rows come to the driver.
    """
    top, below, *_ = _header_rows(grid, need)
    cells = cell_columns(grid)
    joined = [f"{top[c]}_{below[c]}" if top[c] else str(below[c]) for c in cells[len(leading):]]
    return _renamed(grid, [*leading[:len(cells)], *joined])


def two_row_header_plain(grid: DataFrame) -> DataFrame:
    """Names from the first two cells where the first is filled, blank where not; ``0_0`` is ``0``."""
    top, below = _header_rows(grid, 2)
    names = []
    for c in cell_columns(grid):
        name = f"{top[c]}_{below[c]}" if top[c] is not None else ""
        names.append("0" if name == "0_0" else name)
    return _renamed(grid, names)
