"""Turning a grid on its side, and treating placeholders across all columns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import placeholder_to_null, placeholder_to_zero, rounded_half_even, trim_code
from ..sources.sheets import ROW
from .labels import melt_cells
from .numbering import number_rows

TILE_ROWS, TILE_COLUMNS = 1024, 64

# Rows of a forecast sheet that are no period.
EXTRA_ROWS = ["Cases / Pallet", "Case Weight"]

# What the name of a numeric planning column contains.
PERIOD_NAME_PARTS = [
    "fy", "total",
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
]


def row_names(named: DataFrame, label: str, taken: tuple[str, ...]) -> DataFrame:
    """``row_idx, _name``: a name for every row, no two of them equal in upper or lower case, nor to one of those ``taken``.

    The first row of a name keeps it, later ones are numbered from 1 in sheet order, passing over numbers that would give a name
    some other row has of its own; repeats of a taken name are all numbered. Rows are ranked through the whole table, so a name that most rows have fills many tasks.
    """
    same = F.lower(F.col("_label"))
    rows = named.select(F.col(ROW), F.col(label).alias("_label")).withColumn("_same", same)
    numbered = number_rows(rows, ["_same", ROW], "_number")
    firsts = numbered.groupBy("_same").agg(F.min("_number").alias("_first"))
    started = F.when(F.col("_same").isin(*[t.lower() for t in taken]), 1).otherwise(0)
    ranked = numbered.join(firsts, "_same").withColumn("_rank", F.col("_number") - F.col("_first") + started)
    # Names of other rows that look like a number given here, and the rank from which each of them shifts the numbers.
    digits = r"^(.*)_([1-9][0-9]{0,17})$"
    own = firsts.select("_same").union(named.sparkSession.createDataFrame([(t.lower(),) for t in taken], "_same string")).distinct()
    looks = own.filter(F.col("_same").rlike(digits)).select(
        F.regexp_extract("_same", digits, 1).alias("_same"), F.regexp_extract("_same", digits, 2).cast("long").alias("_used"))
    place = Window.partitionBy("_same").orderBy("_used")
    shifts = looks.join(firsts.select("_same"), "_same", "left_semi").withColumn("_from", F.col("_used") - F.row_number().over(place) + 1)
    plain = ranked.join(shifts.select("_same").distinct(), "_same", "left_anti").select(ROW, "_label", F.col("_rank").alias("_n"))
    shifted = ranked.join(shifts.select("_same").distinct(), "_same", "left_semi").select("_same", ROW, "_label", F.col("_rank").alias("_from"))
    both = shifted.unionByName(shifts.select("_same", "_from"), allowMissingColumns=True)
    so_far = Window.partitionBy("_same").orderBy("_from", F.col(ROW).isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    moved = both.withColumn("_shift", F.sum(F.col(ROW).isNull().cast("long")).over(so_far)).filter(F.col(ROW).isNotNull())
    moved = moved.select(ROW, "_label", F.when(F.col("_from") > 0, F.col("_from") + F.col("_shift")).otherwise(0).alias("_n"))
    n = F.col("_n")
    name = F.when(n == 0, F.col("_label")).otherwise(F.concat("_label", F.lit("_"), n.cast("string")))
    return plain.unionByName(moved).select(ROW, name.alias("_name"))


def _flippable(grid: DataFrame, corner: str) -> tuple[DataFrame, int, str, list[str]]:
    """The rows that have a name, the first one named ``corner``, the naming column and the others."""
    first, *cells = [c for c in grid.columns if c != ROW]
    named = grid.filter(F.col(first).isNotNull() & ~F.col(first).isin(*EXTRA_ROWS))
    code_at = named.filter(F.col(first) == corner).agg(F.min(ROW)).first()[0]
    if code_at is None:
        raise ValueError(f"no row is named {corner}")
    return named, code_at, first, cells


def _flipped(named: DataFrame, code_at: int, cells: list[str], corner: str, was: str) -> DataFrame:
    """``row_idx, was, corner, cell`` for every cell but the codes'."""
    former = F.element_at(F.array(*[F.lit(c) for c in cells]), F.col("col_idx")).alias(was)
    codes = melt_cells(named.filter(F.col(ROW) == code_at), [], cells).select(former, trim_code(F.col("cell")).alias(corner))
    long = melt_cells(named.filter(F.col(ROW) != code_at), [F.col(ROW)], cells)
    # As many codes as the grid has columns.
    return long.select(ROW, former, rounded_half_even(F.col("cell")).alias("cell")).join(F.broadcast(codes), was)


def transpose_long(grid: DataFrame, corner: str = "SKU", was: str = "Period", label: str = "name") -> DataFrame:
    """A grid whose first column names its rows, cell by cell: ``row_idx``, the row's name under ``label``, the name of its former column under
    ``was``, that column's code under ``corner``, and ``cell`` as a whole number.

    Codes come from the first row named ``corner``. Rows without a name and the extra rows of a forecast sheet are left
    out. Names are told apart by ``row_names``; they are a table that is joined, and no row of a grid, however tall, comes to the driver.
    """
    named, code_at, first, cells = _flippable(grid, corner)
    names = row_names(named.filter(F.col(ROW) != code_at), first, (corner, was))
    long = _flipped(named, code_at, cells, corner, was)
    return long.join(names.withColumnRenamed("_name", label), ROW).select(ROW, label, was, corner, "cell")


def transpose_wide(grid: DataFrame, corner: str = "SKU", was: str = "Period") -> DataFrame:
    """Flip a grid whose first column names its rows.

    Row names become columns, in sheet order, and each former column a row:
    first ``corner``, whose cells are the codes of the former columns, then
    their names under ``was``. The names are read on the driver, as they become a schema; grids too tall for one have ``transpose_long`` and ``transpose_tiles``.
    """
    named, code_at, first, cells = _flippable(grid, corner)
    rows = sorted(map(tuple, row_names(named.filter(F.col(ROW) != code_at), first, (corner, was)).collect()))
    if not rows:
        codes = melt_cells(named.filter(F.col(ROW) == code_at), [], cells)
        name = F.element_at(F.array(*[F.lit(c) for c in cells]), F.col("col_idx"))
        return codes.select(trim_code(F.col("cell")).alias(corner), name.alias(was))
    long = _flipped(named, code_at, cells, corner, was)
    wide = long.groupBy(corner, was).pivot(ROW, [at for at, _ in rows]).agg(F.first("cell", ignorenulls=True))
    return wide.toDF(corner, was, *[name for _, name in rows])


def transpose_tiles(grid: DataFrame, corner: str = "SKU", was: str = "Period", height: int = TILE_ROWS, width: int = TILE_COLUMNS) -> DataFrame:
    """The flipped grid in tiles: ``row_block``, ``names``, ``was``, ``corner``, ``cells``.

    A former column is a row for every block of ``height`` rows, in sheet order, with their names and its cells. Rows meet in tiles of at most
    ``height`` by ``width`` cells, which are turned where they lie, so a grid may be as tall as it likes and no task holds more than a tile.
    """
    named, code_at, first, cells = _flippable(grid, corner)
    kept = named.filter(F.col(ROW) != code_at)
    names = row_names(kept, first, (corner, was))
    packed_rows = kept.select(ROW, F.array(*[rounded_half_even(F.col(c)) for c in cells]).alias("_cells"))
    placed = number_rows(packed_rows.join(names, ROW), [ROW], "_at", F.lit(-1))
    starts = F.sequence(F.lit(0), F.lit(len(cells) - 1), F.lit(width))
    slices = placed.select(
        F.floor(F.col("_at") / height).alias("row_block"), F.struct("_at", "_name").alias("_row"), "_cells", F.explode(starts).alias("_start"),
    ).select("row_block", "_start", F.struct("_row", F.slice("_cells", F.col("_start") + 1, width).alias("_cells")).alias("_row"))
    tiles = slices.groupBy("row_block", "_start").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    inside = F.sequence(F.lit(0), F.size(F.col("_rows")[0]["_cells"]) - 1)
    turned = tiles.select(
        "row_block", "_start", F.transform("_rows", lambda r: r["_row"]["_name"]).alias("names"),
        F.explode(F.transform(inside, lambda j: F.struct(j.alias("_j"), F.transform("_rows", lambda r: r["_cells"][j]).alias("cells")))).alias("_c"),
    )
    former = F.element_at(F.array(*[F.lit(c) for c in cells]), (F.col("_start") + F.col("_c._j") + 1).cast("int"))
    turned = turned.select("row_block", "names", former.alias(was), F.col("_c.cells").alias("cells"))
    codes = melt_cells(named.filter(F.col(ROW) == code_at), [], cells)
    codes = codes.select(F.element_at(F.array(*[F.lit(c) for c in cells]), F.col("col_idx")).alias(was), trim_code(F.col("cell")).alias(corner))
    return turned.join(F.broadcast(codes), was).select("row_block", "names", was, corner, "cells")


def pivot_first(long: DataFrame, by: list[str], label: str, value: str, order: str, labels: list) -> DataFrame:
    """Labels to columns; of several values under one label the first in ``order``."""
    first = F.min(F.struct(order, value)).getField(value)
    cells = long.groupBy(*by, label).agg(first.alias(value))
    return cells.groupBy(*by).pivot(label, labels).agg(F.first(value, ignorenulls=True))


def normalize_placeholders(df: DataFrame) -> DataFrame:
    """Dashes, blanks and spelled-out zeros to the text ``0`` in every text column."""
    return df.select(*[placeholder_to_zero(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def placeholders_to_null(df: DataFrame) -> DataFrame:
    """A dash or a blank to NULL in every text column."""
    return df.select(*[placeholder_to_null(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def cast_period_columns(df: DataFrame) -> DataFrame:
    """Columns named after a year, a total or a month become numbers."""
    def numeric(name):
        return any(part in name.lower() for part in PERIOD_NAME_PARTS)

    return df.select(*[F.col(c).try_cast("double").alias(c) if numeric(c) else F.col(c) for c in df.columns])


def cells_of(grid: DataFrame, label: str) -> DataFrame:
    """``label, col_idx, cell`` for every cell right of a grid's first column."""
    first, *cells = [c for c in grid.columns if c != ROW]
    return melt_cells(grid, [F.col(first).alias(label)], cells)


def melt_labels(wide: DataFrame, keep: list[str], columns: list[str], label: str, value: str) -> DataFrame:
    """Columns back to rows, each under its own name."""
    long = melt_cells(wide, [F.col(c) for c in keep], columns, value)
    names = F.array(*[F.lit(c) for c in columns])
    return long.select(*keep, F.element_at(names, F.col("col_idx")).alias(label), value)
