"""Row numbers over whole tables, without bringing a table into one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import stage

# Copies of one row beyond this number are numbered in pieces of this size.
COPIES_PER_PIECE = 100_000


def with_copy_number(df: DataFrame, piece: int = COPIES_PER_PIECE) -> DataFrame:
    """Tell copies of a row apart by a number from 1.

    Copies are counted first, so many copies of one row travel as one row and a
    count. They are taken apart again in pieces that are spread over the tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    n = F.col("_n")
    few = counted.filter(n <= piece).withColumn("_copy", F.explode(F.sequence(F.lit(1), n)))
    pieces = F.explode(F.sequence(F.lit(0), F.floor((n - 1) / piece)))
    many = counted.filter(n > piece).withColumn("_piece", pieces)
    many = many.repartition(*df.columns, "_piece")
    start = F.col("_piece") * piece + 1
    many = many.withColumn("_copy", F.explode(F.sequence(start, F.least(start + piece - 1, n))))
    columns = [*df.columns, F.col("_copy").cast("bigint").alias("_copy")]
    return few.select(*columns).union(many.select(*columns))


def number_rows(df: DataFrame, order: list[str | Column], number: str, after: Column | None = None, ranged: bool = False) -> DataFrame:
    """A dense number from 1 in the given order, on top of ``after``.

    The order has to tell any two rows apart. The table is range-partitioned and
    sorted, and each row's partition and position within it are written down
    with it. A row's number is then its position plus the number of rows in all
    earlier partitions, of which there are only as many as partitions. Rows that
    already lie in ranges of the order, one partition after the other, are
    ``ranged`` and only sorted, unless they are.
    """
    placed = (df if ranged else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    # Running ids follow each other without gaps within a partition.
    placed = placed.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    staged = stage(placed, number)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    offsets = sizes.select("_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    value = F.col("_offset") + F.col("_place") - F.col("_first") + 1
    if after is not None:
        value = value + after
    numbered = staged.join(F.broadcast(offsets), "_part")
    return numbered.select(value.cast("bigint").alias(number), *df.columns)


def number_with_copies(df: DataFrame, order: list[str], number: str, after: Column | None = None) -> DataFrame:
    """As ``number_rows`` for a table in which rows may be equal in every column.

    All columns take part in the order, ``order`` first.
    """
    rest = [c for c in df.columns if c not in order]
    numbered = number_rows(with_copy_number(df), [*order, *rest, "_copy"], number, after)
    return numbered.drop("_copy")


def max_key(df: DataFrame, key: str) -> DataFrame:
    """One row: the highest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_key"))


def row_index(grid: DataFrame, order: str, name: str = "row_index") -> DataFrame:
    """The 0-based rank of each row in sheet order, gaps closed."""
    return number_rows(grid, [order], name, F.lit(-1))
