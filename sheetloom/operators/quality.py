"""Checks on what the reshaping and the fact builds did."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage

BLOCKS = 4096


def reconcile_cells(original: DataFrame, reshaped: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that differ between two long forms, by key; NULL equals NULL, a cell missing on one side differs.

    Both sides hold ``keys`` and ``value``, each key once.
    """
    left = original.select(*keys, F.col("value").alias("original"), F.lit(True).alias("_in_original"))
    right = reshaped.select(*keys, F.col("value").alias("reshaped"), F.lit(True).alias("_in_reshaped"))
    both = left.join(right, keys, "full")
    missing = F.col("_in_original").isNull() | F.col("_in_reshaped").isNull()
    return both.filter(missing | ~F.col("original").eqNullSafe(F.col("reshaped"))).select(*keys, "original", "reshaped")


def _any_null(columns: list[str]):
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def cell_digests(cells: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Per group ``by`` an order-free digest of its cells: their number, and sums of the halves of two hashes of each.

    Tasks add up before anything is shuffled, so a group costs a row per task, however many cells it has.
    """
    flags = [F.col("value").isNull()]
    halves = []
    for seed in (1, 2):
        hashed = F.xxhash64(F.lit(seed), *keys, "value", *flags)
        halves += [F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"low_{seed}"), F.sum(F.shiftrightunsigned(hashed, 32)).alias(f"high_{seed}")]
    return cells.groupBy(*by).agg(F.count("*").alias("n"), *halves)


def _differing(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """The groups whose digests differ, or that one side lacks."""
    sums = [c for c in left.columns if c != by]
    both = left.select(by, F.struct(*sums).alias("_left")).join(right.select(by, F.struct(*sums).alias("_right")), by, "full")
    return both.filter(~F.col("_left").eqNullSafe(F.col("_right"))).select(by)


def reconcile_by_digest(original: DataFrame, reshaped: DataFrame, keys: list[str], row: str | None = None, blocks: int = BLOCKS) -> DataFrame:
    """As ``reconcile_cells``, but cells are joined only where digests differ.

    Rows, told by the first key or by ``row``, are dealt to blocks by their hash. The blocks' digests are compared first, at most ``blocks`` of
    them; in those that differ the rows' digests; in the rows that differ the cells. Equal grids shuffle no cells at all. Cells with a
    NULL key, which meet none, are always shown.
    """
    row = row or keys[0]

    def prepared(df):
        return df.select(*keys, "value").withColumn("_block", F.pmod(F.xxhash64(row), F.lit(blocks)).cast("int"))

    left, right = prepared(original), prepared(reshaped)
    whole_left, whole_right = (df.filter(~_any_null(keys)) for df in (left, right))
    found = _differing(cell_digests(whole_left, ["_block"], keys), cell_digests(whole_right, ["_block"], keys), "_block")
    suspects = [r[0] for r in found.collect()]  # at most ``blocks`` numbers
    nulls = left.filter(_any_null(keys)), right.filter(_any_null(keys))
    if not suspects:
        return reconcile_cells(nulls[0].drop("_block"), nulls[1].drop("_block"), keys)
    some_left, some_right = (df.filter(F.col("_block").isin(suspects)) for df in (whole_left, whole_right))
    rows = stage(_differing(cell_digests(some_left, [row], keys), cell_digests(some_right, [row], keys), row), "rows")
    sides = [some.join(rows, row, "left_semi").unionByName(null).drop("_block") for some, null in zip((some_left, some_right), nulls)]
    return reconcile_cells(*sides, keys)


def _key_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows, and rows left when each key stays once: one pass, one shuffle of keys and counts."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after"))


def row_counts(rows: DataFrame, key: str) -> DataFrame:
    """``stage, n_rows`` of a union and of its deduplication by key."""
    both = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(c).alias("n_rows")) for name, c in (("union", "rows_before"), ("unique", "rows_after"))])
    return _key_counts(rows, key).select(F.inline(both))


def reconcile_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows before and after deduplication by key, and whether it kept them all."""
    counts = _key_counts(rows, key)
    kept = F.col("rows_before") == F.col("rows_after")
    message = F.when(kept, F.lit("all rows kept")).otherwise(
        F.concat(F.lit("rows changed from "), F.col("rows_before"), F.lit(" to "), F.col("rows_after"))
    )
    return counts.select("rows_before", "rows_after", kept.alias("all_kept"), message.alias("message"))
