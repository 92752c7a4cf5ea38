"""New states of keyed fact tables.

Each operator returns the state as a DataFrame; sinks decide how it is written.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .numbering import max_key, number_rows, number_with_copies

# Rows that one task sorts, and one row in how many is looked at to tell how many tasks that takes.
ROWS_PER_TASK = 1_000_000
ONE_IN = 256


def dedup_by_key(df: DataFrame, key: str, order: list[Column], ranged: bool = False, seen: DataFrame | None = None) -> DataFrame:
    """One row per key, the first in ``order``.

    A key that many rows share arrives as at most one row per task, as Spark drops
    the losers of each task before the shuffle. That sorts all rows twice. With
    ``seen``, ``some_rows`` of them, only the keys that it finds to have many rows are
    looked through before. ``ranged`` rows are left in ranges of the key, so that
    ``number_rows`` needs no shuffle of its own.
    """
    best = Window.partitionBy(key).orderBy(*order)
    if seen is None and not ranged:
        return df.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") == 1).drop("_rank")
    tasks, crowded = crowded_keys(some_rows(df) if seen is None else seen, key)
    if crowded:
        named = [k for k in crowded if k is not None]
        is_crowded = F.coalesce(F.col(key).isin(*named), F.lit(None in crowded)) if named else F.col(key).isNull()
        df = df.filter(~is_crowded).unionByName(dedup_by_key(df.filter(is_crowded), key, order))
    placed = df.repartitionByRange(tasks, key) if ranged else df
    # The first row of a key has none before it. A rank would make Spark look through each task's rows once more.
    return placed.withColumn("_before", F.lag(F.lit(True)).over(best)).filter(F.col("_before").isNull()).drop("_before")


def some_rows(df: DataFrame) -> DataFrame:
    """About one row in ``ONE_IN``."""
    return df.sample(1 / ONE_IN, seed=1)


def crowded_keys(seen: DataFrame, key: str) -> tuple[int, list]:
    """How many tasks of ``ROWS_PER_TASK`` a table needs, and the keys, NULL among them, that would fill a quarter of one.

    Both are told from ``some_rows`` of it and only steer where rows go.
    """
    counts = seen.groupBy(key).agg(F.count("*").alias("n"))
    many = F.when(F.col("n") * ONE_IN >= ROWS_PER_TASK // 4, F.struct(key))
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.collect_list(many).alias("crowded")).first()
    return row["n"] * ONE_IN // ROWS_PER_TASK + 1, [r[0] for r in row["crowded"]]


def largest_first(df: DataFrame, value: str) -> list[Column]:
    """A total order for ``dedup_by_key``: largest value, then every other column."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != value]
    return [F.col(value).desc_nulls_last(), *rest]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def rows_with_new_keys(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key the target does not have. Spark splits a hot key on the left at run time."""
    return incoming.join(target.select(key), key, "left_anti")


def rows_with_keys_in(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target rows that an incoming key selects for deletion."""
    return target.join(incoming.select(key).distinct(), key, "left_semi")


def rows_with_keys_not_in(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target rows that stay when incoming keys are deleted."""
    return target.join(incoming.select(key).distinct(), key, "left_anti")


def match_by_key(target: DataFrame, incoming: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Target rows with a match, beside the incoming values as ``new_<column>``."""
    fresh = incoming.select(key, *[F.col(c).alias(f"new_{c}") for c in columns])
    return target.join(fresh, key, "inner")


def upsert_changed(target: DataFrame, incoming: DataFrame, key: str, value: str, also: list[str]) -> DataFrame:
    """The target with changed values taken over, along with the ``also`` columns.

    A value changes if both are there and differ, or if only the incoming one is
    there. A missing incoming value never overwrites. Keys are unique on both
    sides; rows are neither added nor removed.
    """
    taken = [value, *also]
    fresh = incoming.select(key, *[F.col(c).alias(f"_new_{c}") for c in taken])
    old, new = F.col(value), F.col(f"_new_{value}")
    changes = F.coalesce(old != new, F.lit(False)) | (new.isNotNull() & old.isNull())
    columns = [
        F.when(changes, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
        for c in target.columns
    ]
    return target.join(fresh, key, "left").select(*columns)


def insert_new(target: DataFrame, incoming: DataFrame, key: str, number: str) -> DataFrame:
    """Incoming rows with keys the target lacks, numbered on from its highest number."""
    fresh = rows_with_new_keys(incoming, target, key)
    numbered = number_rows(fresh, [key], number, max_key(target, number).scalar())
    return numbered.select(*target.columns)


def initial_load(rows: DataFrame, key: str, number: str, columns: list[str], ranged: bool = False) -> DataFrame:
    """A first state: unique rows numbered by key."""
    return number_rows(rows, [key], number, ranged=ranged).select(*columns)


def replace_by_key(target: DataFrame, incoming: DataFrame, key: str, number: str, order: list[str]) -> DataFrame:
    """Target rows with incoming keys go, all incoming rows come, copies included.

    New numbers follow the highest one before anything was removed, so a number
    is never used twice.
    """
    kept = rows_with_keys_not_in(target, incoming, key)
    numbered = number_with_copies(incoming, order, number, max_key(target, number).scalar())
    return kept.select(*target.columns).union(numbered.select(*target.columns))
