"""Joins whose left side may hold a third of its rows under one key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage

# A side within these sizes is sent to every task; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024

HOT_SHARE = 0.01  # a key with this share of the rows is spread,
SALTS = 64  # over this many partitions


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both limits, counted and measured where it lies."""
    width = F.length(F.to_json(F.struct("*")))
    seen = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return seen["n"] <= rows and seen["size"] <= size


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys, NULL among them, that hold at least ``share`` of the rows; at most ``1 / share``.

    A frequent-items sketch per task, merged: one pass over the key column and
    no shuffle by key. It only steers routing, so its error changes no result.
    """
    most = int(1 / share)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {most * 100})")
    row = df.agg(sketch.alias("top"), F.count("*").alias("n")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= row["n"] * share]


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join to a right side with few rows per key, sent to every task where its size allows.

    The right side is written first, so that measuring it and joining to it
    compute it once.
    """
    right = stage(right, "joined")
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key, how)
    return join_spread(left, right, key, how)


def join_spread(left: DataFrame, right: DataFrame, key: str, how: str = "left", salts: int = SALTS, hot: list | None = None) -> DataFrame:
    """Join by shuffling both sides, with the left rows of hot keys spread over the tasks.

    A hot row's salt is the task that reads it, which a repeated task finds
    again; the few right rows of hot keys are repeated to meet every salt.
    """
    if hot is None:
        hot = hot_keys(left, key)
    if not hot:
        return left.join(right, key, how)
    values = [k for k in hot if k is not None]

    def is_hot(c: Column) -> Column:
        return F.coalesce(c.isin(*values), F.lit(None in hot)) if values else c.isNull()

    spread = F.pmod(F.spark_partition_id(), F.lit(salts))
    salted = left.withColumn("_salt", F.when(is_hot(F.col(key)), spread).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.explode(F.when(is_hot(F.col(key)), every).otherwise(F.array(F.lit(0))))
    repeated = right.filter(F.col(key).isNotNull()).withColumn("_salt", copies)
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
