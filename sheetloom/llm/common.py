"""What the operators share: reading tables, folds, term streams, counts over all rows."""

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: str, n: int) -> Column:
    """The CRC-32 of a key as text, modulo ``n``: a fold that every engine can compute. NULL is fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n)), F.lit(0)).cast("int")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of jobs that are done.

    Its cleaner acts when the driver collects garbage, which a long run of small jobs does too late: their plans
    and files pile up. Only what nothing refers to goes, so no later job has to repeat anything.
    """
    gc.collect()
    spark._jvm.System.gc()


def texts_of(frames: Iterator[pd.DataFrame], column: str) -> Iterator[str]:
    for frame in frames:
        for text in frame[column]:
            yield text or ""


def count_buckets(df: DataFrame, column: str, buckets: Callable, size: int, streamed: bool = False) -> np.ndarray:
    """In how many texts each of ``size`` buckets occurs; ``buckets`` gives a text's distinct ones,
    or these and what to add to each instead of one. If ``streamed``, it gets all texts of a task and yields what it gives for each.

    Each task adds up a vector of fixed size over all its rows. The vectors go out in
    chunks and are added up chunk by chunk, so one task holds a few chunks, however many
    rows there are. Only the sums, ``size`` numbers, reach the driver.
    """
    def count(frames):
        seen = np.zeros(size, np.int64)
        texts = texts_of(frames, column)
        for found in buckets(texts) if streamed else map(buckets, texts):
            found, more = found if isinstance(found, tuple) else (found, 1)
            seen[found] += more
        for start in range(0, size, CHUNK):
            part = seen[start:start + CHUNK]
            if part.any():
                yield pd.DataFrame({"chunk": [start], "counts": [part.tobytes()]})

    def add(frames):
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for start, counts in zip(frame["chunk"], frame["counts"]):
                part = np.frombuffer(counts, np.int64)
                sums[start] = sums[start] + part if start in sums else part
        for start, part in sums.items():
            yield pd.DataFrame({"chunk": [start], "counts": [part.tobytes()]})

    schema = "chunk long, counts binary"
    chunks = min(-(-size // CHUNK), 64)
    parts = df.select(column).mapInPandas(count, schema).repartition(chunks, "chunk").mapInPandas(add, schema)
    total = np.zeros(size, np.int64)
    for row in parts.collect():
        part = np.frombuffer(row["counts"], np.int64)
        total[row["chunk"]:row["chunk"] + len(part)] = part
    return total


def bounded_sample(df: DataFrame, key: str, label: str, per_label: int, max_labels: int = 1000) -> DataFrame:
    """About ``per_label`` rows of every label, chosen by a hash of the key, hence the same rows each time.

    More than ``max_labels`` labels raise.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).count().limit(max_labels + 1).collect()
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not counts:
        return df.limit(0)
    scale = 1 << 30
    most = [x for row in counts for x in (F.lit(row[label]), F.lit(int(scale * min(1.0, per_label / row["count"]))))]
    share = F.element_at(F.create_map(*most), F.col(label))
    return df.filter(F.col(label).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(scale)) < share))
