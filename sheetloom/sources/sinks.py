"""Writing tables: create, overwrite, replace, append, and publish a new version."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage

# Rows that one task sorts and writes, so that its memory does not grow with the table.
ROWS_PER_TASK = 2_000_000


def _evened(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt evenly to as many tasks as asked for, or more if these would get too many rows."""
    return df.repartition(max(partitions, -(-df.count() // ROWS_PER_TASK)))


def _by_bucket(df: DataFrame, buckets: int, keys: list[str]) -> DataFrame:
    """Rows dealt by bucket; a large bucket goes to several tasks, which write a file each.

    Tasks and buckets are told by the same hash. With a multiple of the number of buckets as many tasks, none has rows of two buckets.
    """
    return df.repartition(buckets * max(1, -(-df.count() // (buckets * ROWS_PER_TASK))), *keys)


def _creator(df: DataFrame, table: str, fmt: str, properties: dict, partition_by: list[str], location: str | None):
    writer = df.writeTo(table).using(fmt)
    for name, value in properties.items():
        writer = writer.tableProperty(name, value)
    if location is not None:
        writer = writer.option("path", location)
    if partition_by:
        writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
    return writer


def _same_columns(df: DataFrame, table: str) -> list[str]:
    """The table's columns; a frame with others, without some of them or with another type would lose data and raises."""
    there = df.sparkSession.table(table)
    columns = there.columns
    unknown, missing = set(df.columns) - set(columns), set(columns) - set(df.columns)
    if unknown or missing or len(df.columns) != len(columns):
        raise ValueError(f"{table}: unknown columns {sorted(unknown)}, missing columns {sorted(missing)}")
    types = dict(there.dtypes)
    other = [f"{c} {t}, not {types[c]}" for c, t in df.dtypes if t != types[c]]
    if other:
        raise ValueError(f"{table}: {'; '.join(other)}")
    return columns


def create_or_overwrite(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    partitions: int | None = None,
    location: str | None = None,
) -> None:
    """Create the table, or replace all its rows and keep its schema.

    ``partitions`` evens out the files written, of which a large table gets more; ``partition_by`` splits the
    table into folders that later scans can skip. The new rows of a table that exists are all
    computed and written aside before its old ones go, so they may come from the table itself.
    """
    exists = df.sparkSession.catalog.tableExists(table)
    if exists:
        df = stage(df.select(*_same_columns(df, table)), "overwrite")
    if partitions is not None:
        df = _evened(df, partitions)
    if not exists:
        _creator(df, table, fmt, properties or {}, partition_by or [], location).create()
        return
    df.write.mode("overwrite").insertInto(table, overwrite=True)


def create_or_replace(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    properties: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    location: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Replace the table with its schema and properties.

    ``bucket_by`` stores rows by a key, so that merges and deletes by that key
    later read the table without shuffling it.

    Table formats with atomic replace do it in one commit through
    ``writeTo().createOrReplace()``. Of plain file formats a new table is written beside the old one, below
    ``location`` if there is one, and takes its name when it is complete: a failed write leaves the old table, and
    the rows may come from it.
    """
    if fmt not in ("parquet", "orc", "csv", "json"):
        _creator(df, table, fmt, properties or {}, partition_by or [], location).createOrReplace()
        return
    if bucket_by:
        df = _by_bucket(df, bucket_by[0], [bucket_by[1]])
    version = uuid.uuid4().hex
    fresh = f"{table}_{version}"
    writer = df.write.format(fmt).options(**(properties or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    if location is not None:
        writer = writer.option("path", f"{location.rstrip('/')}/version-{version}")
    writer.saveAsTable(fresh)
    _take_name(df.sparkSession, table, fresh)


def _take_name(spark: SparkSession, table: str, fresh: str) -> None:
    """Give the complete table ``fresh`` the name ``table``; for a moment there may be no table of that name."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        return
    spark.sql(f"ALTER TABLE {table} RENAME TO {fresh}_old")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {fresh}_old RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {fresh}_old")


def append(df: DataFrame, table: str) -> None:
    """Add rows. The frame has exactly the table's columns, in any order."""
    df.select(*_same_columns(df, table)).write.mode("append").insertInto(table)


def _layout(spark: SparkSession, table: str) -> tuple[list[str], tuple[int, list[str]] | None, str]:
    """Partition columns, buckets and location of a table."""
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    number = rows.get("Num Buckets")
    buckets = (int(number), [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")]) if number else None
    return partitions, buckets, rows["Location"]


def publish_version(df: DataFrame, table: str, folder: str, fmt: str = "parquet", partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None, change_schema: bool = False) -> None:
    """Make ``df`` the table's content.

    The rows, which may be computed from the table itself, are first written to
    a new folder below ``folder``, with the partitions and buckets of the table, or, if it is new, with those
    asked for. Then an unpartitioned table is pointed there in one step: readers see the old or the new
    version. A partitioned one, whose catalog entry lists its partitions, changes names with the new version,
    for which there is no table of that name for a moment. A failed write leaves the old version. A changed schema raises unless
    ``change_schema`` asks for it. Old folders stay for readers that still use them, until ``drop_old_versions``.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    buckets = (bucket_by[0], [bucket_by[1]]) if bucket_by else None
    changed = False
    if exists:
        partition_by, buckets, _ = _layout(spark, table)
        old = spark.table(table)
        changed = sorted(old.dtypes) != sorted(df.dtypes)
        if changed and not change_schema:
            raise ValueError(f"{table} has the columns {old.dtypes}, not {df.dtypes}")
        if not changed:
            df = df.select(*old.columns)
    version = uuid.uuid4().hex
    path, fresh = f"{folder.rstrip('/')}/version-{version}", f"{table}_{version}"
    writer = (_by_bucket(df, *buckets) if buckets else df).write.format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
    writer.saveAsTable(fresh)
    if exists and not partition_by and not changed:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.sql(f"DROP TABLE {fresh}")  # its files stay, as it does not own them
    else:
        _take_name(spark, table, fresh)
    spark.catalog.refreshTable(table)


def drop_old_versions(spark: SparkSession, table: str, folder: str) -> int:
    """Delete the versions below ``folder`` that the table no longer uses, and say how many there were."""
    current = _layout(spark, table)[2].rstrip("/").rsplit("/", 1)[-1]
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in store.listStatus(top) if f.getPath().getName().startswith("version-") and f.getPath().getName() != current]
    for path in old:
        store.delete(path, True)
    return len(old)
