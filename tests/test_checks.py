"""Reconciliation by digests, and manifests of files of any size."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import ledger, quality


def cells(spark, n=4000, **changed):
    df = spark.range(n).select((F.col("id") % 200).cast("string").alias("sku"), (F.col("id") / 200).cast("int").cast("string").alias("period"), F.col("id").alias("value"))
    return df.repartition(7)


def test_equal_grids_join_no_cells(spark):
    a, b = cells(spark), cells(spark).repartition(3)
    found = quality.reconcile_by_digest(a, b, ["sku", "period"], blocks=16)
    assert found.count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("filter (isnull(") == 2  # of either side only cells without a key are left to be joined


@pytest.mark.parametrize("blocks", [1, 16, 4096])
def test_digests_find_what_the_full_join_finds(spark, rows, blocks):
    a = cells(spark).union(spark.createDataFrame([(None, "1", 5), ("7", "999", None), ("8", "999", None)], "sku string, period string, value long"))
    b = cells(spark).withColumn("value", F.when(F.col("value") % 977 == 0, None).when(F.col("value") == 11, 12).otherwise(F.col("value")))
    b = b.filter("value is null or value <> 3000").union(spark.createDataFrame([("new", "1", 5), ("7", "999", None), ("8", "999", 0)], "sku string, period string, value long"))
    expected = rows(quality.reconcile_cells(a, b, ["sku", "period"]))
    assert len(expected) == 10 and rows(quality.reconcile_by_digest(a, b, ["sku", "period"], blocks=blocks)) == expected
    swapped = a.withColumn("value", F.when(F.col("value") == 1, 2).when(F.col("value") == 2, 1).otherwise(F.col("value")))
    assert quality.reconcile_by_digest(a.filter("sku is not null"), swapped.filter("sku is not null"), ["sku", "period"], blocks=blocks).count() == 2
    assert quality.reconcile_by_digest(a.limit(0), b.limit(0), ["sku", "period"], blocks=blocks).count() == 0


def test_manifest_of_files_of_any_size(spark, tmp_path):
    sizes = {"empty": 0, "small": 10, "next door é": 1000, "chunks": (8 << 20) * 2 + 5}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(os.urandom(size))
    with open(tmp_path / "huge", "wb") as huge:  # 3 GB of zeros, which take no room on the disk
        huge.truncate(3 << 30)
    files = ledger.list_files(spark, str(tmp_path))
    got = {r["file_name"]: r for r in ledger.stream_manifest(files, "landing").collect()}
    zeros, running = bytes(8 << 20), hashlib.sha256()
    for _ in range((3 << 30) // len(zeros)):
        running.update(zeros)
    assert got.pop("huge")["checksum_sha256"] == running.hexdigest()
    assert {n: r["checksum_sha256"] for n, r in got.items()} == {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in sizes}
    assert ledger.stream_manifest(files.limit(0), "landing").count() == 0


def test_files_are_dealt_by_size(spark):
    files = spark.createDataFrame([(f"big{i}", 5000 + i) for i in range(4)] + [(f"f{i}", 10) for i in range(1000)], "path string, length long")
    tasks = {}
    for r in ledger.deal_by_size(files, 1000).select("path", "length", F.spark_partition_id().alias("task")).collect():
        tasks.setdefault(r["task"], []).append(r["length"])
    big = [t for t in tasks.values() if max(t) >= 5000]
    small = [sum(t) for t in tasks.values() if max(t) < 5000]
    assert len(big) == 4 and all(len(t) == 1 for t in big)
    assert len(small) == 10 and sum(small) == 10_000 and max(small) < 1600
