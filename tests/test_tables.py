import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetloom import staging
from sheetloom.operators import skew
from sheetloom.operators.ledger import files_to_ingest, last_ingested, ledger_append, ledger_history, ledger_view
from sheetloom.operators.numbering import number_rows, number_with_copies, row_index, with_copy_number
from sheetloom.operators.quality import reconcile_cells, reconcile_counts
from sheetloom.operators.upsert import (
    dedup_by_key, insert_new, largest_first, replace_by_key, rows_with_keys_in, rows_with_keys_not_in, upsert_changed,
)
from sheetloom.plans.facts import build_fact_forecast, build_fact_planning
from sheetloom.plans.refresh import publish_long_tables, refresh_all
from sheetloom.sources import sinks
from sheetloom.sources.specs import SheetSpec
from sheetloom.sources.tables import plan_columns, scan_existing


@pytest.fixture
def skewed(spark):
    """Three thousand rows, a third of them the same row, another third under one key."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, "same").when(n % 3 == 1, "hot").when(n % 30 != 2, n.cast("string")).alias("k"),
        F.when(n % 3 != 0, n).otherwise(0).alias("v"),
    )


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_numbers_equal_a_global_row_number(spark, skewed, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        plain = skewed.withColumn("nr", F.row_number().over(Window.orderBy("k", "v")).cast("bigint") + 100)
        numbered = number_with_copies(skewed, ["k"], "nr", F.lit(100))
        assert numbered.select("k", "v", "nr").exceptAll(plain).isEmpty() and numbered.count() == 3000
        few = skewed.distinct()
        plain = few.withColumn("nr", F.row_number().over(Window.orderBy("k", "v")).cast("bigint"))
        assert number_rows(few, ["k", "v"], "nr").select("k", "v", "nr").exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_in_pieces(skewed):
    """A thousand copies, taken apart in pieces of seven."""
    copies = with_copy_number(skewed, piece=7)
    assert copies.count() == 3000 and copies.distinct().count() == 3000
    assert copies.drop("_copy").exceptAll(skewed).isEmpty()
    same = copies.filter("k = 'same'").agg(F.min("_copy"), F.max("_copy"), F.countDistinct("_copy")).first()
    assert tuple(same) == (1, 1000, 1000)


def test_empty_tables_are_numbered(spark, skewed):
    none = skewed.filter("v < 0")
    assert number_rows(none, ["k", "v"], "nr").count() == 0
    assert number_with_copies(none, ["k"], "nr").count() == 0


def test_row_index_closes_gaps(spark, rows):
    df = spark.createDataFrame([(9, "c"), (2, "a"), (5, "b")], "row_idx bigint, t string")
    assert rows(row_index(df, "row_idx").select("row_index", "t")) == [(0, "a"), (1, "b"), (2, "c")]


def test_hot_keys(skewed):
    assert set(skew.hot_keys(skewed, "k")) == {"same", "hot", None}
    assert skew.hot_keys(skewed.distinct().filter("k not in ('same', 'hot')"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, [], ["hot"], ["same", "hot", None], [None]])
def test_spread_joins_equal_plain_ones(spark, skewed, how, hot):
    right = skewed.filter("k is null or k = 'hot' or v % 2 = 0").select("k").distinct().withColumn("w", F.length("k"))
    plain = skewed.join(right, "k", how)
    spread = skew.join_spread(skewed.repartition(5), right, "k", how, salts=4, hot=hot)
    assert spread.columns == plain.columns
    assert spread.count() == plain.count() and spread.exceptAll(plain).isEmpty()


def test_a_side_too_large_is_not_broadcast(spark, skewed, monkeypatch):
    right = skewed.filter("k is not null").groupBy("k").agg(F.max("v").alias("top"))
    plain = skewed.join(right, "k", "left")

    def is_hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().logical().toString()

    small = skew.join_unique(skewed, right, "k")
    assert is_hinted(small) and small.exceptAll(plain).isEmpty()
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    large = skew.join_unique(skewed, right, "k")
    assert not is_hinted(large) and large.exceptAll(plain).isEmpty() and large.count() == 3000
    monkeypatch.undo()
    assert not skew.fits_broadcast(right, rows=10) and not skew.fits_broadcast(right, size=100) and skew.fits_broadcast(right)


def test_dedup_is_total(spark, rows):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y"), ("a", 2.0, "x"), ("b", None, "z")], "k string, v double, t string")
    for part in (1, 4):
        assert rows(dedup_by_key(df.repartition(part), "k", largest_first(df, "v"))) == [("a", 2.0, "x"), ("b", None, "z")]


TARGET = [(1, "a", 1.0, "i"), (2, "b", None, "i"), (3, "c", 3.0, "i"), (4, "d", 4.0, "i")]
INCOMING = [("a", 9.0, "j"), ("b", 2.0, "j"), ("c", None, "j"), ("d", 4.0, "j"), ("f", 6.0, "j"), ("e", None, "j")]


def test_upsert(spark, rows):
    target = spark.createDataFrame(TARGET, "id bigint, k string, v double, item string")
    incoming = spark.createDataFrame(INCOMING, "k string, v double, item string")
    state = upsert_changed(target, incoming, "k", "v", ["item"])
    expected = [(1, "a", 9.0, "j"), (2, "b", 2.0, "j"), (3, "c", 3.0, "i"), (4, "d", 4.0, "i")]
    assert rows(state) == expected
    assert rows(upsert_changed(state, incoming, "k", "v", ["item"])) == expected
    assert rows(insert_new(target, incoming, "k", "id")) == [(5, "e", None, "j"), (6, "f", 6.0, "j")]
    whole = state.union(insert_new(target, incoming, "k", "id"))
    assert insert_new(whole, incoming, "k", "id").count() == 0


def test_replace_by_key(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "b", 2.0), (9, "c", 3.0)], "id bigint, k string, v double")
    incoming = spark.createDataFrame([("b", 5.0), ("b", 5.0), ("c", 1.0), ("x", None)], "k string, v double")
    state = replace_by_key(target, incoming, "k", "id", ["k", "v"])
    assert rows(state) == [(1, "a", 1.0), (10, "b", 5.0), (11, "b", 5.0), (12, "c", 1.0), (13, "x", None)]
    again = replace_by_key(state, incoming, "k", "id", ["k", "v"])
    assert rows(again, "k", "v") == rows(state, "k", "v")
    assert again.agg(F.min(F.when(F.col("k") != "a", F.col("id")))).first()[0] == 14
    assert rows(rows_with_keys_in(target, incoming, "k"), "id") == [(2,), (3,), (9,)]
    assert rows(rows_with_keys_not_in(target, incoming, "k"), "id") == [(1,)]


def plan_frame(spark, values):
    return spark.createDataFrame(values, "Period string, Date date, Item string, Planning_Value double")


def test_fact_builds_settle(spark, rows):
    first = {"Vert_SAN_Plan_FY2026": plan_frame(spark, [("P", None, "1", 1.0), ("P", None, "2", None), ("P", None, "2", 7.0)])}
    second = {"db.Vert_SAN_Plan_FY2026": plan_frame(spark, [("P", None, "1", None), ("P", None, "2", 8.0), ("P", None, "0", 5.0)])}
    fact = staging.stage(build_fact_planning(first), "t")
    assert rows(fact, "PrimaryKey", "PDIL", "Planning_Value", "City") == [(1, "P-1-SAN", 1.0, None), (2, "P-2-SAN", 7.0, None)]
    after = staging.stage(build_fact_planning(second, fact), "t")
    expected = [(1, "P-1-SAN", 1.0), (2, "P-2-SAN", 8.0), (3, "P-0-SAN", 5.0)]
    assert rows(after, "PrimaryKey", "PDIL", "Planning_Value") == expected
    assert rows(build_fact_planning(second, after), "PrimaryKey", "PDIL", "Planning_Value") == expected
    with pytest.raises(ValueError):
        plan_columns(fact.drop("Planning_Value"), "x")


def test_forecast_facts_keep_copies(spark, rows):
    df = spark.createDataFrame([("P", None, "s", None, 1.0)] * 3 + [("P", None, "r", None, 1.0)], "Period string, Date date, SKU string, Item string, Forecast_Value double")
    fact = build_fact_forecast({"Forecast_STER_FY2026": df})
    assert rows(fact, "IndexKey", "PDIL", "SKU") == [(i + 1, "P-NA-STER", "r" if i == 0 else "s") for i in range(4)]


def test_files_to_ingest(spark):
    listing = spark.createDataFrame([("same", "2026-01-01T00:00:00Z"), ("later", "2026-01-01T00:00:01Z"), ("new", "2026-01-01"), ("odd", "?")], "resource string, modified string")
    ledger = spark.createDataFrame([(r, t, "p") for r in ("same", "later", "odd") for t in ("2025-01-01T00:00:00", "2026-01-01T00:00:00")], "resource string, ingestion_date string, file_path string")
    due = {r["resource"]: r["is_due"] for r in files_to_ingest(listing, last_ingested(ledger)).collect()}
    assert due == {"same": False, "later": True, "new": True, "odd": True}
    view = ledger_view(ledger_append(ledger, spark.createDataFrame([("same", "2027-01-01T00:00:00", "q")], ledger.schema)))
    assert [r["file_path"] for r in view.filter("resource = 'same' and is_current").collect()] == ["q"]
    assert view.filter("resource = 'same'").count() == 3 and view.filter("is_current").count() == 3


def test_reconcile(spark, rows):
    schema = "k string, value bigint"
    left = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", None)], schema)
    right = spark.createDataFrame([("a", 1), ("b", None), ("c", 4), ("e", None)], schema)
    assert rows(reconcile_cells(left, right, ["k"])) == [("c", 3, 4), ("d", None, None), ("e", None, None)]
    assert tuple(reconcile_counts(left.union(right), "k").first()) == (8, 5, False, "rows changed from 8 to 5")
    assert tuple(reconcile_counts(left, "k").first()) == (4, 4, True, "all rows kept")


def test_sinks(spark, rows, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "x int, site string")
    two = spark.createDataFrame([(3, "c")], "x int, site string")
    sinks.create_or_overwrite(one, "t_over", location=str(tmp_path / "over"), properties={"layout": "2"}, partition_by=["site"])
    assert ("layout", "2") in [tuple(r) for r in spark.sql("SHOW TBLPROPERTIES t_over").collect()]
    sinks.create_or_overwrite(two, "t_over", partitions=3)
    assert rows(spark.table("t_over")) == [(3, "c")]
    sinks.append(one, "t_over")
    assert rows(spark.table("t_over")) == [(1, "a"), (2, "b"), (3, "c")]
    sinks.create_or_replace(two.select("site"), "t_over", location=str(tmp_path / "new"))
    assert spark.table("t_over").columns == ["site"]
    with pytest.warns(UserWarning, match="t_none"):
        assert list(scan_existing(spark, ["t_over", "t_none"])) == ["t_over"]


def test_sinks_keep_the_old_table_until_the_new_one_is_complete(spark, rows, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "x int, site string")
    broken = one.withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("x")).cast("int"))
    for location in (None, str(tmp_path / "safe")):
        name = "t_safe_located" if location else "t_safe"
        sinks.create_or_replace(one, name, location=location)
        for write in (sinks.create_or_replace, sinks.create_or_overwrite):
            with pytest.raises(Exception, match="broken"):
                write(broken, name)
            assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
            write(spark.table(name).withColumn("x", F.col("x") + F.lit(1)), name)  # rows of the table itself
            assert rows(spark.table(name), "x") == [(2,), (3,)]
            write(one, name)
        for write in (sinks.append, sinks.create_or_overwrite):
            with pytest.raises(ValueError, match="x string, not int"):
                write(one.withColumn("x", F.lit("7")), name)
        spark.sql(f"DROP TABLE {name}")


def test_merging_into_a_bucketed_table_does_not_shuffle_it(spark, rows, tmp_path):
    target = spark.createDataFrame(TARGET, "id bigint, k string, v double, item string")
    sinks.create_or_replace(target, "t_buckets", location=str(tmp_path / "buckets"), bucket_by=(8, "k"))
    incoming = spark.createDataFrame(INCOMING, "k string, v double, item string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = upsert_changed(spark.table("t_buckets"), incoming, "k", "v", ["item"])
        assert state._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert rows(state) == rows(upsert_changed(target, incoming, "k", "v", ["item"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_copies_are_counted_once(spark, skewed):
    """Both branches of the copy numbering read one shuffle."""
    copies = with_copy_number(skewed, piece=7)
    copies.collect()
    plan = copies._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("partial_count") == 1 and "ReusedExchange" in plan


def test_publish_a_version_computed_from_the_last(spark, rows, tmp_path):
    first = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.publish_version(first, "t_pub", str(tmp_path))
    sinks.publish_version(spark.table("t_pub").union(first.filter("x = 2")), "t_pub", str(tmp_path))
    assert rows(spark.table("t_pub")) == [(1,), (2,), (2,)]
    assert sinks.drop_old_versions(spark, "t_pub", str(tmp_path)) == 1
    assert rows(spark.table("t_pub")) == [(1,), (2,), (2,)]


@pytest.mark.parametrize("how", [{}, {"partition_by": ["site"]}, {"bucket_by": (4, "x")}])
def test_publish_keeps_the_layout(spark, rows, tmp_path, how):
    name = f"t_layout_{'_'.join(how) or 'plain'}"
    for values in ([(1, "a"), (2, "b")], [(9, "a")], [(7, "c"), (9, "b")]):
        sinks.publish_version(spark.createDataFrame(values, "x int, site string"), name, str(tmp_path), **how)
        assert rows(spark.table(name).select("x", "site")) == values
    partitions, buckets, _ = sinks._layout(spark, name)
    assert (partitions, buckets) == (how.get("partition_by", []), (4, ["x"]) if "bucket_by" in how else None)
    assert rows(spark.table(name).join(spark.createDataFrame([(9,)], "x int"), "x"), "site") == [("b",)]
    changed = spark.createDataFrame([(1, "a", 2)], "x int, site string, y int")
    with pytest.raises(ValueError):
        sinks.publish_version(changed, name, str(tmp_path))
    sinks.publish_version(changed, name, str(tmp_path), change_schema=True)
    assert rows(spark.table(name).select("x", "site", "y")) == [(1, "a", 2)]


def test_merging_after_publishing_shuffles_one_side(spark, rows, tmp_path):
    target = spark.createDataFrame(TARGET, "id bigint, k string, v double, item string")
    incoming = spark.createDataFrame(INCOMING, "k string, v double, item string")
    for _ in range(2):
        sinks.publish_version(target, "t_again", str(tmp_path), bucket_by=(8, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = upsert_changed(spark.table("t_again"), incoming, "k", "v", ["item"])
        assert state._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sinks_refuse_to_lose_columns(spark, tmp_path):
    one = spark.createDataFrame([(1, "a")], "x int, site string")
    sinks.create_or_overwrite(one, "t_strict", location=str(tmp_path / "strict"))
    assert list((tmp_path / "strict").glob("part-*"))
    for wrong in (one.withColumn("extra", F.lit(1)), one.select("x")):
        for write in (sinks.append, sinks.create_or_overwrite):
            with pytest.raises(ValueError):
                write(wrong, "t_strict")
    sinks.append(one.select("site", "x"), "t_strict")
    assert spark.table("t_strict").count() == 2


def test_latest_is_by_time(spark, rows):
    times = ["2026-03-01T00:00:00", "20260101T000000", "garbage", "2026-03-01T09:00:00.1234567+09:30"]
    ledger = spark.createDataFrame([("a", t, "p") for t in times] + [("b", "2026-01-01T00:00:00Z", p) for p in ("p", "q", "q")] + [("c", "garbage", "p")], "resource string, ingestion_date string, file_path string")
    assert rows(last_ingested(ledger)) == [("a", times[0]), ("b", "2026-01-01T00:00:00Z"), ("c", "garbage")]
    assert rows(ledger_view(ledger).filter("is_current"), "resource", "file_path") == [("a", "p"), ("b", "q"), ("c", "p")]
    history = {r["resource"]: [h["ingestion_date"] for h in r["history"]] for r in ledger_history(ledger).collect()}
    assert history["a"] == [times[0], times[3], times[1], times[2]]


def test_no_sources_stop_quietly(spark):
    fact = spark.range(1)
    with pytest.warns(UserWarning, match="no planning sources"):
        assert build_fact_planning({}, fact) is fact
    with pytest.warns(UserWarning, match="no forecast sources"):
        assert build_fact_forecast({}, None) is None


def test_refresh_by_workbook(spark, sheet, rows):
    plan = sheet([["Period", "F26-01"], ["Date", "1/5/26"], ["7", "1"]])
    spec = SheetSpec("plan", "Vert_SAN_Plan_FY2026", "p", "A1:B", "DoW", "San Antonio", "Texas", workbook="Master Plan")
    listing = spark.createDataFrame([("Master Plan", "2026-01-02")], "resource string, modified string")
    ledger = spark.createDataFrame([], "resource string, ingestion_date string")
    last_year = spark.createDataFrame([("F25-01", None, "8", 2.0)], "Period string, Date date, Item string, Planning_Value double")
    once = refresh_all([spec], lambda s: plan, None, listing, ledger, long_tables={"Vert_SAN_Plan_FY2025": last_year}, now="2026-01-03")
    assert once["taken"] == [spec.table] and rows(once["plan_fact"], "PDIL") == [("F25-01-8-SAN",), ("F26-01-2026-01-05-7-SAN",)]
    assert rows(once["ledger"]) == [("Master Plan", "2026-01-03")]
    again = refresh_all([spec], lambda s: plan, None, listing, once["ledger"], long_tables=once["long_tables"], plan_fact=once["plan_fact"])
    assert again["taken"] == [] and again["plan_fact"] is once["plan_fact"]
    with pytest.warns(UserWarning, match="no workbook"):
        refresh_all([spec], lambda s: plan, None, listing.limit(0), ledger)
    publish_long_tables({"t_long_plan": once["long_tables"][spec.table]}, [spec])
    assert spark.table("t_long_plan").count() == 1
    spark.sql("DROP TABLE t_long_plan")


def test_refresh_takes_only_what_is_due(spark, sheet, rows):
    plan = sheet([["Period", "F26-01"], ["Date", "1/5/26"], ["7", "1"]])
    forecast = sheet([[None, "9"], ["SKU", "1"], ["F26-01", "2"]])
    specs = [
        SheetSpec("plan", "Vert_SAN_Plan_FY2026", "p", "A1:B", "DoW", "San Antonio", "Texas"),
        SheetSpec("forecast", "Forecast_SAN_FY2026", "f", "A1:B", None, "San Antonio", "Texas", "A1:B"),
    ]
    sheets = {"p": plan, "f": forecast}
    calendar = sheet([["1/5/26", "F26-01"]])
    listing = spark.createDataFrame([(s.table, "2026-01-02") for s in specs], "resource string, modified string")
    ledger = spark.createDataFrame([("Vert_SAN_Plan_FY2026", "2026-01-01"), ("Forecast_SAN_FY2026", "2026-01-03")], "resource string, ingestion_date string")

    def run(taken, **state):
        return refresh_all(specs, lambda s: sheets[s.sheet], calendar, listing, taken, **state)

    once = run(ledger)
    assert once["forecast_fact"] is None and list(once["long_tables"]) == ["Vert_SAN_Plan_FY2026"]
    assert rows(once["plan_fact"], "PrimaryKey", "PDIL") == [(1, "F26-01-2026-01-05-7-SAN")]
    both = run(ledger.filter("ingestion_date < '2026-01-02'"), long_tables=once["long_tables"], plan_fact=once["plan_fact"])
    assert rows(both["plan_fact"], "PrimaryKey") == [(1,)]
    assert rows(both["forecast_fact"], "IndexKey", "PDIL", "Forecast_Value") == [(1, "F26-01-2026-01-05-9-SAN", 2.0)]
    done = ledger.withColumn("ingestion_date", F.lit("2026-01-09"))
    assert run(done, plan_fact=both["plan_fact"])["plan_fact"] is both["plan_fact"]


def test_staging_needs_a_shared_folder(spark):
    assert staging.stage(spark.range(3), "t").count() == 3
    assert staging.path_exists(spark, staging.shared_folder(spark))
    assert not staging.path_exists(spark, staging.new_path(spark, "none"))
