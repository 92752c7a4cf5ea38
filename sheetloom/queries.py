"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

import warnings
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from . import functions as fn
from .operators import columns, ledger, quality, reshape
from .operators.calendar import attach_calendar, monday_calendar
from .operators.forecast_melt import (
    find_layout, forecast_cells, header_pairs, melt_forecast, preview_rows, rows_from,
)
from .operators.labels import column_map, data_rows, find_label_row, rows_at, strip
from .operators.merge import CLASS, classify
from .operators.numbering import max_key, number_rows, row_index
from .operators.plan_melt import attach_site, labelled_cells, melt_plan, melt_plan_filled, melt_plan_lower
from .operators.upsert import (
    dedup_by_key, duplicate_keys, insert_new, largest_first, match_by_key, replace_by_key,
    rows_with_keys_in, rows_with_new_keys, upsert_changed,
)
from .plans.committed import FORECAST, LEDGER, PLANNING, refresh_store, take_forecasts, take_plans
from .plans.facts import (
    FORECAST_FACT, FORECAST_ORDER, KEY, PLAN_FACT, build_fact_forecast, build_fact_planning,
    keyed_forecasts, keyed_plans, unique_plans,
)
from .plans.refresh import long_tables_of, refresh_all
from .plans.sheets import forecast_sheet_to_long, plan_sheet_to_long, sheet_to_table
from .sources import sinks
from .sources.sheets import (
    ROW, drop_empty_rows, scan_calendar, scan_inferred, scan_lookup, scan_range,
)
from .sources.specs import LOOKUP_SPEC, SheetSpec
from .sources.tables import plan_columns, register_view, scan_existing, scan_table, union_sources
from .sources.versions import VersionStore
from .staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- inputs that several queries share


def plan_grid(spark, sf_dir, drop_empty=False):
    return scan_range(fx.main_plan_sheet(spark, sf_dir), fx.main_plan_spec(spark, sf_dir).cells, drop_empty=drop_empty)


def forecast_grid(spark, sf_dir):
    return scan_range(fx.main_forecast_sheet(spark, sf_dir), fx.main_forecast_spec(spark, sf_dir).cells)


def week_label(spark, sf_dir):
    return fx.main_plan_spec(spark, sf_dir).week_label


def mondays(spark, sf_dir):
    return monday_calendar(scan_calendar(fx.calendar_sheet(spark, sf_dir), fx.calendar_range()))


def month_grid(spark, sf_dir):
    return drop_empty_rows(fx.month_sheet(spark, sf_dir))


def named_months(spark, sf_dir):
    return columns.two_row_header(month_grid(spark, sf_dir))


def earlier_plan_fact(spark, sf_dir):
    return fx.landed(spark, sf_dir, "plan_fact", lambda: build_fact_planning(fx.earlier_plans(spark, sf_dir)))


def earlier_forecast_fact(spark, sf_dir):
    return fx.landed(spark, sf_dir, "forecast_fact", lambda: build_fact_forecast(fx.earlier_forecasts(spark, sf_dir)))


# --- scans, sources, sinks


@query
def scan_range_query(spark, sf_dir):
    return plan_grid(spark, sf_dir, drop_empty=True)


@query
def scan_lookup_query(spark, sf_dir):
    return scan_lookup(fx.lookup_sheet(spark, sf_dir), "B2:F")


@query
def lookup_table(spark, sf_dir):
    return sheet_to_table(fx.lookup_sheet(spark, sf_dir), LOOKUP_SPEC.resized(5))


@query
def scan_calendar_query(spark, sf_dir):
    return scan_calendar(fx.calendar_sheet(spark, sf_dir), fx.calendar_range())


@query
def scan_table_query(spark, sf_dir):
    register_view(fx.lines(spark, sf_dir), "moved_lines")
    return scan_table(spark, "moved_lines")


@query
def scan_inferred_query(spark, sf_dir):
    return scan_inferred(fx.typed_sheet(spark, sf_dir), "A1:F").toDF(
        ROW, "part", "size", "price", "is_even", "day", "name"
    )


@query
def source_specs(spark, sf_dir):
    """Each source's long table, written, and what it holds."""
    calendar = fx.calendar_sheet(spark, sf_dir)
    specs = [replace(s, calendar=fx.calendar_range()) for s in fx.refresh_specs(spark, sf_dir)]
    tables = long_tables_of(specs, lambda spec: fx.refresh_sheet(spark, sf_dir, spec), calendar)
    parts = []
    for spec in specs:
        long = tables[spec.table]
        value = "Planning_Value" if spec.kind == "plan" else "Forecast_Value"
        total = long.agg(F.count("*").alias("n_rows"), F.count("Date").alias("n_dated"), F.sum(value).cast("bigint").alias("total"))
        parts.append(total.select(F.lit(spec.table).alias("source_table"), F.lit(spec.city).alias("city"), "n_rows", "n_dated", "total"))
    return reduce(DataFrame.union, parts)


@query
def skip_missing_sources(spark, sf_dir):
    sources = fx.all_plans(spark, sf_dir)
    for name, df in sources.items():
        register_view(df, name)
    found = scan_existing(spark, [*sources, "Vert_DAL_Plan_FY2024"])
    return union_sources([plan_columns(df, name) for name, df in found.items()])


def _new_table(spark):
    name = f"sheetloom_{uuid4().hex}"
    return name, new_path(spark, name)


@query
def sink_create_or_overwrite(spark, sf_dir):
    name, path = _new_table(spark)
    rows = keyed_plans(fx.all_plans(spark, sf_dir))
    sinks.create_or_overwrite(keyed_plans(fx.earlier_plans(spark, sf_dir)), name, location=path, properties={"layout": "plan"}, partition_by=["Location"])
    sinks.create_or_overwrite(rows, name, partitions=4)
    return spark.table(name)


@query
def sink_create_or_replace(spark, sf_dir):
    name, path = _new_table(spark)
    sinks.create_or_replace(keyed_plans(fx.all_plans(spark, sf_dir)), name, location=path)
    sinks.create_or_replace(keyed_forecasts(fx.all_forecasts(spark, sf_dir)), name, location=path)
    return spark.table(name)


@query
def sink_publish_version(spark, sf_dir):
    """Two versions of a plain, a partitioned and a bucketed table; what readers see after the second."""
    first, second = keyed_plans(fx.earlier_plans(spark, sf_dir)), keyed_plans(fx.all_plans(spark, sf_dir))
    seen = []
    for layout, how in (("plain", {}), ("partitioned", {"partition_by": ["Location"]}), ("bucketed", {"bucket_by": (8, KEY)})):
        name, path = _new_table(spark)
        sinks.publish_version(first, name, path, **how)
        sinks.publish_version(second, name, path)
        sinks.drop_old_versions(spark, name, path)
        seen.append(spark.table(name).select(F.lit(layout).alias("layout"), *second.columns))
    return reduce(DataFrame.union, seen)


@query
def sink_append(spark, sf_dir):
    name, path = _new_table(spark)
    sinks.create_or_overwrite(keyed_plans(fx.earlier_plans(spark, sf_dir)), name, location=path)
    sinks.append(keyed_plans(fx.later_plans(spark, sf_dir)), name)
    return spark.table(name)


@query
def temp_view(spark, sf_dir):
    register_view(keyed_plans(fx.all_plans(spark, sf_dir)), "keyed_plans")
    return spark.sql("SELECT Location, count(*) AS n_rows, count(DISTINCT PDIL) AS n_keys FROM keyed_plans GROUP BY Location")


# --- grids


@query
def find_label_row_query(spark, sf_dir):
    grid = plan_grid(spark, sf_dir)
    found = find_label_row(grid, ["period"]).union(find_label_row(grid, ["no such label", week_label(spark, sf_dir)]))
    return found.select(ROW, F.col("_c0").alias("label"), F.col("_c1").alias("first_cell"))


@query
def column_map_query(spark, sf_dir):
    return column_map(plan_grid(spark, sf_dir), week_label(spark, sf_dir))


@query
def data_rows_query(spark, sf_dir):
    return data_rows(plan_grid(spark, sf_dir), week_label(spark, sf_dir))


@query
def melt_plan_query(spark, sf_dir):
    return melt_plan(plan_grid(spark, sf_dir), "San Antonio", "Texas", week_label(spark, sf_dir))


@query
def attach_site_query(spark, sf_dir):
    return attach_site(fx.table(spark, sf_dir, "part").select("p_partkey", "p_name"), "Sterling", "Virginia")


@query
def find_sku_header(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    layout = find_layout(grid)
    items = rows_at(grid, layout.item).select(F.lit("item").alias("header"), ROW, "_c1", "_c5")
    return rows_at(grid, layout.sku).select(F.lit("sku").alias("header"), ROW, "_c1", "_c5").union(items)


@query
def find_data_start(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    return rows_at(grid, find_layout(grid).start).select(ROW, "_c0", "_c1", "_c2")


@query
def header_pairs_query(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    return header_pairs(grid, find_layout(grid))


@query
def rows_from_query(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    return rows_from(grid, find_layout(grid).start)


@query
def melt_forecast_query(spark, sf_dir):
    return melt_forecast(forecast_grid(spark, sf_dir), "Sterling", mondays(spark, sf_dir))


@query
def melt_stack(spark, sf_dir):
    return melt_plan_filled(plan_grid(spark, sf_dir), "San Antonio", "Texas")


@query
def melt_crossjoin(spark, sf_dir):
    return melt_plan_filled(plan_grid(spark, sf_dir), "San Antonio", "Texas", name_blanks=False)


@query
def melt_plan_v4(spark, sf_dir):
    return melt_plan_lower(plan_grid(spark, sf_dir), "San Antonio", "Texas")


@query
def label_cross_join(spark, sf_dir):
    return labelled_cells(plan_grid(spark, sf_dir), week_label(spark, sf_dir), drop_zero=False)


@query
def transpose_wide(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    named = rows_from(grid, find_layout(grid).sku).withColumn("_c0", strip(F.col("_c0")))
    return reshape.transpose_wide(named, corner="Sku")


@query
def transpose_tiles(spark, sf_dir):
    """The flipped forecast grid, cell by cell out of its tiles."""
    tiles = reshape.transpose_tiles(_named_periods(spark, sf_dir), corner="Sku", was="Column")
    cells = tiles.filter(F.col("Sku").isNotNull()).select("Sku", "Column", F.explode(F.arrays_zip("names", "cells")).alias("x"))
    return cells.select("Sku", "Column", F.col("x.names").alias("Period"), F.col("x.cells").alias("cell")).filter(F.col("Period").startswith("F"))


@query
def pivot_first(spark, sf_dir):
    """Per order and line number the value of its first part."""
    rows = fx.lines(spark, sf_dir)
    order = F.struct("l_partkey", "l_suppkey", "ship_date").alias("o")
    long = rows.select("l_orderkey", "l_linenumber", order, "l_quantity")
    wide = reshape.pivot_first(long, ["l_orderkey"], "l_linenumber", "l_quantity", "o", list(range(1, 8)))
    return wide.toDF("l_orderkey", *[f"line_{i}" for i in range(1, 8)])


@query
def two_row_header(spark, sf_dir):
    return named_months(spark, sf_dir)


@query
def two_row_header_plain(spark, sf_dir):
    grid = month_grid(spark, sf_dir)
    named = columns.two_row_header_plain(grid.select(ROW, *[f"_c{i}" for i in range(2, 17)]))
    return named.withColumnRenamed("", "unnamed")


@query
def clean_columns(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return columns.clean_columns(parts.toDF(" part key ", "name.of-part", "brand/no", "kind"))


@query
def unique_columns(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return columns.unique_columns(parts, ["a", "a", "a_1", "b", "b"])


@query
def positional_columns(spark, sf_dir):
    return columns.positional_columns(fx.table(spark, sf_dir, "part"))


@query
def swap_columns(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return columns.swap_columns(parts, "p_partkey", "p_size").toDF("first", "second", "third")


@query
def drop_if_present(spark, sf_dir):
    return columns.drop_if_present(fx.table(spark, sf_dir, "part"), ["p_retailprice", "no such column"])


@query
def normalize_placeholders(spark, sf_dir):
    return reshape.normalize_placeholders(named_months(spark, sf_dir))


@query
def placeholders_to_null(spark, sf_dir):
    return reshape.placeholders_to_null(named_months(spark, sf_dir))


@query
def cast_period_columns(spark, sf_dir):
    return reshape.cast_period_columns(named_months(spark, sf_dir))


@query
def drop_empty_rows_query(spark, sf_dir):
    return month_grid(spark, sf_dir)


@query
def row_index_query(spark, sf_dir):
    return row_index(plan_grid(spark, sf_dir, drop_empty=True).select(ROW, "_c0"), ROW, "row_index")


@query
def preview_rows_query(spark, sf_dir):
    return preview_rows(plan_grid(spark, sf_dir, drop_empty=True).select(ROW, "_c0", "_c1"), 25)


# --- cleaning rules over dirty text


def _cleaned(name: str, source: str, rule: Callable) -> None:
    def run(spark, sf_dir):
        text = F.col(source)
        return fx.texts(spark, sf_dir).select(text.alias("input"), rule(text).alias("output"))

    QUERIES[name] = run


_cleaned("parse_mixed_date", "date_text", fn.mixed_date)
_cleaned("excel_serial_date", "date_text", fn.serial_date)
_cleaned("calendar_date", "date_text", fn.calendar_date)
_cleaned("clean_item", "code_text", fn.clean_item)
_cleaned("clean_code", "code_text", fn.clean_code)
_cleaned("trim_code", "code_text", fn.trim_code)
_cleaned("clean_quantity_signed", "quantity_text", fn.signed_quantity)
_cleaned("clean_quantity_unsigned", "quantity_text", fn.unsigned_quantity)
_cleaned("clean_quantity_zero", "quantity_text", lambda c: fn.quantity_or_zero(c, strip_commas=True))
_cleaned("round_int_even", "quantity_text", fn.rounded_half_even)


@query
def two_digit_year(spark, sf_dir):
    day = F.when(F.col("l_linenumber") <= 3, F.add_months("ship_date", -24000)).otherwise(F.col("ship_date"))
    year_and_day = F.date_format(day, "MM-dd")
    return fx.lines(spark, sf_dir).select(
        F.year(day).alias("year_in"), year_and_day.alias("day_in"), fn.widen_year(day).alias("output")
    )


@query
def fill_item_prefix(spark, sf_dir):
    item, sku = F.col("code_text"), F.col("l_suppkey").cast("string")
    return fx.texts(spark, sf_dir).select(
        item.alias("input"), sku.alias("sku"),
        fn.fill_item_prefix(item, sku, "San Antonio").alias("san_antonio"),
        fn.fill_item_prefix(item, sku, "STER").alias("sterling"),
        fn.fill_item_prefix(item, sku, "Alexandria").alias("alexandria"),
    )


@query
def drop_zero_items(spark, sf_dir):
    item = fn.clean_item(F.col("code_text"))
    return fx.texts(spark, sf_dir).select("l_orderkey", item.alias("item")).filter(fn.is_kept_item(F.col("item")))


@query
def drop_junk_periods(spark, sf_dir):
    return fx.texts(spark, sf_dir).select("l_orderkey", "period_text").filter(fn.is_kept_period(F.col("period_text")))


@query
def natural_key(spark, sf_dir):
    plans = keyed_plans(fx.all_plans(spark, sf_dir)).select("Period", "Date", "Item", "Location", KEY, F.lit("plan").alias("kind"))
    forecasts = keyed_forecasts(fx.all_forecasts(spark, sf_dir))
    return plans.union(forecasts.select("Period", "Date", "Item", "Location", KEY, F.lit("forecast").alias("kind")))


@query
def location_from_name(spark, sf_dir):
    flag = F.col("l_returnflag")
    name = F.when(flag == "A", "Vert_ALEX_Plan_FY2024").when(flag == "N", "Forecast_SAN_FY2024").otherwise("Other_STER_FY2024")
    return fx.lines(spark, sf_dir).select("l_orderkey", name.alias("source_table")).select(
        "l_orderkey", "source_table",
        fn.plan_location(F.col("source_table")).alias("plan_location"),
        fn.forecast_location(F.col("source_table")).alias("forecast_location"),
    )


@query
def optional_columns(spark, sf_dir):
    return union_sources([plan_columns(df, name).drop("Location") for name, df in fx.all_plans(spark, sf_dir).items()])


@query
def union_sources_query(spark, sf_dir):
    return union_sources([plan_columns(df, name) for name, df in fx.all_plans(spark, sf_dir).items()])


@query
def parse_timestamp_tolerant(spark, sf_dir):
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == 2, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .when(kind == 3, F.date_format("ts", "yyyyMMdd'-late'"))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .otherwise(F.date_format("ts", "'on' yyyy-MM-dd"))
    )
    events = fx.table(spark, sf_dir, "events").select("event_id", text.alias("input"))
    parsed = fn.parse_timestamp_utc(F.col("input"))
    return events.select("event_id", "input", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("output"))


@query
def checksum(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("checksum_sha256"))


# --- joins, windows, counts


@query
def calendar_left_join(spark, sf_dir):
    return attach_calendar(forecast_cells(forecast_grid(spark, sf_dir), "Alexandria"), mondays(spark, sf_dir))


@query
def monday_calendar_query(spark, sf_dir):
    return mondays(spark, sf_dir)


@query
def distinct_calendar(spark, sf_dir):
    return scan_calendar(fx.calendar_sheet(spark, sf_dir), fx.calendar_range()).select("Period").distinct()


@query
def anti_new_rows(spark, sf_dir):
    return rows_with_new_keys(keyed_plans(fx.later_plans(spark, sf_dir)), earlier_plan_fact(spark, sf_dir), KEY)


@query
def semi_delete(spark, sf_dir):
    return rows_with_keys_in(earlier_forecast_fact(spark, sf_dir), keyed_forecasts(fx.later_forecasts(spark, sf_dir)), KEY)


@query
def merge_match(spark, sf_dir):
    target = earlier_plan_fact(spark, sf_dir).select("PrimaryKey", KEY, "Planning_Value")
    return match_by_key(target, unique_plans(fx.later_plans(spark, sf_dir)), KEY, ["Planning_Value", "Item"])


@query
def merge_classes(spark, sf_dir):
    """The fate of every key in one full outer join, with both values."""
    found = classify(earlier_plan_fact(spark, sf_dir), unique_plans(fx.later_plans(spark, sf_dir)), KEY, "Planning_Value", ("PrimaryKey",))
    return found.select(KEY, CLASS, F.col("_old_PrimaryKey").alias("PrimaryKey"), F.col("_old_Planning_Value").alias("old_value"), F.col("Planning_Value").alias("new_value"))


@query
def max_key_query(spark, sf_dir):
    return max_key(earlier_plan_fact(spark, sf_dir), "PrimaryKey")


@query
def row_counts(spark, sf_dir):
    return quality.row_counts(keyed_plans(fx.all_plans(spark, sf_dir)), KEY)


@query
def dedup_by_key_query(spark, sf_dir):
    return unique_plans(fx.all_plans(spark, sf_dir))


@query
def dedup_source_cte(spark, sf_dir):
    """The guard in front of a merge: once more over rows that are already unique."""
    rows = unique_plans(fx.all_plans(spark, sf_dir))
    return dedup_by_key(rows, KEY, largest_first(rows, "Planning_Value"))


@query
def surrogate_key(spark, sf_dir):
    rows = unique_plans(fx.all_plans(spark, sf_dir)).select(KEY, "Planning_Value")
    return number_rows(rows, [KEY], "PrimaryKey", F.lit(1000))


# --- upserts and facts


@query
def upsert_changed_query(spark, sf_dir):
    incoming = unique_plans(fx.later_plans(spark, sf_dir))
    return upsert_changed(earlier_plan_fact(spark, sf_dir), incoming, KEY, "Planning_Value", ["Item"])


@query
def insert_new_query(spark, sf_dir):
    return insert_new(earlier_plan_fact(spark, sf_dir), unique_plans(fx.later_plans(spark, sf_dir)), KEY, "PrimaryKey")


@query
def replace_by_key_query(spark, sf_dir):
    target = earlier_forecast_fact(spark, sf_dir)
    incoming = keyed_forecasts(fx.later_forecasts(spark, sf_dir))
    return replace_by_key(target.select(*FORECAST_FACT), incoming, KEY, "IndexKey", FORECAST_ORDER)


@query
def initial_load(spark, sf_dir):
    return build_fact_planning(fx.all_plans(spark, sf_dir))


@query
def fact_planning(spark, sf_dir):
    return build_fact_planning(fx.later_plans(spark, sf_dir), earlier_plan_fact(spark, sf_dir))


@query
def fact_forecast(spark, sf_dir):
    return build_fact_forecast(fx.later_forecasts(spark, sf_dir), earlier_forecast_fact(spark, sf_dir))


def _store(spark) -> VersionStore:
    return VersionStore(spark, new_path(spark, "versions"))


@query
def fact_planning_by_file(spark, sf_dir):
    """The planning fact as a versioned table: only files with a changed row are rewritten."""
    store = _store(spark)
    change = store.begin()
    change.replace(PLANNING, earlier_plan_fact(spark, sf_dir).select(*PLAN_FACT), KEY, "PrimaryKey")
    change.commit()
    change = store.begin()
    take_plans(change, fx.later_plans(spark, sf_dir))
    change.commit()
    return store.read(PLANNING)


@query
def fact_forecast_by_file(spark, sf_dir):
    """The forecast fact as a versioned table: only files with a replaced key are rewritten."""
    store = _store(spark)
    change = store.begin()
    change.replace(FORECAST, earlier_forecast_fact(spark, sf_dir).select(*FORECAST_FACT), KEY, "IndexKey")
    change.commit()
    change = store.begin()
    take_forecasts(change, fx.later_forecasts(spark, sf_dir))
    change.commit()
    return store.read(FORECAST)


# --- ingestion


@query
def files_to_ingest(spark, sf_dir):
    latest = ledger.last_ingested(fx.ingest_ledger(spark, sf_dir))
    return ledger.files_to_ingest(fx.file_listing(spark, sf_dir), latest)


@query
def last_ingested(spark, sf_dir):
    return ledger.last_ingested(fx.ingest_ledger(spark, sf_dir))


@query
def ledger_append(spark, sf_dir):
    due = files_to_ingest(spark, sf_dir).filter("is_due")
    files = due.select(F.concat("resource", F.lit(".xlsx")).alias("file_name"))
    entries = ledger.ledger_entries(files, F.lit("2024-02-01T00:00:00.000000"), "landing")
    return ledger.ledger_view(ledger.ledger_append(fx.ingest_ledger(spark, sf_dir), entries))


@query
def ledger_history(spark, sf_dir):
    """Each resource's current entry, how many there are, and the earliest."""
    history = ledger.ledger_history(fx.ingest_ledger(spark, sf_dir))
    return history.select("resource", "ingestion_date", "file_path", F.size("history").cast("bigint").alias("n_entries"), F.element_at("history", -1)["ingestion_date"].alias("first_entry"))


@query
def file_manifest(spark, sf_dir):
    files = fx.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.col("doc_id").cast("string").alias("file_id"),
        F.lit("2024-01-31T08:00:00Z").alias("last_modified"),
        F.col("text").alias("content"),
        F.col("n_chars").alias("duration_ms"),
        F.lit("2024-02-01T00:00:00").alias("generated_at"),
    )
    return ledger.file_manifest(files, "documents")


def _two_listings(spark, sf_dir):
    """Documents as files, seen twice: some come, some go, some are touched and every fifth has another content."""
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("n_chars").alias("length"), "doc_id", "text")
    sum_of = lambda text: F.sha2(text, 256).alias("checksum")
    edited = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    first = docs.filter("doc_id % 7 <> 3").select("path", "length", sum_of(F.col("text")))
    return first, docs.filter("doc_id % 11 <> 4").select("path", "length", sum_of(edited))


@query
def due_by_content(spark, sf_dir):
    first, second = _two_listings(spark, sf_dir)
    nothing = spark.createDataFrame([], ledger.FILE_HISTORY)
    return ledger.due_by_content(ledger.seen_files(nothing, first, "2024-01-01"), second)


@query
def file_history(spark, sf_dir):
    """The files' history after a first listing, another, and the first once more."""
    first, second = _two_listings(spark, sf_dir)
    history = spark.createDataFrame([], ledger.FILE_HISTORY)
    for at, listing in (("2024-01-01", first), ("2024-01-02", second), ("2024-01-03", first)):
        history = ledger.seen_files(history, listing, at)
    return history


@query
def file_manifest_stream(spark, sf_dir):
    """Documents written to 16 files, which are read back in chunks: rows and checksum of each."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text", F.pmod("doc_id", F.lit(16)).alias("part"))
    folder = new_path(spark, "files")
    docs.repartitionByRange(16, "part").sortWithinPartitions("part", "doc_id").select("part", "text").write.partitionBy("part").text(folder)
    found = ledger.stream_manifest(ledger.list_files(spark, folder), "documents", "2024-02-01T00:00:00")
    part = F.regexp_extract("file_id", "part=([0-9]+)/", 1).cast("bigint")
    return found.select("source_system", part.alias("part"), "checksum_sha256", "generated_at_utc")


@query
def any_changed(spark, sf_dir):
    return ledger.any_changed(files_to_ingest(spark, sf_dir))


@query
def resource_name(spark, sf_dir):
    name = F.concat(F.lit("Plan "), F.col("o_custkey").cast("string"), F.lit(".xlsx"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name")).select(
        "o_orderkey", fn.resource_name(F.col("file_name")).alias("resource"), fn.object_key(F.col("file_name"), "landing").alias("object_key")
    )


# --- checks


def _named_periods(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    return rows_from(grid, find_layout(grid).sku).withColumn("_c0", strip(F.col("_c0")))


def _flipped_cells(spark, sf_dir):
    """Period cells of the flipped forecast grid in long form: ``Sku, Period, value``."""
    long = reshape.transpose_long(_named_periods(spark, sf_dir), corner="Sku", was="Column", label="Period")
    return long.filter(F.col("Sku").isNotNull() & F.col("Period").startswith("F")).select("Sku", "Period", F.col("cell").alias("value"))


def _signed_and_flipped(spark, sf_dir):
    grid = forecast_grid(spark, sf_dir)
    layout = find_layout(grid)
    from_start = rows_from(grid, layout.start).filter(fn.is_kept_period(F.trim("_c0")))
    above = header_pairs(grid, layout).select("col_idx", fn.clean_code(F.col("sku")).alias("Sku"))
    cells = reshape.cells_of(from_start, "Period").join(F.broadcast(above), "col_idx")
    original = cells.select("Sku", F.trim("Period").alias("Period"), fn.unsigned_quantity(F.col("cell")).cast("bigint").alias("value"))
    return original, _flipped_cells(spark, sf_dir)


@query
def reconcile_cells(spark, sf_dir):
    """Cells of the forecast grid against their signed and unsigned readings: where a sign was lost."""
    return quality.reconcile_cells(*_signed_and_flipped(spark, sf_dir), ["Sku", "Period"])


@query
def reconcile_digests(spark, sf_dir):
    """As ``reconcile_cells``, with digests of row blocks and rows before any cell is joined."""
    original, flipped = _signed_and_flipped(spark, sf_dir)
    return quality.reconcile_by_digest(original, flipped, ["Sku", "Period"])


@query
def reconcile_round_trip(spark, sf_dir):
    """Flipped to columns and back again, no cell has changed: how many differ, of how many."""
    flipped = reshape.transpose_wide(_named_periods(spark, sf_dir), corner="Sku").filter(F.col("Sku").isNotNull())
    periods = [c for c in flipped.columns if c.startswith("F")]
    back = reshape.melt_labels(flipped, ["Sku"], periods, "Period", "value")
    before = _flipped_cells(spark, sf_dir)
    differ = quality.reconcile_by_digest(before, back, ["Sku", "Period"]).agg(F.count("*").alias("n_differ"))
    return before.agg(F.count("*").alias("n_cells")).select(differ.scalar().alias("n_differ"), "n_cells")


@query
def reconcile_counts(spark, sf_dir):
    return quality.reconcile_counts(keyed_plans(fx.all_plans(spark, sf_dir)), KEY)


@query
def merge_conflicts(spark, sf_dir):
    return duplicate_keys(keyed_plans(fx.all_plans(spark, sf_dir)), KEY)


# --- whole pipelines


@query
def plan_sheet_to_long_query(spark, sf_dir):
    return plan_sheet_to_long(fx.main_plan_sheet(spark, sf_dir), fx.main_plan_spec(spark, sf_dir))


@query
def forecast_sheet_to_long_query(spark, sf_dir):
    spec = replace(fx.main_forecast_spec(spark, sf_dir), calendar=fx.calendar_range())
    return forecast_sheet_to_long(fx.main_forecast_sheet(spark, sf_dir), fx.calendar_sheet(spark, sf_dir), spec)


def _summary(spark, state):
    """Both facts per location: rows, keys and totals."""
    summaries = []
    for fact, number, value in [("plan_fact", "PrimaryKey", "Planning_Value"), ("forecast_fact", "IndexKey", "Forecast_Value")]:
        if state[fact] is not None:
            summaries.append(state[fact].groupBy("Location").agg(
                F.count("*").alias("n_rows"), F.min(number).alias("first_key"), F.max(number).alias("last_key"),
                F.sum(F.col(number) * F.col(value)).cast("bigint").alias("weighted"), F.sum(value).cast("bigint").alias("total"),
            ).select(F.lit(fact).alias("fact"), "*"))
    empty = "fact string, Location string, n_rows bigint, first_key bigint, last_key bigint, weighted bigint, total bigint"
    return reduce(DataFrame.union, summaries) if summaries else spark.createDataFrame([], empty)


def _refresh(spark, sf_dir, listing=None, taken=None, **state):
    specs = [replace(s, calendar=fx.calendar_range()) for s in fx.refresh_specs(spark, sf_dir)]
    first_listing, first_ledger = fx.refresh_listing(spark, sf_dir, specs)

    def open_sheet(spec: SheetSpec) -> DataFrame:
        return fx.refresh_sheet(spark, sf_dir, spec)

    listing = first_listing if listing is None else listing(first_listing)
    return refresh_all(specs, open_sheet, fx.calendar_sheet(spark, sf_dir), listing, first_ledger if taken is None else taken, now="2024-06-01T00:00:00Z", **state)


@query
def refresh_all_query(spark, sf_dir):
    """Both facts after a first refresh, per location: rows, keys and totals."""
    return _summary(spark, _refresh(spark, sf_dir))


@query
def refresh_again(spark, sf_dir):
    """Facts after three refreshes: the second finds every workbook taken in before changed again, so plans are upserted and
    forecasts replaced; the third, with the ledger of the second, takes nothing."""
    once = _refresh(spark, sf_dir)
    facts = {k: None if once[k] is None else stage(once[k], k) for k in ("plan_fact", "forecast_fact")}
    later = lambda listing: listing.filter(F.col("resource").isin(*once["taken"])).withColumn("modified", F.lit("2024-06-02T09:00:00+09:30"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the other workbooks are not listed
        again = _refresh(spark, sf_dir, later, once["ledger"], long_tables=once["long_tables"], **facts)
        third = _refresh(spark, sf_dir, lambda listing: later(listing).withColumn("modified", F.lit("2024-05-31")), again["ledger"], plan_fact=again["plan_fact"], forecast_fact=again["forecast_fact"])
    return _summary(spark, third).withColumn("n_taken", F.lit(len(third["taken"])).cast("bigint"))


@query
def refresh_store_query(spark, sf_dir):
    """As ``refresh_again``, with facts, long tables and ledger in one store and one commit for each refresh."""
    specs = [replace(s, calendar=fx.calendar_range()) for s in fx.refresh_specs(spark, sf_dir)]
    listing, ledger = fx.refresh_listing(spark, sf_dir, specs)
    store = _store(spark)
    change = store.begin()
    change.append(LEDGER, ledger.select("resource", "ingestion_date", F.lit(None).cast("string").alias("file_path")))
    change.commit()

    def run(listing):
        return refresh_store(store, specs, lambda spec: fx.refresh_sheet(spark, sf_dir, spec), fx.calendar_sheet(spark, sf_dir), listing, now="2024-06-01T00:00:00Z")[1]

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the other workbooks are not listed
        taken = run(listing)
        later = listing.filter(F.col("resource").isin(*taken))
        run(later.withColumn("modified", F.lit("2024-06-02T09:00:00+09:30")))
        third = run(later.withColumn("modified", F.lit("2024-05-31")))
    state = {"plan_fact": store.read(PLANNING), "forecast_fact": store.read(FORECAST)}
    return _summary(spark, state).withColumn("n_taken", F.lit(len(third)).cast("bigint"))


QUERIES = {name.removesuffix("_query"): run for name, run in QUERIES.items()}
