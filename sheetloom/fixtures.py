"""Sheets, long tables and listings in the shapes of real ones, derived from the given tables.

Everything is computed from whole tables with DataFrame code. Sheets are landed
as parquet once per session and folder, as an ingestion would leave them.
"""

import json
from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.sheets import ROW
from .sources.specs import FORECAST_SPECS, PLAN_SPECS, SheetSpec
from .sources.ranges import parse_range
from .staging import new_path, path_exists

_landed: dict[tuple[str, str, str], str] = {}
_landing: dict[tuple[str, str, str], Lock] = {}
_axes: dict[tuple[str, str], tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table written at first use and read back at each; of several threads one writes it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _landing.setdefault(key, Lock()):
        if key not in _landed or not path_exists(spark, _landed[key]):
            path = new_path(spark, name)
            make().write.parquet(path)
            _landed[key] = path
    return spark.read.parquet(_landed[key])


# --- line items, 28 years on: same weekdays and leap days, two-digit years of this century


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_quantity", F.add_months(F.col("l_shipdate").cast("date"), 336).alias("ship_date"),
    )


def week_axis(spark: SparkSession, sf_dir: str) -> tuple:
    """First Monday and number of weeks; column names of the wide sheets depend on it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _axes:
        span = lines(spark, sf_dir).agg(
            F.min(F.trunc("ship_date", "week")).alias("first"),
            F.max(F.trunc("ship_date", "week")).alias("last"),
        ).first()
        _axes[key] = (span["first"], (span["last"] - span["first"]).days // 7 + 1)
    return _axes[key]


def week_period(d: Column) -> Column:
    return F.concat(F.lit("F"), F.date_format(F.trunc(d, "week"), "yy-MMdd"))


def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, n = week_axis(spark, sf_dir)
    axis = spark.range(1, n + 1).select(F.col("id").cast("int").alias("col_idx"))
    axis = axis.withColumn("monday", F.date_add(F.lit(first), (F.col("col_idx") - 1) * 7))
    return axis.withColumn("period", week_period(F.col("monday")))


def as_date_text(d: Column, kind: Column) -> Column:
    """The same date as month/day/year, with a two-digit year, or as a serial number."""
    serial = F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string")
    return (
        F.when(kind == 0, F.date_format(d, "M/d/yyyy"))
        .when(kind == 1, F.date_format(d, "M/d/yy"))
        .otherwise(serial)
    )


def padded(c: Column, end: str) -> Column:
    """With white space around it that is no plain blank."""
    return F.concat(F.lit("\u00a0"), c, F.lit(end))


def _spread(df: DataFrame, left: int, n: int) -> DataFrame:
    """``label`` and ``n`` cells placed on the sheet from column ``left`` on, blanks before them."""
    blank = [f"CAST(NULL AS STRING) AS _c{i}" for i in range(left)]
    cells = [f"get(cells, {i}) AS _c{left + i + 1}" for i in range(n)]
    return df.selectExpr(ROW, *blank, f"label AS _c{left}", *cells)


# --- plan sheets: parts down, weeks across

CELLS_PER_FILE = 1_000_000


def plan_text(key: Column, week: Column, amount: Column) -> Column:
    """A plan cell as people write it."""
    plain = amount.cast("string")
    kind = (key + week) % 7
    return (
        F.when(kind == 0, "-")
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.concat(F.lit("$"), plain))
        .when(kind == 3, F.format_number(amount * 1000, 0))
        .when(kind == 4, F.concat(F.lit("-"), plain))
        .otherwise(plain)
    )


def _plan_cells(spark: SparkSession, n: int) -> Column:
    """The cells of the part ``key`` with the texts of ``sold``, week by week, and between them those of weeks without a sale.

    What a week without a sale says depends on the key's remainder alone: seven rows as long as the sheet is wide, which go into
    the plan as a constant. A missing or negative key has no such row and gets its own.
    """
    zero = F.lit(0).cast("bigint")
    week_numbers = F.sequence(F.lit(1), F.lit(n))

    def unsold(key: Column) -> Column:
        return F.transform(week_numbers, lambda week: plan_text(key, week, zero))

    rows = spark.range(7).select("id", unsold(F.col("id")).alias("cells")).collect()
    known = F.from_json(F.lit(json.dumps([r["cells"] for r in sorted(rows)])), "array<array<string>>")
    blank = F.coalesce(F.when(F.col("key") >= 0, F.get(known, (F.col("key") % 7).cast("int"))), unsold(F.col("key")))

    def after_last(cell: Column, i: Column) -> Column:
        last = F.coalesce(F.get("sold", i - 1)["key"], F.lit(0))
        return F.concat(F.slice(blank, last + 1, cell["key"] - last - 1), F.array(cell["value"]))

    last = F.element_at("sold", -1)["key"]
    filled = F.flatten(F.concat(F.transform("sold", after_last), F.array(F.slice(blank, last + 1, F.lit(n) - last))))
    return F.when(F.col("sold").isNull(), blank).otherwise(filled)


def sold_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part the texts of weeks with a sale, written once for all plan sheets."""
    def make():
        first, _ = week_axis(spark, sf_dir)
        week = (F.datediff(F.trunc("ship_date", "week"), F.lit(first)) / 7).cast("int") + 1
        sums = lines(spark, sf_dir).withColumn("week", week).groupBy("week", "l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("n"))
        amount = F.coalesce("n", F.lit(0).cast("bigint"))
        written = sums.select("l_partkey", F.struct("week", plan_text(F.col("l_partkey"), F.col("week"), amount).alias("text")).alias("cell"))
        return written.groupBy("l_partkey").agg(F.array_sort(F.map_entries(F.map_from_entries(F.collect_list("cell")))).alias("sold"))

    return landed(spark, sf_dir, "sold_by_part", make)


def plan_sheet(spark: SparkSession, sf_dir: str, spec: SheetSpec, parts: DataFrame) -> DataFrame:
    """Rows are put in order with only their sales; cells are made afterwards, where the row is written, in tasks of a bounded number of cells."""
    at = parse_range(spec.cells)
    top = at.first_row
    n = week_axis(spark, sf_dir)[1]
    sold = sold_by_part(spark, sf_dir)
    label = F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ".0").otherwise(""))
    none = F.lit(None).cast("array<string>")
    body = parts.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        (F.col("p_partkey") + top + 4).alias(ROW), label.alias("label"), F.col("p_partkey").alias("key"), "sold", none.alias("cells")
    )
    axis = weeks(spark, sf_dir)
    number = F.col("col_idx")
    day_text = as_date_text(F.col("monday"), number % 3)
    above = axis.agg(
        F.array_sort(F.collect_list(F.struct(
            "col_idx",
            F.when(number % 50 == 0, None).when(number % 10 == 3, padded(F.col("period"), "\n")).otherwise(F.concat(F.lit(" "), "period")).alias("period"),
            F.lit("Mon").alias("day"),
            F.when(number % 5 == 2, padded(day_text, "\t")).otherwise(day_text).alias("date"),
        ))).alias("above")
    )
    empty = F.array_repeat(F.lit(None).cast("string"), n)
    heads = [(" Period ", F.col("above.period")), (spec.week_label, F.col("above.day")), ("DATE", F.col("above.date")), (None, empty)]
    whole = body
    for i, (name, cells) in enumerate(heads):
        whole = whole.union(above.select(
            F.lit(top + i).cast("bigint").alias(ROW), F.lit(name).cast("string").alias("label"),
            F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("array<struct<key:int,value:string>>").alias("sold"), cells.alias("cells"),
        ))
    placed = _in_order(whole, parts.count() * n // CELLS_PER_FILE + 1)
    return _spread(placed.select(ROW, "label", F.coalesce("cells", _plan_cells(spark, n)).alias("cells")), at.first_col, n)


def _in_order(sheet: DataFrame, files: int | None = None) -> DataFrame:
    return sheet.repartitionByRange(*([files] if files else []), ROW).sortWithinPartitions(ROW)


def main_plan_spec(spark: SparkSession, sf_dir: str) -> SheetSpec:
    return PLAN_SPECS[0].resized(week_axis(spark, sf_dir)[1] + 1)


def main_plan_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = main_plan_spec(spark, sf_dir)
    return landed(spark, sf_dir, "plan_sheet", lambda: plan_sheet(spark, sf_dir, spec, table(spark, sf_dir, "part")))


# --- forecast sheets: weeks down, part sizes across

SIZES = 50  # part sizes run from 1 to 50


def _per_week(rows: DataFrame, first) -> DataFrame:
    """``week`` and a map from part size to the whole quantity."""
    week = (F.datediff(F.trunc("ship_date", "week"), F.lit(first)) / 7).cast("int") + 1
    sums = rows.withColumn("week", week).groupBy("p_size", "week").agg(F.sum("l_quantity").cast("bigint").alias("n"))
    return sums.groupBy("week").agg(F.map_from_entries(F.collect_list(F.struct("p_size", "n"))).alias("n_by"))


def forecast_sheet(spark: SparkSession, sf_dir: str, spec: SheetSpec, sold: DataFrame) -> DataFrame:
    at = parse_range(spec.cells)
    first, n = week_axis(spark, sf_dir)
    sizes = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    joined = sold.join(sizes, sold.l_partkey == sizes.p_partkey)
    sums = _per_week(joined, first)

    def text(size: Column) -> Column:
        amount = F.coalesce(F.try_element_at("n_by", size), F.lit(0).cast("bigint")).cast("string")
        kind = (size + F.dayofmonth("monday")) % 6
        return (
            F.when(kind == 0, F.concat(F.lit("("), amount, F.lit(")")))
            .when(kind == 1, "n/a")
            .when(kind == 2, F.concat(F.lit("-"), amount))
            .when(kind == 3, F.lit(None).cast("string"))
            .when(kind == 4, F.concat(amount, F.lit(".5")))
            .otherwise(amount)
        )

    axis = weeks(spark, sf_dir)
    body = axis.join(sums, axis.col_idx == sums.week, "left").select(
        (F.col("col_idx") + 6).cast("bigint").alias(ROW),
        F.concat("period", F.lit(" ")).alias("label"),
        F.concat(F.transform(F.sequence(F.lit(1), F.lit(SIZES)), text), F.array(F.lit("7"))).alias("cells"),
    )
    numbers = range(1, SIZES + 1)
    none = [None]
    heads = [
        (1, "Forecasts", [None] * SIZES + none),
        (2, None, [None if s % 3 == 0 else f"\u00a0{9000 + s}.0\n" if s % 7 == 2 else f" {9000 + s}.0" for s in numbers] + none),
        (3, None, [None] * SIZES + none),
        (4, "\u00a0Sku\n", [f"SK-{s}" if s % 5 == 0 else f"{s}.0" for s in numbers] + none),
        (5, "Cases / Pallet", ["48"] * SIZES + none),
        (6, "Case Weight", ["12.5"] * SIZES + none),
        (n + 7, "Total Cases", ["1"] * SIZES + none),
        (n + 8, "2024.5", ["1"] * SIZES + none),
        (n + 9, None, ["1"] * SIZES + none),
    ]
    rows = spark.createDataFrame(heads, f"{ROW} bigint, label string, cells array<string>")
    return _spread(_in_order(body.union(rows)), at.first_col, SIZES + 1)


def main_forecast_spec(spark: SparkSession, sf_dir: str) -> SheetSpec:
    return FORECAST_SPECS[2].resized(SIZES + 2)


def main_forecast_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = main_forecast_spec(spark, sf_dir)
    return landed(spark, sf_dir, "forecast_sheet", lambda: forecast_sheet(spark, sf_dir, spec, lines(spark, sf_dir)))


CALENDAR_TOP = 2557


def calendar_range() -> str:
    return f"A{CALENDAR_TOP}:B"


def calendar_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        first, _ = week_axis(spark, sf_dir)
        days = lines(spark, sf_dir).select(F.col("ship_date").alias("d")).distinct()
        return days.select(
            (F.datediff("d", F.lit(first)) + CALENDAR_TOP).cast("bigint").alias(ROW),
            as_date_text(F.col("d"), F.dayofmonth("d") % 3).alias("_c0"),
            F.concat(F.lit(" "), week_period(F.col("d")), F.lit(" ")).alias("_c1"),
        )

    return landed(spark, sf_dir, "calendar_sheet", make)


def lookup_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        key = F.col("p_partkey")
        item = (
            F.when(key % 4 == 0, key.cast("string"))
            .when(key % 4 == 1, F.concat(key.cast("string"), F.lit(".0")))
            .when(key % 4 == 2, F.concat(key.cast("string"), F.lit("E1")))
            .otherwise(F.concat(F.lit("P"), key.cast("string")))
        )
        columns = [F.lit("Lookup"), item, F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")]
        body = table(spark, sf_dir, "part").select(
            (key + 3).alias(ROW), *[c.alias(f"_c{i}") for i, c in enumerate(columns)]
        )
        names = [(2, None, "item", "name", "brand", "type", "size")]
        head = spark.createDataFrame(names, f"{ROW} bigint, " + ", ".join(f"_c{i} string" for i in range(6)))
        return _in_order(body.union(head))

    return landed(spark, sf_dir, "lookup_sheet", make)


def typed_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose columns have a type: whole number, number, yes or no, date, text."""
    def make():
        key = F.col("p_partkey")
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))
        columns = [
            key.cast("string"),
            F.when(key % 10 != 0, F.col("p_size").cast("string")),
            F.col("p_retailprice").cast("string"),
            (key % 2 == 0).cast("string"),
            day.cast("string"),
            F.col("p_name"),
        ]
        return table(spark, sf_dir, "part").select((key + 1).alias(ROW), *[c.alias(f"_c{i}") for i, c in enumerate(columns)])

    return landed(spark, sf_dir, "typed_sheet", make)


MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def month_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two header rows, then brand, type and size down and calendar months across, with two totals."""
    def make():
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
        sold = lines(spark, sf_dir).withColumn("m", F.month("ship_date"))
        sold = sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
        by = ["p_brand", "p_type", "p_size"]
        sums = sold.groupBy(*by).pivot("m", list(range(1, 13))).agg(F.sum("l_quantity").cast("bigint"))
        brand = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("bigint")
        kind = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("p_type"))
        row = ((brand * 6 + kind) * SIZES + F.col("p_size") + 3).cast("bigint")
        months = [
            F.when(F.col(str(m)).isNull(), ["-", " - ", "", "–", "- 0", None][m % 6]).otherwise(F.col(str(m)).cast("string"))
            for m in range(1, 13)
        ]
        total = sum((F.coalesce(F.col(str(m)), F.lit(0)) for m in range(1, 13)), F.lit(0))
        columns = [F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string"), *months, total.cast("string"), total.cast("string")]
        body = sums.select(row.alias(ROW), *[c.alias(f"_c{i}") for i, c in enumerate(columns)])
        heads = [
            (1, None, None, None, *["FY 26"] * 12, "All", "All"),
            (2, "Brand", "Type", "Size", *[f"{m}-26" for m in MONTHS], "Total", "Total"),
            (3, *[None] * 17),
        ]
        head = spark.createDataFrame(heads, f"{ROW} bigint, " + ", ".join(f"_c{i} string" for i in range(17)))
        return _in_order(body.union(head))

    return landed(spark, sf_dir, "month_sheet", make)


# --- dirty text beside what it was made from


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: dates, quantities, items, codes and periods as people write them."""
    kind = F.col("l_linenumber")
    day, key = F.col("ship_date"), F.col("l_partkey").cast("string")
    n = F.col("l_quantity").cast("bigint")
    plain = n.cast("string")
    serial = as_date_text(day, F.lit(2))
    date_text = (
        F.when(n == 13, "13/45/2026")
        .when(kind == 1, F.date_format(day, "M/d/yyyy"))
        .when(kind == 2, F.date_format(day, "MM/dd/yy"))
        .when(kind == 3, F.concat(F.lit(" "), serial))
        .when(kind == 4, F.concat(serial, F.lit(".75")))
        .when(kind == 5, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 6, F.date_format(day, "yyyy-MM-dd 00:00:00"))
        .otherwise(F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 0:00")))
    )
    quantity_text = (
        F.when(n == 13, "5-3")
        .when(kind == 1, F.concat(F.lit("$ "), plain))
        .when(kind == 2, F.format_number(n * 1000, 0))
        .when(kind == 3, F.concat(F.lit("-"), plain))
        .when(kind == 4, F.concat(F.lit("("), plain, F.lit(")")))
        .when(kind == 5, "-")
        .when(kind == 6, F.lit(None).cast("string"))
        .otherwise(F.concat(plain, F.lit(".5")))
    )
    code_text = (
        F.when(kind == 1, key)
        .when(kind == 2, F.concat(key, F.lit(".0")))
        .when(kind == 3, F.concat(F.lit(" "), key, F.lit(".0 ")))
        .when(kind == 4, F.concat(F.lit("AB-"), key))
        .when(kind == 5, F.concat(F.lit("AB-"), key, F.lit(".0")))
        .when(kind == 6, " ")
    )
    period = F.concat(F.lit("F"), F.date_format(day, "yy-MM"))
    period_text = (
        F.when(kind == 1, period)
        .when(kind == 2, F.concat(F.lit("Cases "), period))
        .when(kind == 3, F.concat(F.lit("PALLET"), plain))
        .when(kind == 4, F.concat(plain, F.lit(".5")))
        .when(kind == 5, "")
        .when(kind == 6, F.concat(plain, F.lit("x")))
    )
    return lines(spark, sf_dir).select(
        "*", date_text.alias("date_text"), quantity_text.alias("quantity_text"),
        code_text.alias("code_text"), period_text.alias("period_text"),
    )


# --- long tables to build facts from

PLAN_TABLES = {"A": "Vert_ALEX_Plan_FY2024", "N": "Vert_SAN_Plan_FY2024", "R": "Vert_STER_Plan_FY2024"}


def plan_rows(rows: DataFrame, no_value: list[int], add: int = 0) -> DataFrame:
    """Plan rows from line items: the seventh has no date, those in ``no_value`` no value."""
    value = F.when(F.col("l_partkey") % 5 == 0, F.col("l_quantity") + add).otherwise(F.col("l_quantity"))
    return rows.select(
        "l_returnflag",
        F.concat(F.lit("F"), F.date_format("ship_date", "yy-MM")).alias("Period"),
        F.when(F.col("l_linenumber") != 7, F.col("ship_date")).alias("Date"),
        F.col("l_partkey").cast("string").alias("Item"),
        F.when(~F.col("l_linenumber").isin(*no_value), value).alias("Planning_Value"),
    )


def plan_sources(rows: DataFrame) -> dict[str, DataFrame]:
    """Per site a table; one has city and state, one names its value differently."""
    by_flag = {flag: rows.filter(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in PLAN_TABLES}
    by_flag["A"] = by_flag["A"].withColumn("City", F.lit("Alexandria")).withColumn("State", F.lit("Virginia"))
    by_flag["R"] = by_flag["R"].withColumnRenamed("Planning_Value", "Forecast_Value")
    return {PLAN_TABLES[flag]: df for flag, df in by_flag.items()}


def all_plans(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return plan_sources(plan_rows(lines(spark, sf_dir), [6]))


def earlier_plans(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What an earlier refresh saw: the first four lines of each order."""
    rows = lines(spark, sf_dir).filter(F.col("l_linenumber") <= 4)
    return plan_sources(plan_rows(rows, [4]))


def later_plans(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What the next one sees: the lines from the third on, every fifth item one higher."""
    rows = lines(spark, sf_dir).filter(F.col("l_linenumber") >= 3)
    return plan_sources(plan_rows(rows, [3, 6], add=1))


FORECAST_TABLES = {"A": "Forecast_SAN_FY2024", "N": "Forecast_SAN_FY2025", "R": "Forecast_STER_FY2024"}


def forecast_sources(rows: DataFrame) -> dict[str, DataFrame]:
    """Forecast rows from line items; the fifth line has neither item nor SKU, so copies are common."""
    fifth = F.col("l_linenumber") == 5
    shaped = rows.select(
        "l_returnflag",
        F.concat(F.lit("F"), F.date_format("ship_date", "yy-MM")).alias("Period"),
        F.when(F.col("l_linenumber") != 7, F.col("ship_date")).alias("Date"),
        F.when(~fifth, F.concat(F.lit("SK-"), F.col("l_suppkey").cast("string"))).alias("SKU"),
        F.when(~fifth, F.col("l_partkey").cast("string")).alias("Item"),
        F.col("l_quantity").alias("Forecast_Value"),
    )
    return {name: shaped.filter(F.col("l_returnflag") == flag).drop("l_returnflag") for flag, name in FORECAST_TABLES.items()}


def all_forecasts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return forecast_sources(lines(spark, sf_dir))


def earlier_forecasts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return forecast_sources(lines(spark, sf_dir).filter(F.col("l_linenumber") <= 5))


def later_forecasts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return forecast_sources(lines(spark, sf_dir).filter(F.col("l_linenumber") >= 3))


# --- file listings and ledgers


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user a file, modified when the user last clicked or viewed, its time written in one of four ways."""
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type").isin("click", "view"), F.col("ts"))).alias("ts")
    )
    user = F.col("user_id")
    modified = (
        F.when(user % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(user % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(user % 4 == 2, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .otherwise("garbage")
    )
    return seen.select(F.concat(F.lit("res_"), user.cast("string")).alias("resource"), modified.alias("modified"))


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase is an ingestion of its user's file, its time written in one of six ways; every tenth user's were lost."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_id") % 6
    stamp = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format(F.timestamp_add("MINUTE", F.lit(330), "ts"), "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == 3, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'"))
        .otherwise("garbage")
    )
    bought = table(spark, sf_dir, "events").filter((F.col("event_type") == "purchase") & (F.col("user_id") % 10 != 0))
    name = F.concat(F.lit("res_"), user)
    return bought.select(
        name.alias("resource"),
        stamp.alias("ingestion_date"),
        F.concat(F.lit("landing/"), name, F.lit("/"), name, F.lit(".xlsx")).alias("file_path"),
    )


# --- a whole refresh: five plan sheets by part type, four forecast sheets by line status

REFRESH_PLANS = dict(zip([s.table for s in PLAN_SPECS], [["STANDARD"], ["SMALL"], ["MEDIUM"], ["ECONOMY", "PROMO"], ["LARGE"]]))
REFRESH_FORECASTS = dict(zip([s.table for s in FORECAST_SPECS], [["NF"], ["RF"], ["NO", "AO", "AF"], ["RO"]]))


def refresh_specs(spark: SparkSession, sf_dir: str) -> list[SheetSpec]:
    n = week_axis(spark, sf_dir)[1]
    return [s.resized(n + 1) for s in PLAN_SPECS] + [s.resized(SIZES + 2) for s in FORECAST_SPECS]


def refresh_sheet(spark: SparkSession, sf_dir: str, spec: SheetSpec) -> DataFrame:
    def make():
        if spec.kind == "plan":
            parts = table(spark, sf_dir, "part").filter(F.col("p_type").isin(*REFRESH_PLANS[spec.table]))
            return plan_sheet(spark, sf_dir, spec, parts)
        status = F.concat("l_returnflag", "l_linestatus")
        return forecast_sheet(spark, sf_dir, spec, lines(spark, sf_dir).filter(status.isin(*REFRESH_FORECASTS[spec.table])))

    return landed(spark, sf_dir, spec.table, make)


def refresh_listing(spark: SparkSession, sf_dir: str, specs: list[SheetSpec]) -> tuple[DataFrame, DataFrame]:
    """Listing and ledger for the sheets: each user's events count for one of them."""
    names = F.array(*[F.lit(s.table) for s in specs])
    resource = F.element_at(names, (F.col("user_id") % len(specs) + 1).cast("int"))
    events = table(spark, sf_dir, "events").select(resource.alias("resource"), "event_type", "ts")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    changed = events.filter(F.col("event_type").isin("click", "view"))
    listing = changed.groupBy("resource").agg(F.max(stamp).alias("modified"))
    taken = events.filter(F.col("event_type") == "purchase")
    ledger = taken.select("resource", stamp.alias("ingestion_date"))
    return listing, ledger
