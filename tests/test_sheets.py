import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import columns, reshape
from sheetloom.operators.calendar import monday_calendar
from sheetloom.operators.forecast_melt import find_layout, header_pairs, melt_forecast, preview_rows
from sheetloom.operators.labels import column_map, find_label_row
from sheetloom.operators.plan_melt import melt_plan
from sheetloom.plans.sheets import plan_sheet_to_long
from sheetloom.sources.ranges import column_letters, column_number, parse_range
from sheetloom.sources.sheets import cell_columns, scan_calendar, scan_inferred, scan_lookup, scan_range
from sheetloom.sources.specs import ALL_SPECS, SheetSpec


def test_ranges():
    assert [column_number(c) for c in ("A", "Z", "AA", "BN", "PN")] == [0, 25, 26, 65, 429]
    assert all(column_number(column_letters(i)) == i for i in range(2000))
    at = parse_range("'Vert San Plan'!BN4:PN1000")
    assert (at.sheet, at.first_row, at.last_row, at.width) == ("Vert San Plan", 4, 1000, 365)
    assert parse_range("A2557:B").last_row is None and parse_range("BK:DN").first_row is None
    for bad in ("A", "B2:A3", "A9:B2", "a1:b2"):
        with pytest.raises(ValueError):
            parse_range(bad)
    assert all(parse_range(s.cells).width > 1 for s in ALL_SPECS)


def test_scan_range(sheet, rows):
    grid = sheet([["x", "a", "b"], ["x", None, None], ["x", "c", None], ["x", "d", "e"]])
    assert rows(scan_range(grid, "B1:C3")) == [(1, "a", "b"), (3, "c", None)]
    assert rows(scan_range(grid, "B3:D")) == [(3, "c", None, None), (4, "d", "e", None)]
    headed = scan_range(grid, "B:C", header=True)
    assert headed.columns == ["row_idx", "a", "b"] and rows(headed) == [(3, "c", None), (4, "d", "e")]
    with pytest.raises(ValueError):
        scan_range(grid, "B2:C2", header=True)


def test_scan_lookup_and_types(sheet, rows):
    grid = sheet([["item", "name"], ["7.0", "a"], ["x", "b"], ["1E2", None]])
    assert rows(scan_lookup(grid, "A1:B")) == [(100, None), (7, "a"), (None, "b")]
    typed = scan_inferred(sheet([["1", "1.5", "true", "2026-01-05", "x", None], ["2", None, "false", "2026-01-06", "1", None]]), "A1:F")
    assert dict(typed.dtypes) == {"row_idx": "bigint", "_c0": "bigint", "_c1": "double", "_c2": "boolean", "_c3": "date", "_c4": "string", "_c5": "string"}


PLAN = [
    ["junk", None, None, None],
    [" PERIOD", "F26-01", None, " F26-02 "],
    ["DoW", "Mon", "Tue", "Wed"],
    ["Date ", "1/5/26", "46028", "bad"],
    [None, None, None, None],
    ["7.0", "1,200", "-", "$5"],
    ["0.0", "1", "1", "1"],
    ["", "1", None, "-3"],
    ["total", "x", "2", "3"],
]


def test_melt_plan(sheet, rows):
    grid = sheet(PLAN)
    a, b = date(2026, 1, 5), date(2026, 1, 6)
    expected = {
        ("7", "F26-01", a, 1200.0, "C", "S"), ("7", "Unknown", b, None, "C", "S"), ("7", "F26-02", None, 5.0, "C", "S"),
        ("", "F26-01", a, 1.0, "C", "S"), ("", "Unknown", b, None, "C", "S"), ("", "F26-02", None, -3.0, "C", "S"),
        ("total", "F26-01", a, None, "C", "S"), ("total", "Unknown", b, 2.0, "C", "S"), ("total", "F26-02", None, 3.0, "C", "S"),
    }
    spec = SheetSpec("plan", "t", "s", "A2:D9", "DoW", "C", "S")
    assert set(rows(plan_sheet_to_long(grid, spec))) == expected
    junk = {("junk", *cell[1:3], None, "C", "S") for cell in expected}
    assert set(rows(melt_plan(grid, "C", "S", "dow"))) == expected | junk


def test_dates_fall_back_to_the_week_row(sheet, rows):
    grid = sheet([["Period", "F26-01"], ["DofWk", "1/5/2026"], ["7", "1"]])
    assert rows(column_map(grid, "DofWk")) == [(1, "F26-01", "1/5/2026", date(2026, 1, 5))]
    with pytest.raises(ValueError, match="date or DoW"):
        column_map(grid, "DoW")
    with pytest.raises(ValueError, match="total"):
        find_label_row(grid, ["total"])


FORECAST = [
    ["Forecasts", None, None, None, None],
    [None, "9001.0", None, " ", None],
    [None, None, None, None, None],
    [" sku ", "11.0", "SK-2", "13", None],
    ["Cases / Pallet", "1", "1", "1", "1"],
    ["F26-01", "2.5", "(4)", None, "9"],
    ["Case Weight", "1", "1", "1", "1"],
    ["F26-02", "-3", "n/a", "1", "9"],
    ["77.5", "1", "1", "1", "1"],
]


def test_melt_forecast(spark, sheet, rows):
    grid = scan_range(sheet(FORECAST), "A1:E")
    layout = find_layout(grid)
    assert (layout.sku, layout.item, layout.start) == (4, 2, 6)
    assert rows(header_pairs(grid, layout)) == [(1, "9001.0", "11.0"), (2, None, "SK-2"), (3, "", "13")]
    calendar = sheet([["1/5/26", " F26-01 "], ["46028", "F26-01"], ["46034", "F26-01"], ["1/5/26", "F26-01"]])
    mondays = monday_calendar(scan_calendar(calendar, "A1:B"))
    a, b = date(2026, 1, 5), date(2026, 1, 12)
    assert rows(mondays) == [("F26-01", b), ("F26-01", a)]
    items = {"11": "9001", "SK-2": "600SK-2", "13": "60013"}
    first = {"11": 3.0, "SK-2": 4.0, "13": 0.0}
    second = {"11": 3.0, "SK-2": 0.0, "13": 1.0}
    expected = {("F26-01", d, s, items[s], v) for d in (a, b) for s, v in first.items()}
    expected |= {("F26-02", None, s, items[s], v) for s, v in second.items()}
    assert set(rows(melt_forecast(grid, "San Antonio", mondays))) == expected


def test_forecast_layout_errors(sheet):
    no_items = find_layout(sheet([["SKU", "1"], ["F26-01", "2"]]))
    assert no_items.item is None and [r["item"] for r in header_pairs(sheet([["SKU", "1"], ["F26-01", "2"]]), no_items).collect()] == [None]
    with pytest.raises(ValueError, match="SKU"):
        find_layout(sheet([["x"]] * 25 + [["SKU"], ["F26-01"]]))
    with pytest.raises(ValueError, match="period"):
        find_layout(sheet([["SKU"], ["f26-01"], ["Fall"]]))


def test_preview_counts_rows_that_are_there(sheet):
    grid = scan_range(sheet([["a"], [None], ["b"], [None], ["c"], ["d"]]), "A1:A")
    assert sorted(r["row_idx"] for r in preview_rows(grid, 3).collect()) == [1, 3, 5]


def test_transpose_and_back(sheet, rows):
    grid = sheet([["SKU", "11.0", "SK"], ["F1", "2.5", "x"], ["Case Weight", "1", "1"], [None, "9", "9"], ["F2", "3.5", None]])
    wide = reshape.transpose_wide(grid)
    assert wide.columns == ["SKU", "Period", "F1", "F2"]
    assert rows(wide) == [("11", "_c1", 2, 4), ("SK", "_c2", 0, 0)]
    back = reshape.melt_labels(wide, ["SKU"], ["F1", "F2"], "label", "value")
    assert set(rows(back)) == {("11", "F1", 2), ("11", "F2", 4), ("SK", "F1", 0), ("SK", "F2", 0)}
    with pytest.raises(ValueError):
        reshape.transpose_wide(grid, corner="none")


def test_transpose_keeps_rows_of_one_name(sheet, rows):
    grid = sheet([["SKU", "1", "2"], ["F1", "10", "20"], ["f1", "11", "21"], ["F1", "12", "22"], ["SKU", "13", "23"], ["Period", "14", "24"]])
    wide = reshape.transpose_wide(grid)
    assert wide.columns == ["SKU", "Period", "F1", "f1_1", "F1_2", "SKU_1", "Period_1"]
    assert rows(wide) == [("1", "_c1", 10, 11, 12, 13, 14), ("2", "_c2", 20, 21, 22, 23, 24)]
    assert rows(reshape.transpose_wide(grid.filter("row_idx = 1"))) == [("1", "_c1"), ("2", "_c2")]


def test_row_names_pass_over_names_that_rows_have(sheet, rows):
    labels = ["SKU", "F", "f", "F_1", "F", "F_3", "F_1", "g_1", "g_2", "SKU_1", "F_1_1", "Period"]
    grid = sheet([[label, str(i)] for i, label in enumerate(labels)])
    long = reshape.transpose_long(grid)
    names = [r["name"] for r in long.orderBy("row_idx").collect()]
    assert names == ["F", "f_2", "F_1", "F_4", "F_3", "F_1_2", "g_1", "g_2", "SKU_1", "F_1_1", "Period_1"]
    assert len({n.lower() for n in names}) == len(names)
    assert reshape.transpose_wide(grid).columns == ["SKU", "Period", *names]


def test_transpose_in_tiles(spark, sheet, rows):
    grid = sheet([["SKU", *[str(c) for c in range(7)]], *[[f"F{i}", *[str(i * 10 + c) if (i + c) % 5 else None for c in range(7)]] for i in range(23)], [None, "9"]])
    tiles = reshape.transpose_tiles(grid, height=4, width=3)
    assert tiles.count() == 6 * 7 and tiles.agg(F.max(F.size("cells"))).first()[0] == 4
    cells = tiles.select(F.explode(F.arrays_zip("names", "cells")).alias("x"), "Period", "SKU").select("x.names", "Period", "SKU", "x.cells")
    assert rows(cells) == rows(reshape.transpose_long(grid), "name", "Period", "SKU", "cell")
    one = reshape.transpose_tiles(grid.filter("row_idx < 4"), height=1, width=1)
    assert one.filter("Period = '_c7'").orderBy("row_block").select("names", "cells").collect() == [(["F0"], [6]), (["F1"], [16])]


def test_a_tall_grid_flips(spark):
    tall = spark.range(300_000).selectExpr("id + 2 as row_idx", "if(id % 3 = 0, 'same', concat('n', id)) as _c0", "cast(id as string) as _c1")
    top = spark.createDataFrame([(1, "SKU", "5")], "row_idx long, _c0 string, _c1 string")
    long = reshape.transpose_long(tall.union(top))
    assert tuple(long.agg(F.count("*"), F.countDistinct("name"), F.sum("cell")).first()) == (300_000, 300_000, 299_999 * 150_000)


def test_white_space_of_every_kind(spark, sheet, rows):
    nb = "\u00a0"
    plan = scan_range(sheet([["Period", f"{nb}F26-01\t", "F26-02"], ["Date", f"{nb}1/5/2026\n", "46034"], ["7", "1", "2"]]), "A1:C")
    assert [(r["period"], str(r["date"])) for r in column_map(plan, None).orderBy("col_idx").collect()] == [("F26-01", "2026-01-05"), ("F26-02", "2026-01-12")]
    forecast = scan_range(sheet([[None, f"{nb}9.0{nb}"], [f"SKU\n{nb}", "\t1.0"], [f"{nb}F26-01", "2"]]), "A1:B")
    layout = find_layout(forecast)
    assert (layout.sku, layout.item, layout.start) == (2, 1, 3)
    assert rows(header_pairs(forecast, layout)) == [(1, "9.0", "1.0")]


def test_many_blank_headings():
    start = time.perf_counter()
    assert columns.unique_names([None] * 16_000)[-1] == "_15999"
    assert time.perf_counter() - start < 0.5


def test_names(sheet):
    assert columns.clean_name(" a b.c-d/e ") == "a_b_c_d_e" and columns.clean_name(None) == ""
    assert columns.unique_names(["a", "a", "a_1"]) == ["a", "a_1", "a_1_1"]
    assert columns.unique_names(["a", "a_1", "a"]) == ["a", "a_1", "a_2"]
    grid = sheet([[None, None, None, "FY 26", "0"], ["p", "q", "r", "Jan", "0"], ["1", "2", "3", "4", "5"]])
    assert columns.two_row_header(grid).columns == ["row_idx", "Category", "SubCategory", "Customer", "FY_26_Jan", "0_0"]
    assert columns.two_row_header_plain(grid).columns == ["row_idx", "", "_1", "_2", "FY_26_Jan", "0"]
    assert columns.two_row_header(grid).count() == 3
    with pytest.raises(ValueError):
        columns.two_row_header(grid.filter("row_idx < 3"))
    typed = reshape.cast_period_columns(columns.two_row_header(grid))
    assert dict(typed.dtypes)["FY_26_Jan"] == "double" and dict(typed.dtypes)["Customer"] == "string"


def test_wide_grids_plan_quickly(spark, sheet):
    """Dropping empty rows below hundreds of renamed columns must not stall the optimizer."""
    width = 300
    grid = sheet([["Period"] + ["F26-01"] * width, ["Date"] + ["1/5/26"] * width, ["7"] + ["1"] * width, [None] * (width + 1)])
    cut = scan_range(grid, f"A1:{column_letters(width)}")
    assert len(cell_columns(cut)) == width + 1
    assert melt_plan(cut, None, None, None).count() == width
