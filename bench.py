"""Time the headline queries and print one JSON line.

Sheets and earlier fact tables that queries start from are written first and
not timed. Each query then runs to warm up, and again with all its rows computed: three
times if that took less than 5 seconds, of which the median counts, else once.
"""

import json
import os
import sys
import time
import warnings
from concurrent.futures import ThreadPoolExecutor
from statistics import median

from sheetloom import fixtures, queries
from sheetloom.session import local_session

HEADLINE = [
    "scan_range", "column_map", "melt_plan", "plan_sheet_to_long", "melt_plan_v4",
    "melt_forecast", "forecast_sheet_to_long", "transpose_wide", "reconcile_cells",
    "parse_mixed_date", "clean_quantity_signed", "clean_item", "checksum",
    "dedup_by_key", "surrogate_key", "anti_new_rows", "upsert_changed", "insert_new", "replace_by_key",
    "fact_planning", "fact_forecast", "files_to_ingest", "ledger_append", "sink_create_or_overwrite", "refresh_all",
]


AGAIN_BELOW = 5.0


def prepare(spark, sf_dir: str, names: list[str]) -> dict[str, float]:
    """Write what queries start from; seconds for each part."""
    parts = {
        "plan_sheet": lambda: fixtures.main_plan_sheet(spark, sf_dir),
        "forecast_sheet": lambda: fixtures.main_forecast_sheet(spark, sf_dir),
        "calendar_sheet": lambda: fixtures.calendar_sheet(spark, sf_dir),
        "earlier_plan_fact": lambda: queries.earlier_plan_fact(spark, sf_dir),
        "earlier_forecast_fact": lambda: queries.earlier_forecast_fact(spark, sf_dir),
    }
    if "refresh_all" in names:
        specs = fixtures.refresh_specs(spark, sf_dir)

        def sheets():
            with ThreadPoolExecutor(4) as pool:
                list(pool.map(lambda spec: fixtures.refresh_sheet(spark, sf_dir, spec), specs))

        parts["refresh_sheets"] = sheets
    took = {}
    for name, make in parts.items():
        start = time.perf_counter()
        make()
        took[name] = round(time.perf_counter() - start, 3)
    return took


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(spark, name: str, sf_dir: str) -> float:
    run(spark, name, sf_dir)  # compiles what a first run compiles
    first = run(spark, name, sf_dir)
    return first if first >= AGAIN_BELOW else median([first, run(spark, name, sf_dir), run(spark, name, sf_dir)])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    warnings.simplefilter("ignore")
    spark = local_session(cores, "16g", "bench")
    prepared = prepare(spark, sf_dir, names)
    times = {name: round(timed(spark, name, sf_dir), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "prepare_sec": round(sum(prepared.values()), 3),
        "prepare": prepared,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
