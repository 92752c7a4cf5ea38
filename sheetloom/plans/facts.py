"""Long tables to fact tables, first load and refresh."""

import warnings

from pyspark.sql import DataFrame

from ..functions import forecast_key, plan_key
from ..operators.merge import merge_delta
from ..operators.numbering import number_with_copies
from ..operators.upsert import dedup_by_key, initial_load, largest_first, replace_by_key, some_rows
from ..sources.tables import forecast_columns, plan_columns, union_sources

# Names and order of the facts' columns.
KEY = "PDIL"
PLAN_FACT = ["PrimaryKey", KEY, "Period", "Date", "Item", "Planning_Value", "Location", "City", "State"]
FORECAST_FACT = ["IndexKey", KEY, "Period", "Date", "SKU", "Item", "Forecast_Value", "Location"]
FORECAST_ORDER = [KEY, "SKU", "Item", "Forecast_Value"]


def keyed_plans(sources: dict[str, DataFrame]) -> DataFrame:
    """All plan sources in one layout, each row with its natural key."""
    rows = union_sources([plan_columns(df, name) for name, df in sources.items()])
    return rows.withColumn(KEY, plan_key())


def unique_plans(sources: dict[str, DataFrame], ranged: bool = False) -> DataFrame:
    """One row per natural key, the one with the largest value; ``ranged`` as ``dedup_by_key`` has it."""
    rows = keyed_plans(sources)
    # Sampled where it lies, a source makes the keys of the sample only.
    seen = keyed_plans({name: some_rows(df) for name, df in sources.items()})
    return dedup_by_key(rows, KEY, largest_first(rows, "Planning_Value"), ranged, seen)


def build_fact_planning(sources: dict[str, DataFrame], target: DataFrame | None = None) -> DataFrame | None:
    """The state of the planning fact after taking in ``sources``.

    Without a target all keys are numbered. With one, changed values are taken
    over and rows with new keys follow its highest number; both come from one join
    with it.
    """
    if not sources:
        warnings.warn("no planning sources, the fact stays as it is", stacklevel=2)
        return target
    if target is None:
        return initial_load(unique_plans(sources, ranged=True), KEY, "PrimaryKey", PLAN_FACT, ranged=True)
    delta = merge_delta(target, unique_plans(sources), KEY, "Planning_Value", ("Item",), "PrimaryKey")
    return delta.apply(target.select(*PLAN_FACT), "PrimaryKey")


def keyed_forecasts(sources: dict[str, DataFrame]) -> DataFrame:
    rows = union_sources([forecast_columns(df, name) for name, df in sources.items()])
    return rows.withColumn(KEY, forecast_key())


def build_fact_forecast(sources: dict[str, DataFrame], target: DataFrame | None = None) -> DataFrame | None:
    """The state of the forecast fact after taking in ``sources``; copies are kept.

    With a target, its rows under incoming keys are replaced.
    """
    if not sources:
        warnings.warn("no forecast sources, the fact stays as it is", stacklevel=2)
        return target
    incoming = keyed_forecasts(sources)
    if target is None:
        return number_with_copies(incoming, FORECAST_ORDER, "IndexKey").select(*FORECAST_FACT)
    return replace_by_key(target.select(*FORECAST_FACT), incoming, KEY, "IndexKey", FORECAST_ORDER)
