"""Cleaning rules as column expressions. None depends on ANSI mode, time zone or parser policy."""

from .codes import (
    clean_code, clean_item, fill_item_prefix, is_kept_item, is_kept_period,
    placeholder_to_null, placeholder_to_zero, trim_code,
)
from .dates import calendar_date, mixed_date, parse_timestamp_utc, serial_date, widen_year
from .keys import (
    forecast_key, forecast_location, object_key, plan_key, plan_location, resource_name,
)
from .quantities import quantity_or_zero, rounded_half_even, signed_quantity, unsigned_quantity

__all__ = [
    "calendar_date", "clean_code", "clean_item", "fill_item_prefix", "forecast_key",
    "forecast_location", "is_kept_item", "is_kept_period", "mixed_date", "object_key",
    "parse_timestamp_utc", "placeholder_to_null", "placeholder_to_zero", "plan_key",
    "plan_location", "quantity_or_zero", "resource_name", "rounded_half_even", "serial_date",
    "signed_quantity", "trim_code", "unsigned_quantity", "widen_year",
]
