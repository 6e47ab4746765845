"""The check lists of the five source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfsight import config
from shelfsight.operators.checks import spelled
from shelfsight.operators.engine import CheckSpec
from shelfsight.sources.files import INGEST_ORDER


# What identifies a row, and what it must hold besides.
KEYS = {
    "transactions": ("outlet_id", "year", "month", "distributor_id", "sku_id"),
    "outlets": ("outlet_id",),
    "coordinates": ("outlet_id",),
    "seasonality": ("distributor_id", "year", "month"),
    "holidays": ("date", "holiday_name", "holiday_type"),
}
_MORE = {
    "transactions": ("volume_liters", "total_bill_value"),
    "outlets": ("outlet_type",),
    "coordinates": ("latitude", "longitude"),
    "seasonality": ("seasonality_index",),
    "holidays": (),
}
MANDATORY = {name: (*keys, *_MORE[name]) for name, keys in KEYS.items()}


def _complete(name: str) -> CheckSpec:
    return CheckSpec("null", {"mandatory_cols": list(MANDATORY[name])})


def _once(name: str, order: Sequence[str]) -> CheckSpec:
    return CheckSpec("duplicate", {"keys": list(KEYS[name]), "order": list(order)})


def _within(col: str, bounds: tuple[float, float]) -> CheckSpec:
    return CheckSpec("value_range", dict(zip(("col", "min_", "max_"), (col, *bounds))))


def outlet_checks(order: Sequence[str] = INGEST_ORDER) -> list[CheckSpec]:
    names = {"outlet_type": config.OUTLET_TYPES, "outlet_size": config.OUTLET_SIZES}
    return [
        _complete("outlets"),
        _once("outlets", order),
        *[CheckSpec("text_normalize", {"col": c, "mapping": known}) for c, known in names.items()],
        _within("cooler_count", config.COOLER_BOUNDS),
    ]


def coordinate_checks(order: Sequence[str] = INGEST_ORDER) -> list[CheckSpec]:
    return [
        _complete("coordinates"),
        _once("coordinates", order),
        CheckSpec("coord_swap_fix", {"lat_bounds": config.LAT_BOUNDS, "lon_bounds": config.LON_BOUNDS}),
        _within("latitude", config.LAT_BOUNDS),
        _within("longitude", config.LON_BOUNDS),
    ]


def season_checks(order: Sequence[str] = INGEST_ORDER) -> list[CheckSpec]:
    return [
        _complete("seasonality"),
        _once("seasonality", order),
        _within("month", config.MONTH_BOUNDS),
        _within("year", config.YEAR_BOUNDS),
        CheckSpec("format", {"col": "seasonality_index", "regex": spelled(list(config.SEASON_INDEX))}),
    ]


def holiday_checks(order: Sequence[str] = INGEST_ORDER) -> list[CheckSpec]:
    return [_complete("holidays"), CheckSpec("format", {"col": "date", "dtype": "datetime"}), _once("holidays", order)]


def transaction_checks(outlets: DataFrame, order: Sequence[str] = INGEST_ORDER) -> list[CheckSpec]:
    whole = [CheckSpec("format", {"col": c, "dtype": "int"}) for c in ("year", "month")]
    return [
        _complete("transactions"),
        *whole,
        _within("year", config.YEAR_BOUNDS),
        _within("month", config.MONTH_BOUNDS),
        CheckSpec("referential_integrity", {"fk_col": "outlet_id", "ref_df": outlets, "ref_col": "outlet_id"}),
        CheckSpec("negative_volume_tag", {"value_col": "volume_liters"}),
        _once("transactions", order),
    ]
