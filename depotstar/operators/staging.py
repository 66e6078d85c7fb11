"""From one flat row per order line to the three staging tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from depotstar.operators.dedupe import keep_first
from depotstar.operators.reshape import map_columns, run_time, with_load_lineage
from depotstar.schemas import ITEM_MAPPING, ORDER_MAPPING, SHIPMENT_MAPPING, STAGING, conform

# Source systems of the staging tables.
SYSTEMS = {
    "stg_oms_orders": "OMS",
    "stg_oms_order_items": "OMS",
    "stg_slms_shipments": "SLMS",
}


def stage_orders(flat: DataFrame, order: list[str], now: datetime | None = None) -> DataFrame:
    """One row per order: the first in the given order of rows."""
    first = keep_first(map_columns(flat, ORDER_MAPPING, keep=order), ["order_id"], order)
    return _finish(first, "stg_oms_orders", now)


def stage_items(flat: DataFrame, now: datetime | None = None) -> DataFrame:
    return _finish(map_columns(flat, ITEM_MAPPING), "stg_oms_order_items", now)


def stage_shipments(flat: DataFrame, now: datetime | None = None) -> DataFrame:
    """One row per order line; the line id doubles as shipment id, the order place as ship place."""
    return _finish(map_columns(flat, SHIPMENT_MAPPING), "stg_slms_shipments", now)


def load_defaults(table: str, now: datetime | None = None) -> dict:
    """Values a staging table gives to columns a batch does not carry."""
    return {"load_timestamp": run_time(now), "source_system": SYSTEMS[table]}


def conform_staging(df: DataFrame, table: str, now: datetime | None = None) -> DataFrame:
    """Bring a batch to the layout of its staging table."""
    return conform(df, STAGING[table], load_defaults(table, now))


def _finish(df: DataFrame, table: str, now: datetime | None) -> DataFrame:
    return conform_staging(with_load_lineage(df, SYSTEMS[table], now), table, now)


def stage_all(flat: DataFrame, order: list[str], now: datetime | None = None) -> dict:
    """The three staging tables of one scan."""
    return {
        "stg_oms_orders": stage_orders(flat, order, now),
        "stg_oms_order_items": stage_items(flat, now),
        "stg_slms_shipments": stage_shipments(flat, now),
    }
