"""From the flat CSV to the staging and source tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotstar.functions.values import SOURCE_DATE_FORMAT
from depotstar.operators.reshape import (
    LOGISTICS_SERVICE,
    SALES_SERVICE,
    clean_names,
    map_columns,
    split_sources,
    split_tolerant,
)
from depotstar.operators.staging import stage_all
from depotstar.operators.sets import union_all
from depotstar.schemas import ITEM_MAPPING, ORDER_MAPPING, SHIPMENT_MAPPING, STAGING, cast_failures
from depotstar.session import stage
from depotstar.sources import tables
from depotstar.sources.csv import (
    FILE_ORDER,
    read_flat,
    read_for_staging,
    source_columns,
    write_flat,
)


def empty_staging(spark: SparkSession, path: str) -> None:
    """Leave the three staging tables without rows."""
    for name, schema in STAGING.items():
        tables.empty(spark, schema, f"{path}/{name}")


def load_staging(
    spark: SparkSession,
    csv: str,
    path: str,
    encoding: str = "ISO-8859-1",
    date_format: str = SOURCE_DATE_FORMAT,
    now: datetime | None = None,
    multi_line: bool | None = None,
) -> dict[str, DataFrame]:
    """Full reload of the staging tables from one CSV, or a folder of them.

    The text is parsed once into a staged copy, with the place of each row in its file; the three
    tables then read their own columns of it.
    """
    flat = stage(read_for_staging(spark, csv, encoding, date_format, multi_line=multi_line), "flat")
    empty_staging(spark, path)
    for name, df in stage_all(flat, FILE_ORDER, now).items():
        tables.append(df, f"{path}/{name}")
    return {t: spark.read.schema(s).parquet(f"{path}/{t}") for t, s in STAGING.items()}


def load_staging_version(
    spark: SparkSession,
    csv: str,
    root: str,
    encoding: str = "ISO-8859-1",
    date_format: str = SOURCE_DATE_FORMAT,
    now: datetime | None = None,
    multi_line: bool | None = None,
) -> int:
    """As `load_staging`, into a new version that readers see once all three tables are there."""
    flat = stage(read_for_staging(spark, csv, encoding, date_format, multi_line=multi_line), "flat")
    return tables.write_version(spark, root, stage_all(flat, FILE_ORDER, now))


def staging_failures(
    spark: SparkSession,
    csv: str,
    encoding: str = "ISO-8859-1",
    date_format: str = SOURCE_DATE_FORMAT,
    multi_line: bool | None = None,
) -> DataFrame:
    """(table_name, column_name, failed): texts of a CSV that the staging load turns to NULL."""
    flat = stage(
        read_flat(spark, csv, source_columns(), encoding, multi_line=multi_line), "texts"
    )
    mappings = {
        "stg_oms_orders": ORDER_MAPPING, "stg_oms_order_items": ITEM_MAPPING,
        "stg_slms_shipments": SHIPMENT_MAPPING,
    }
    return union_all(
        [
            cast_failures(map_columns(flat, m), STAGING[t], date_format).select(
                F.lit(t).alias("table_name"), "column_name", "failed"
            )
            for t, m in mappings.items()
        ]
    )


def load_sources(
    spark: SparkSession, csv: str, path: str, encoding: str = "ISO-8859-1"
) -> dict[str, DataFrame]:
    """Replace the tables `source_orders` and `source_shipping` from one CSV."""
    flat = read_flat(spark, csv, encoding=encoding, multi_line=None)
    orders, shipping = split_sources(clean_names(flat))
    tables.replace(orders, f"{path}/source_orders")
    tables.replace(shipping, f"{path}/source_shipping")
    return {n: tables.read(spark, f"{path}/{n}") for n in ("source_orders", "source_shipping")}


def write_services(df: DataFrame, path: str) -> list[str]:
    """Write the sales and logistics files next to `path`; columns that are absent are skipped."""
    stem = path.removesuffix(".csv")
    sales, logistics = split_tolerant(df, SALES_SERVICE, LOGISTICS_SERVICE)
    return [
        write_flat(sales, f"{stem}_SERVICE_SALES.csv"),
        write_flat(logistics, f"{stem}_SERVICE_LOGISTICS.csv"),
    ]
