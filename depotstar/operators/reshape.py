"""Column selection, renaming, vertical splits and lineage columns."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the two source tables, after `clean_names`.
SOURCE_ORDERS = [
    "customer_id", "customer_fname", "customer_lname", "customer_segment", "customer_city",
    "customer_state", "customer_country", "customer_street", "customer_zipcode", "customer_email",
    "order_id", "order_date_dateorders", "order_status", "order_city", "order_state",
    "order_country", "order_zipcode", "order_item_id", "order_item_product_price",
    "order_item_discount", "order_item_discount_rate", "order_item_quantity", "order_item_total",
    "order_item_profit_ratio", "product_card_id", "product_name", "product_description",
    "product_category_id", "product_price", "product_status", "product_image",
    "sales_per_customer", "order_profit_per_order", "sales", "category_id", "category_name",
    "department_id", "department_name", "market", "order_region", "days_for_shipment_scheduled",
    "type",
]
SOURCE_SHIPPING = [
    "shipping_mode", "shipping_date_dateorders", "days_for_shipping_real", "late_delivery_risk",
    "delivery_status", "latitude", "longitude", "customer_city", "customer_state",
    "customer_country", "order_id", "order_customer_id",
]
# Columns of the two service files, as far as the input has them.
SALES_SERVICE = [
    "Order Id", "order date (DateOrders)", "Order Status", "Customer Id", "Customer Fname",
    "Customer Lname", "Customer Segment", "Customer City", "Customer Country", "Market",
    "Order Region", "Product Card Id", "Product Name", "Category Name", "Product Price", "Sales",
    "Order Item Quantity", "Order Item Discount", "Order Item Total", "Benefit per order",
    "Order Profit Per Order",
]
LOGISTICS_SERVICE = [
    "Order Id", "shipping date (DateOrders)", "Shipping Mode", "Days for shipping (real)",
    "Days for shipment (scheduled)", "Delivery Status", "Late_delivery_risk", "Latitude",
    "Longitude", "Order City", "Order Country", "Order State",
]


def map_columns(df: DataFrame, mapping: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Select and rename by a source -> target mapping; `keep` columns pass unchanged."""
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in mapping.items()], *(keep or []))


def clean_name(name: str) -> str:
    """Lower case, blanks to underscores, everything but letters, digits and `_` removed."""
    return re.sub(r"[^a-z0-9_]", "", name.strip().lower().replace(" ", "_"), flags=re.ASCII)


def clean_names(df: DataFrame) -> DataFrame:
    """Clean every column name; two names that become one are an error."""
    names = [clean_name(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns collide after cleaning: {clash}")
    return df.toDF(*names)


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename unless the column is absent or the new name is taken."""
    return df if new in df.columns else df.withColumnRenamed(old, new)


def split_strict(df: DataFrame, *parts: list[str]) -> list[DataFrame]:
    """One frame per column list; a missing column is an error."""
    for part in parts:
        missing = [c for c in part if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
    return [df.select([F.col(f"`{c}`") for c in part]) for part in parts]


def split_tolerant(df: DataFrame, *parts: list[str]) -> list[DataFrame]:
    """One frame per column list, of those columns that exist."""
    return [df.select([F.col(f"`{c}`") for c in part if c in df.columns]) for part in parts]


def split_sources(df: DataFrame) -> list[DataFrame]:
    """The order and shipping source tables from a frame with cleaned names."""
    df = rename_if_present(df, "ordercustomerid", "order_customer_id")
    return split_strict(df, SOURCE_ORDERS, SOURCE_SHIPPING)


def run_time(now: datetime | None) -> Column:
    """The time of the run; pass `now`, in session time, to make runs comparable."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now.isoformat(sep=" ")).cast("timestamp")


def with_load_lineage(df: DataFrame, system: str, now: datetime | None = None) -> DataFrame:
    """Add `load_timestamp` and `source_system`."""
    return df.withColumns({"load_timestamp": run_time(now), "source_system": F.lit(system)})


def with_record_lineage(
    df: DataFrame, source: str, now: datetime | None = None, loaded_by: str | None = None
) -> DataFrame:
    """Add the cleansing time as text and the record source; with `loaded_by` the longer form."""
    if loaded_by is not None:
        return df.withColumns(
            {
                "source_system": F.lit(source),
                "load_date": run_time(now),
                "loaded_by": F.lit(loaded_by),
            }
        )
    stamp = F.date_format(run_time(now), "yyyy-MM-dd HH:mm:ss")
    return df.withColumns({"cleansing_timestamp": stamp, "record_source": F.lit(source)})


def nameless_columns(df: DataFrame) -> list[str]:
    """Columns with a blank header, as read by Spark (`_c3`) or by other tools (`Unnamed: 3`)."""
    return [
        c for c in df.columns if not c.strip() or "Unnamed" in c or re.fullmatch(r"_c\d+", c)
    ]


def link_services(sales: DataFrame, logistics: DataFrame) -> DataFrame:
    """Join the two service splits on the order.

    Both have one row per order line, so a plain join would pair every line with every shipment of
    its order. Logistics is brought to one row per order first, and so is sales.
    """
    late = F.col("`Late_delivery_risk`").cast("int")
    shipped = logistics.groupBy(F.col("`Order Id`").alias("order_id")).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum(late).alias("late_shipments"),
        F.max("`shipping date (DateOrders)`").alias("last_ship_date"),
    )
    sold = sales.groupBy(F.col("`Order Id`").alias("order_id")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Sales").alias("sales")
    )
    return sold.join(shipped, "order_id", "left")
