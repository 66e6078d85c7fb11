"""The seven dimensions, as plain rows without keys; `plans.warehouse` adds the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotstar.functions import date_parts
from depotstar.operators.dedupe import first_match
from depotstar.operators.joins import left_lookup
from depotstar.schemas import WAREHOUSE, conform

# Columns whose order fixes the surrogate keys.
NATURAL_KEYS = {
    "dim_department": ["department_id", "department_name"],
    "dim_category": ["category_id", "category_name", "department_key"],
    "dim_product": [
        "product_id", "product_name", "product_card_id", "product_price", "category_key",
    ],
    "dim_customer": [
        "customer_id", "customer_fname", "customer_lname", "customer_segment", "customer_city",
        "customer_state", "customer_country",
    ],
    "dim_geography": ["city", "state", "country", "latitude", "longitude"],
    "dim_date": ["full_date"],
    "dim_shipping": ["shipping_mode", "delivery_status", "delivery_risk"],
}
SURROGATE_KEYS = {
    "dim_department": "department_key",
    "dim_category": "category_key",
    "dim_product": "product_key",
    "dim_customer": "customer_key",
    "dim_geography": "geography_key",
    "dim_date": "date_key",
    "dim_shipping": "shipping_key",
}

ITEM_ATTRIBUTES = [
    "product_id", "product_name", "product_card_id", "product_price", "category_id",
    "category_name", "department_id", "department_name",
]


def item_attributes(items: DataFrame) -> DataFrame:
    """What the items say of products, categories and departments, each combination once.

    The three product dimensions can be built from this in place of the items, which are then read
    and reduced a single time.
    """
    return items.select(*ITEM_ATTRIBUTES).distinct()


def department_rows(items: DataFrame) -> DataFrame:
    named = items.where(F.col("department_id").isNotNull())
    return named.select("department_id", "department_name").distinct()


def category_rows(
    items: DataFrame, dim_department: DataFrame, one_match: bool = True
) -> DataFrame:
    """Categories with their department key.

    Items are reduced to distinct rows before the lookup, so the join works on dimension-sized
    input. With `one_match` a department id leads to one department row, else to each of them.
    """
    named = items.where(F.col("category_id").isNotNull())
    seen = named.select("category_id", "category_name", "department_id").distinct()
    lookup = dim_department.select("department_id", "department_name", "department_key")
    if one_match:
        lookup = first_match(lookup, ["department_id"], ["department_name"])
    joined = left_lookup(seen, lookup, {"department_id": "department_id"})
    return joined.select("category_id", "category_name", "department_key").distinct()


def product_rows(items: DataFrame, dim_category: DataFrame, one_match: bool = True) -> DataFrame:
    """Products with their category key; the image is not in the sources and stays NULL."""
    named = items.where(F.col("product_id").isNotNull())
    own = ["product_id", "product_name", "product_card_id", "product_price"]
    seen = named.select(*own, "category_id").distinct()
    lookup = dim_category.select("category_id", "category_name", "department_key", "category_key")
    if one_match:
        lookup = first_match(lookup, ["category_id"], ["category_name", "department_key"])
    joined = left_lookup(seen, lookup, {"category_id": "category_id"})
    return joined.select(*own, "category_key").distinct()


def order_customers(orders: DataFrame) -> DataFrame:
    """What each order says of its customer."""
    return orders.select(
        "customer_id",
        "customer_fname",
        "customer_lname",
        "customer_segment",
        F.col("order_city").alias("customer_city"),
        F.col("order_state").alias("customer_state"),
        F.col("order_country").alias("customer_country"),
    )


def customer_rows(orders: DataFrame) -> DataFrame:
    """Customers by every place they ordered from; there is no filter on the customer id."""
    return order_customers(orders).distinct()


def order_places(orders: DataFrame) -> DataFrame:
    """The place of each order that has one, without coordinates."""
    none = F.lit(None).cast("decimal(10,6)")
    return orders.where(F.col("order_city").isNotNull()).select(
        F.col("order_city").alias("city"),
        F.col("order_state").alias("state"),
        F.col("order_country").alias("country"),
        none.alias("latitude"),
        none.alias("longitude"),
    )


def ship_places(shipments: DataFrame) -> DataFrame:
    """The place of each shipment that has one, with its coordinates if they are known."""
    return shipments.where(F.col("ship_city").isNotNull()).select(
        F.col("ship_city").alias("city"),
        F.col("ship_state").alias("state"),
        F.col("ship_country").alias("country"),
        "latitude",
        "longitude",
    )


def geography_rows(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Order places, which have no coordinates, and ship places, which may have them."""
    ordered, shipped = order_places(orders).distinct(), ship_places(shipments).distinct()
    return ordered.unionByName(shipped).distinct()


def date_rows(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """The dates that occur, not a calendar."""
    ordered = orders.select(F.col("order_date").alias("full_date")).distinct()
    return calendar(ordered.union(shipments.select("ship_date").distinct()))


def calendar(seen: DataFrame) -> DataFrame:
    """Each known date of `seen` (full_date) once, with its parts."""
    days = seen.select("full_date").where(F.col("full_date").isNotNull()).distinct()
    return days.withColumns(date_parts(F.col("full_date")))


def shipping_rows(shipments: DataFrame) -> DataFrame:
    """Combinations of the shipping flags with at least one flag set."""
    flags = ["shipping_mode", "delivery_status", "delivery_risk"]
    return shipments.select(*flags).where(F.coalesce(*flags).isNotNull()).distinct()


def to_layout(df: DataFrame, table: str) -> DataFrame:
    """A dimension in its table layout; columns no source fills are NULL."""
    return conform(df, WAREHOUSE[table])
