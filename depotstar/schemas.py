"""Table layouts, source mappings and the conform-to-layout step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import parse_date, strip, to_number
from depotstar.functions.sqltext import name
from depotstar.functions.values import SOURCE_DATE_FORMAT
from depotstar.layouts import read_layout

# ---------------------------------------------------------------------------------------------
# Source column -> staging column, one mapping per staging table.
ORDER_MAPPING = {
    "Order Id": "order_id",
    "Customer Id": "customer_id",
    "Customer Fname": "customer_fname",
    "Customer Lname": "customer_lname",
    "Customer Segment": "customer_segment",
    "Order City": "order_city",
    "Order State": "order_state",
    "Order Country": "order_country",
    "order date (DateOrders)": "order_date",
    "Order Status": "order_status",
}
ITEM_MAPPING = {
    "Order Item Id": "order_item_id",
    "Order Id": "order_id",
    "Product Card Id": "product_id",
    "Order Item Cardprod Id": "product_card_id",
    "Product Name": "product_name",
    "Product Price": "product_price",
    "Order Item Quantity": "quantity",
    "Sales": "sales",
    "Order Item Discount": "discount",
    "Order Profit Per Order": "profit",
    "Order Item Discount Rate": "discount_rate",
    "Order Item Profit Ratio": "profit_ratio",
    "Category Id": "category_id",
    "Category Name": "category_name",
    "Department Id": "department_id",
    "Department Name": "department_name",
}
SHIPMENT_MAPPING = {
    "Order Item Id": "shipment_id",
    "Order Id": "order_id",
    "Shipping Mode": "shipping_mode",
    "shipping date (DateOrders)": "ship_date",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "delivery_risk",
    "Order City": "ship_city",
    "Order State": "ship_state",
    "Order Country": "ship_country",
    "Latitude": "latitude",
    "Longitude": "longitude",
}
DATE_COLUMNS = ["order date (DateOrders)", "shipping date (DateOrders)"]

# Layouts of the staging tables.
STAGING = {
    "stg_oms_orders": read_layout(
        "order_id STRING, customer_id BIGINT, customer_fname STRING, customer_lname STRING, "
        "customer_segment STRING, order_city STRING, order_state STRING, order_country STRING, "
        "order_date DATE, order_status STRING, load_timestamp TIMESTAMP, source_system STRING"
    ),
    "stg_oms_order_items": read_layout(
        "order_item_id STRING, order_id STRING, product_id BIGINT, product_card_id STRING, "
        "product_name STRING, product_price DECIMAL(10,2), quantity INT, sales DECIMAL(10,2), "
        "discount DECIMAL(10,2), profit DECIMAL(10,2), discount_rate DECIMAL(5,2), "
        "profit_ratio DECIMAL(5,2), category_id BIGINT, category_name STRING, "
        "department_id BIGINT, department_name STRING, load_timestamp TIMESTAMP, "
        "source_system STRING"
    ),
    "stg_slms_shipments": read_layout(
        "shipment_id STRING, order_id STRING, shipping_mode STRING, ship_date DATE, "
        "delivery_date DATE, delivery_status STRING, delivery_risk STRING, ship_city STRING, "
        "ship_state STRING, ship_country STRING, latitude DECIMAL(10,6), longitude DECIMAL(10,6), "
        "load_timestamp TIMESTAMP, source_system STRING"
    ),
}

# Layouts of the warehouse tables.
WAREHOUSE = {
    "dim_customer": read_layout(
        "customer_key BIGINT, customer_id BIGINT, customer_fname STRING, customer_lname STRING, "
        "customer_segment STRING, customer_city STRING, customer_state STRING, "
        "customer_country STRING"
    ),
    "dim_product": read_layout(
        "product_key BIGINT, category_key BIGINT, product_id BIGINT, product_name STRING, "
        "product_card_id STRING, product_price DECIMAL(10,2), product_image STRING"
    ),
    "dim_category": read_layout(
        "category_key BIGINT, category_id BIGINT, category_name STRING, department_key BIGINT"
    ),
    "dim_department": read_layout(
        "department_key BIGINT, department_id BIGINT, department_name STRING"
    ),
    "dim_date": read_layout(
        "date_key BIGINT, full_date DATE, day_of_week INT, month_number INT, quarter_number INT, "
        "year INT, is_weekend BOOLEAN"
    ),
    "dim_geography": read_layout(
        "geography_key BIGINT, city STRING, state STRING, country STRING, region STRING, "
        "market STRING, latitude DECIMAL(10,6), longitude DECIMAL(10,6)"
    ),
    "dim_shipping": read_layout(
        "shipping_key BIGINT, shipping_mode STRING, delivery_status STRING, delivery_risk STRING"
    ),
    "order_items": read_layout(
        "customer_key BIGINT, order_date_key BIGINT, shipping_date_key BIGINT, "
        "customer_geography_key BIGINT, order_geography_key BIGINT, shipping_key BIGINT, "
        "product_key BIGINT, order_item_quantity INT, sales DECIMAL(10,2), "
        "order_item_discount DECIMAL(10,2), order_item_profit DECIMAL(10,2), "
        "order_item_discount_rate DECIMAL(5,2), order_item_profit_ratio DECIMAL(5,2)"
    ),
}

# Foreign keys of the fact (column, dimension, dimension key) and text lengths.
STAR_FOREIGN_KEYS = [
    ("customer_key", "dim_customer", "customer_key"),
    ("order_date_key", "dim_date", "date_key"),
    ("shipping_date_key", "dim_date", "date_key"),
    ("customer_geography_key", "dim_geography", "geography_key"),
    ("order_geography_key", "dim_geography", "geography_key"),
    ("shipping_key", "dim_shipping", "shipping_key"),
    ("product_key", "dim_product", "product_key"),
]
TEXT_LIMITS = {
    "product_name": 100, "product_card_id": 20, "product_image": 255, "source_system": 10,
}
DEFAULT_TEXT_LIMIT = 50
# ---------------------------------------------------------------------------------------------


def text_limit(column: str) -> int:
    """Longest text the warehouse layout allows in a column."""
    return TEXT_LIMITS.get(column, DEFAULT_TEXT_LIMIT)


def assign(c: Column, have: T.DataType, want: T.DataType, date_format: str) -> Column:
    """Conversion on load. Text that does not fit becomes NULL; typed values are cast."""
    if not isinstance(have, T.StringType) or isinstance(want, T.StringType):
        return c.cast(want)
    if isinstance(want, T.DateType):
        return parse_date(c, date_format)
    if isinstance(want, T.IntegralType):
        return F.coalesce(strip(c).try_cast(want), to_number(c).try_cast(want))
    return strip(c).try_cast(want)


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: dict[str, Column | str] | None = None,
    date_format: str = SOURCE_DATE_FORMAT,
) -> DataFrame:
    """Bring `df` to `schema`: order, types, and NULL or a default for what it lacks.

    A default replaces an absent column only, as a table default does; a NULL that was given stays.
    """
    defaults = defaults or {}
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        if f.name not in have:
            d = defaults.get(f.name)
            return (d if isinstance(d, Column) else F.lit(d)).cast(f.dataType).alias(f.name)
        c = F.col(name(f.name))
        if have[f.name] == f.dataType:
            return c
        return assign(c, have[f.name], f.dataType, date_format).alias(f.name)

    return df.select([column(f) for f in schema.fields])


def cast_failures(
    df: DataFrame, schema: T.StructType, date_format: str = SOURCE_DATE_FORMAT
) -> DataFrame:
    """(column_name, failed): texts of `df` that `conform` turns to NULL, for columns with any."""
    have = {f.name: f.dataType for f in df.schema.fields}
    checked = [
        f for f in schema.fields
        if isinstance(have.get(f.name), T.StringType) and not isinstance(f.dataType, T.StringType)
    ]
    if not checked:
        return df.sparkSession.createDataFrame([], "column_name string, failed bigint")
    counts = df.agg(
        *[
            F.count_if(
                (strip(F.col(name(f.name))) != "")
                & assign(F.col(name(f.name)), have[f.name], f.dataType, date_format).isNull()
            ).alias(f"_{i}")
            for i, f in enumerate(checked)
        ]
    )
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"_{i}").alias("failed")) for i, f in enumerate(checked)]
    return counts.select(F.inline(F.array(*rows))).where("failed > 0")
