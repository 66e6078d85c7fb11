"""How often the lookups of the fact match more than one dimension row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotstar.operators.joins import left_lookup
from depotstar.operators.sets import union_all

# Lookup -> (dimension, columns it is looked up by).
LOOKUPS = {
    "customer": ("dim_customer", ["customer_id"]),
    "product": ("dim_product", ["product_id"]),
    "category": ("dim_category", ["category_id"]),
    "department": ("dim_department", ["department_id"]),
    "date": ("dim_date", ["full_date"]),
    "geography": ("dim_geography", ["city", "state", "country"]),
    "shipping": ("dim_shipping", ["shipping_mode", "delivery_status", "delivery_risk"]),
}


def rows_per_key(dim: DataFrame, key: list[str], name: str = "n") -> DataFrame:
    """Dimension rows per lookup key. Keys with a NULL part are left out: `=` never finds them."""
    return dim.select(*key).dropna("any").groupBy(*key).agg(F.count(F.lit(1)).alias(name))


def fan_out(dims: dict[str, DataFrame]) -> DataFrame:
    """Per lookup: keys, keys with several rows, and the most rows of one key."""

    def one(lookup: str, dim: str, key: list[str]) -> DataFrame:
        return rows_per_key(dims[dim], key).agg(
            F.lit(lookup).alias("lookup"),
            F.count(F.lit(1)).alias("lookup_keys"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
            F.coalesce(F.max("n"), F.lit(0)).alias("most_rows"),
        )

    parts = [one(k, d, c) for k, (d, c) in LOOKUPS.items() if d in dims]
    return union_all(parts)


def fan_out_totals(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    dims: dict[str, DataFrame],
    by: list[str],
) -> DataFrame:
    """Row count and sums of the fact with multiplied rows, without multiplying any.

    An item yields as many rows as the product of its lookups' matches, so its measures are
    weighted by that number. `by` names columns of the orders or shipments.
    """
    place = ["city", "state", "country"]

    def weight(
        df: DataFrame, dim: str, on: dict[str, str], name: str, source: DataFrame | None = None
    ) -> DataFrame:
        found = left_lookup(
            df, rows_per_key(dims[dim], list(on.values()), name), on, keys_from=source
        )
        return found.withColumn(name, F.coalesce(name, F.lit(1)))

    at = {f"customer_{c}": c for c in place}
    customers = weight(
        dims["dim_customer"].select("customer_id", *at), "dim_geography", at, "places"
    )
    customers = customers.groupBy("customer_id").agg(F.sum("places").alias("w_customer"))

    o = orders.select(
        "order_id", "customer_id", "order_date", *[f"order_{c}" for c in place],
        *[c for c in by if c in orders.columns and c not in ("order_id", "order_date")],
    )
    o = left_lookup(o, customers, {"customer_id": "customer_id"}, keys_from=orders)
    o = weight(o, "dim_geography", {f"order_{c}": c for c in place}, "w_place", orders)
    o = weight(o, "dim_date", {"order_date": "full_date"}, "w_date", orders)
    w_order = F.coalesce("w_customer", F.lit(1)) * F.col("w_place") * F.col("w_date")
    o = o.withColumn("w_order", w_order)
    of_order = [c for c in by if c in o.columns and c != "order_id"]

    flags = ["shipping_mode", "delivery_status", "delivery_risk"]
    s = shipments.select(
        "shipment_id", "ship_date", *flags,
        *[c for c in by if c in shipments.columns and c not in ("ship_date", *flags)],
    )
    s = weight(s, "dim_date", {"ship_date": "full_date"}, "w_date", shipments)
    s = weight(s, "dim_shipping", {c: c for c in flags}, "w_flags", shipments)
    s = s.withColumn("w_shipment", F.col("w_date") * F.col("w_flags"))
    of_shipment = [c for c in by if c in s.columns and c not in of_order]

    measures = ["quantity", "sales", "discount", "profit"]
    i = items.select("order_item_id", "order_id", "product_id", *measures)
    i = weight(i, "dim_product", {"product_id": "product_id"}, "w_product", items)
    by_order = o.select("order_id", "w_order", *of_order)
    by_shipment = s.select("shipment_id", "w_shipment", *of_shipment)
    i = left_lookup(i, by_order, {"order_id": "order_id"}, keys_from=items)
    i = left_lookup(i, by_shipment, {"order_item_id": "shipment_id"}, keys_from=items)
    one = F.lit(1)
    w = F.col("w_product") * F.coalesce("w_order", one) * F.coalesce("w_shipment", one)
    i = i.withColumn("w", w)

    def total(c: str) -> F.Column:
        return F.sum(F.col(c).cast("decimal(20,2)") * F.col("w").cast("decimal(18,0)"))

    return i.groupBy(*by).agg(
        F.sum("w").alias("fact_rows"),
        F.sum(F.col("quantity") * F.col("w")).alias("quantity"),
        total("sales").alias("sales"),
        total("discount").alias("discount"),
        total("profit").alias("profit"),
    )
