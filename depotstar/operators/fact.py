"""The order item fact.

Each lookup is made at the coarsest grain that has its key: customer place at customer grain, order
date and both geographies at order grain, ship date and flags at shipment grain. Left joins in a
chain commute in this way, so rows and multiplicities are those of joining every dimension to the
items, while only two joins (orders, shipments) touch the items in full width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotstar.functions import compact
from depotstar.operators import joins
from depotstar.operators.dedupe import first_match
from depotstar.operators.joins import left_lookup
from depotstar.schemas import WAREHOUSE
from depotstar.session import fresh_path, source_bytes, stage_at

_PLACE = ["city", "state", "country"]
_FLAGS = ["shipping_mode", "delivery_status", "delivery_risk"]
_CUSTOMER = ["customer_fname", "customer_lname", "customer_segment"]
_MEASURES = [f for f in WAREHOUSE["order_items"].fields if not f.name.endswith("_key")]
_WORD = "_measures"
# Bits of the keys that travel in one word; a dimension numbers its rows from 1.
_PACKED = {
    "_order": {"customer_key": 40, "order_date_key": 22},
    "_places": {"customer_geography_key": 31, "order_geography_key": 31},
    "_shipment": {"shipping_key": 40, "shipping_date_key": 22},
}
# Months since the year 0, in the place of year and month.
MONTH = "_month"


def geography_lookup(dim_geography: DataFrame, one_match: bool) -> DataFrame:
    """Place -> key; one row per place has coordinates if any does, the smallest ones."""
    rows = dim_geography.select(*_PLACE, "latitude", "longitude", "geography_key")
    if one_match:
        bare = F.col("latitude").isNull() | F.col("longitude").isNull()
        rows = first_match(rows, _PLACE, [bare, "latitude", "longitude"])
    return rows.select(*_PLACE, "geography_key")


def customer_lookup(orders: DataFrame, dim_customer: DataFrame, one_match: bool) -> DataFrame:
    """Customer id -> key and place.

    In `one_match` the row taken is that of the latest order date, then of the greatest order id
    (as a number where it is one).
    """
    place = [f"customer_{c}" for c in _PLACE]
    rows = dim_customer.select("customer_id", *_CUSTOMER, *place, "customer_key")
    if not one_match:
        return rows.select("customer_id", "customer_key", *place)
    return latest_key(latest_attributes(orders), rows)


def latest_attributes(orders: DataFrame) -> DataFrame:
    """What the latest order of each customer says of it."""
    place = [f"customer_{c}" for c in _PLACE]
    seen = orders.select(
        "customer_id",
        *_CUSTOMER,
        *[F.col(f"order_{c}").alias(f"customer_{c}") for c in _PLACE],
        F.struct(
            "order_date", F.col("order_id").try_cast("bigint").alias("n"), "order_id"
        ).alias("_at"),
    ).where(F.col("customer_id").isNotNull())
    attributes = F.struct(*_CUSTOMER, *place)
    return (
        seen.groupBy("customer_id")
        .agg(F.max_by(attributes, F.col("_at")).alias("_row"))
        .select("customer_id", "_row.*")
    )


def latest_key(latest: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customer id -> key and place of the dimension row that has the latest attributes."""
    place = [f"customer_{c}" for c in _PLACE]
    rows = dim_customer.select("customer_id", *_CUSTOMER, *place, "customer_key")
    same = {c: c for c in ["customer_id", *_CUSTOMER, *place]}
    return left_lookup(latest, rows, same, null_safe=True).select(
        "customer_id", "customer_key", *place
    )


def product_lookup(dim_product: DataFrame, one_match: bool) -> DataFrame:
    rows = dim_product.where(F.col("product_id").isNotNull())
    if one_match:
        prefer = ["product_name", "product_card_id", "product_price", "category_key"]
        rows = rows.select("product_id", *prefer, "product_key")
        rows = first_match(rows, ["product_id"], prefer)
    return rows.select("product_id", "product_key")


def shipping_lookup(dim_shipping: DataFrame) -> DataFrame:
    return dim_shipping.select(*_FLAGS, "shipping_key")


def customer_places(customers: DataFrame, geography: DataFrame, one_match: bool = True) -> DataFrame:
    """Customer id -> key and key of the customer's place."""
    return left_lookup(
        customers,
        geography.withColumnRenamed("geography_key", "customer_geography_key"),
        {f"customer_{c}": c for c in _PLACE},
        null_safe=one_match,
    ).select("customer_id", "customer_key", "customer_geography_key")


def order_keys(
    orders: DataFrame,
    dims: dict[str, DataFrame],
    one_match: bool,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Order id with the four keys that depend on the order.

    `customers` is the result of `customer_places` if it is known, so that `orders` need not hold all
    orders of a customer.
    """
    geography = geography_lookup(dims["dim_geography"], one_match)
    if customers is None:
        found = customer_lookup(orders, dims["dim_customer"], one_match)
        customers = customer_places(found, geography, one_match)
    dates = dims["dim_date"].select("full_date", F.col("date_key").alias("order_date_key"))
    own = orders.select("order_id", "customer_id", "order_date", *[f"order_{c}" for c in _PLACE])
    own = left_lookup(own, dates, {"order_date": "full_date"}, keys_from=orders)
    own = left_lookup(
        own,
        geography.withColumnRenamed("geography_key", "order_geography_key"),
        {f"order_{c}": c for c in _PLACE},
        null_safe=one_match,
        keys_from=orders,
    )
    own = left_lookup(own, customers, {"customer_id": "customer_id"}, keys_from=orders)
    return own.select(
        "order_id", "customer_key", "order_date_key", "customer_geography_key",
        "order_geography_key", F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
    )


def shipment_keys(shipments: DataFrame, dims: dict[str, DataFrame], one_match: bool) -> DataFrame:
    """Shipment id with the two keys that depend on the shipment.

    In `one_match` a repeated id keeps its earliest known date, then its smallest known flags. Keys
    follow the order of what they stand for, so the smallest pair of keys is looked for: packed into
    one number, which the hash aggregate can hold, since a date key never exceeds 22 bits. What is
    not known has the greatest number.
    """
    own = shipments.select("shipment_id", "ship_date", *_FLAGS)
    dates = dims["dim_date"].select("full_date", F.col("date_key").alias("shipping_date_key"))
    own = left_lookup(own, dates, {"ship_date": "full_date"}, keys_from=shipments)
    own = left_lookup(
        own,
        shipping_lookup(dims["dim_shipping"]),
        {c: c for c in _FLAGS},
        null_safe=one_match,
        keys_from=shipments,
    )
    if not one_match:
        return own.select("shipment_id", "shipping_date_key", "shipping_key")
    no_date, no_flags = F.lit((1 << 22) - 1), F.lit((1 << 40) - 1)
    packed = F.shiftleft(F.coalesce("shipping_date_key", no_date).cast("bigint"), 40).bitwiseOR(
        F.coalesce("shipping_key", no_flags).cast("bigint")
    )
    least = own.groupBy("shipment_id").agg(F.min(packed).alias("_keys"))
    return least.select(
        "shipment_id",
        F.nullif(F.shiftright("_keys", 40), no_date).alias("shipping_date_key"),
        F.nullif(F.col("_keys").bitwiseAND(no_flags), no_flags).alias("shipping_key"),
    )


def order_items(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    dims: dict[str, DataFrame],
    one_match: bool = True,
    customers: DataFrame | None = None,
) -> DataFrame:
    """The fact: seven keys, six measures, the item's business key, and the order year and month.

    With `one_match` every lookup finds at most one row, so there is one fact row per item; the
    staged orders have one row per order already. Without, each lookup may multiply the rows, as
    plain joins to the dimensions do.
    """
    rows = packed_order_items(items, orders, shipments, dims, one_match, customers)
    return unpacked_order_items(rows)


def packed_order_items(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    dims: dict[str, DataFrame],
    one_match: bool = True,
    customers: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """The rows of `order_items` before their id and measures are unpacked.

    The items are shuffled by order and by id, and once more if they are placed by month, so what
    they only carry along is packed before the first of these. Large tables are staged, at `path`,
    between the two wide joins: the shuffle files of the first are gone when the second needs room.
    """
    by_order = order_keys(orders, dims, one_match, customers).select(
        compact.packed_text(F.col("order_id")).alias("order_id"), *[_packed(w) for w in ("_order", "_places")],
        (F.col("order_year") * 12 + F.col("order_month") - 1).alias(MONTH),
    )
    items = items.withColumns({c: compact.packed_text(F.col(c)) for c in ("order_item_id", "order_id")})
    shipments = shipments.withColumn("shipment_id", compact.packed_text(F.col("shipment_id")))
    measures = items.select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("quantity").alias("order_item_quantity"),
        "sales",
        F.col("discount").alias("order_item_discount"),
        F.col("profit").alias("order_item_profit"),
        F.col("discount_rate").alias("order_item_discount_rate"),
        F.col("profit_ratio").alias("order_item_profit_ratio"),
    ).select("order_item_id", "order_id", "product_id", *compact.packed_numbers(_MEASURES, _WORD))
    products = product_lookup(dims["dim_product"], one_match)
    by_shipment = shipment_keys(shipments, dims, one_match).select("shipment_id", _packed("_shipment"))
    rows = left_lookup(measures, products, {"product_id": "product_id"}, keys_from=items)
    rows = left_lookup(rows, by_shipment, {"order_item_id": "shipment_id"}, keys_from=items)
    if source_bytes(items) >= joins.SKEW_FLOOR:
        rows = stage_at(rows, path or fresh_path(items.sparkSession, "items_by_id"))
    # Last, so that the items of an order leave the join side by side, with the same keys.
    rows = left_lookup(rows, by_order, {"order_id": "order_id"}, keys_from=items)
    return rows.drop("order_id", "product_id")


def repacked(fact: DataFrame, plain: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the fact packed again, as `unpacked_order_items` takes them, for one more shuffle.

    The columns `plain` stay beside, for lookups.
    """
    month = F.col("order_year") * 12 + F.col("order_month") - 1
    return fact.select(
        compact.packed_text(F.col("order_item_id")).alias("order_item_id"), "product_key",
        *[_packed(w) for w in _PACKED], *compact.packed_numbers(_MEASURES, _WORD), month.alias(MONTH), *plain,
    )


def _packed(word: str) -> Column:
    return compact.packed_keys(_PACKED[word]).alias(word)


def unpacked_order_items(rows: DataFrame, beside: list[str] | None = None) -> DataFrame:
    """What `packed_order_items` packed, in the layout of the fact, then the columns `beside`."""
    own = {
        "order_item_id": compact.unpacked_text(F.col("order_item_id")),
        "order_year": F.floor(F.col(MONTH) / 12).cast("int"),
        "order_month": F.pmod(F.col(MONTH), F.lit(12)) + 1,
    }
    for word, bits in _PACKED.items():
        own |= compact.unpacked_keys(F.col(word), bits)
    whole = rows.withColumns(own | compact.unpacked_numbers(_MEASURES, _WORD))
    return whole.select(
        "order_item_id", *WAREHOUSE["order_items"].fieldNames(), "order_year", "order_month",
        *[F.col(f"`{c}`") for c in beside or []],
    )
