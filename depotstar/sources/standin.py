"""The warehouse's inputs made from the TPC-H-like tables.

The tables have the shape of the domain but other names; here they take the place of the flat CSV
and of the staging tables. Each function joins only what its columns need.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotstar.operators.joins import broadcast_limit, left_lookup
from depotstar.operators.staging import conform_staging
from depotstar.session import estimated_bytes

# Number of each product type, and delivery status by return flag.
TYPE_NUMBERS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
DELIVERY_STATUS = {"A": "Advance shipping", "N": "Shipping on time", "R": "Late delivery"}

MONEY = "decimal(10,2)"
RATE = "decimal(5,2)"
PLACE = "decimal(10,6)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _choice(c: Column, values: dict) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def item_id() -> Column:
    """The five columns that identify a line, as text."""
    return F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").cast("string"),
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """(nationkey, nation, region) of the 25 nations."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return joined.select("n_nationkey", "n_name", "r_name")


def _unique(df: DataFrame, key: str) -> DataFrame:
    """One row per key. The optimizer then knows that a left join to it adds no rows, and drops the
    join where none of its columns is used."""
    others = [F.min(c).alias(c) for c in df.columns if c != key]
    return df.groupBy(key).agg(*others)


def orders(spark: SparkSession, folder: str, now: datetime | None = None) -> DataFrame:
    """`stg_oms_orders`: one row per order, placed where its customer lives."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    known = left_lookup(o, c, {"o_custkey": "c_custkey"})
    placed = left_lookup(
        known, places(spark, folder), {"c_nationkey": "n_nationkey"}, keys_from=c
    )
    rows = placed.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_fname"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("n_name").alias("order_city"),
        F.col("n_name").alias("order_state"),
        F.col("r_name").alias("order_country"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )
    return conform_staging(rows, "stg_oms_orders", now)


def item_measures() -> dict[str, Column]:
    """Measures of a line. Profit is a stand-in: sales less discount less the list price."""
    sales = F.col("l_extendedprice").cast(MONEY)
    price = F.col("p_retailprice").cast(MONEY)
    rate = F.col("l_discount").cast(RATE)
    quantity = F.col("l_quantity").cast("int")
    discount = (sales * rate).cast(MONEY)
    profit = (sales - discount - price * quantity).cast(MONEY)
    return {
        "product_price": price,
        "quantity": quantity,
        "sales": sales,
        "discount": discount,
        "profit": profit,
        "discount_rate": rate,
        # Rounded by plain floating point steps, which every engine does alike.
        "profit_ratio": (
            F.floor(profit.cast("double") / sales.cast("double") * 100 + 0.5) / 100
        ).cast(RATE),
    }


def _joined(spark: SparkSession, folder: str, needs: set[str]) -> DataFrame:
    """lineitem with those of its related tables that are needed."""
    lines = df = table(spark, folder, "lineitem")
    if "part" in needs:
        df = left_lookup(df, table(spark, folder, "part"), {"l_partkey": "p_partkey"})
    if needs & {"orders", "customer", "places"}:
        o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
        # Too large to broadcast, orders find their customers first: so the lines are shuffled for
        # orders alone.
        first = estimated_bytes(o) > broadcast_limit(o)

        def placed(rows: DataFrame) -> DataFrame:
            if needs & {"customer", "places"}:
                rows = left_lookup(rows, c, {"o_custkey": "c_custkey"}, keys_from=o)
            if "places" in needs:
                rows = left_lookup(rows, places(spark, folder), {"c_nationkey": "n_nationkey"}, keys_from=c)
            return rows

        met = left_lookup(df, placed(o) if first else o, {"l_orderkey": "o_orderkey"}, keys_from=lines)
        df = met if first else placed(met)
    if "supplier" in needs:
        s = table(spark, folder, "supplier")
        df = left_lookup(df, s, {"l_suppkey": "s_suppkey"}, keys_from=lines)
    return df


def _flat_columns() -> dict[str, tuple[str, Column]]:
    """Source column -> (table it needs, expression)."""
    m = item_measures()
    known = F.col("s_nationkey") % 5 != 0
    return {
        "Order Id": ("", F.col("l_orderkey").cast("string")),
        "Order Item Id": ("", item_id()),
        "Customer Id": ("orders", F.col("o_custkey")),
        "Customer Fname": ("customer", F.col("c_name")),
        "Customer Segment": ("customer", F.col("c_mktsegment")),
        "Order City": ("places", F.col("n_name")),
        "Order State": ("places", F.col("n_name")),
        "Order Country": ("places", F.col("r_name")),
        "Market": ("places", F.col("r_name")),
        "order date (DateOrders)": ("orders", F.to_date("o_orderdate")),
        "Order Status": ("orders", F.col("o_orderstatus")),
        "Product Card Id": ("", F.col("l_partkey")),
        "Product Name": ("part", F.col("p_name")),
        "Product Price": ("part", m["product_price"]),
        "Order Item Quantity": ("", m["quantity"]),
        "Sales": ("", m["sales"]),
        "Order Item Discount": ("", m["discount"]),
        "Order Item Discount Rate": ("", m["discount_rate"]),
        "Benefit per order": ("part", m["profit"]),
        "Order Profit Per Order": ("part", m["profit"]),
        "Order Item Profit Ratio": ("part", m["profit_ratio"]),
        "Shipping Mode": ("orders", F.col("o_orderpriority")),
        "shipping date (DateOrders)": ("", F.to_date("l_shipdate")),
        "Delivery Status": ("", _choice(F.col("l_returnflag"), DELIVERY_STATUS)),
        "Late_delivery_risk": ("", F.when(F.col("l_linestatus") == "O", 1).otherwise(0)),
        "Latitude": ("supplier", F.when(known, (F.col("s_nationkey") * 1.5 - 20).cast(PLACE))),
        "Longitude": ("supplier", F.when(known, (F.col("s_nationkey") * 2.25 - 30).cast(PLACE))),
    }


def flat_columns() -> list[str]:
    """The source columns that the tables can fill."""
    return list(_flat_columns())


def flat_lines(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """The flat source, one row per order line, with the wanted columns under their CSV names."""
    known = _flat_columns()
    df = _joined(spark, folder, {known[c][0] for c in columns})
    return df.select(*[known[c][1].alias(c) for c in columns])


def items(spark: SparkSession, folder: str, now: datetime | None = None) -> DataFrame:
    """`stg_oms_order_items`: the category is the (brand, type) pair, the department the type."""
    return items_of(table(spark, folder, "lineitem"), table(spark, folder, "part"), now)


def items_of(l: DataFrame, p: DataFrame, now: datetime | None = None) -> DataFrame:
    """As `items`, of given lines and parts."""
    type_number = _choice(F.col("p_type"), TYPE_NUMBERS)
    brand_number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    rows = left_lookup(l, p, {"l_partkey": "p_partkey"}).select(
        item_id().alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_partkey").cast("string").alias("product_card_id"),
        F.col("p_name").alias("product_name"),
        *[c.alias(n) for n, c in item_measures().items()],
        (brand_number * 10 + type_number).alias("category_id"),
        F.concat_ws(" ", "p_brand", "p_type").alias("category_name"),
        type_number.alias("department_id"),
        F.col("p_type").alias("department_name"),
    )
    return conform_staging(rows, "stg_oms_order_items", now)


def shipments(spark: SparkSession, folder: str, now: datetime | None = None) -> DataFrame:
    """`stg_slms_shipments`: one per line, from the supplier's place; every 5th has no position."""
    l, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    # Joined last, orders drop out of the plan where only the place or the date is asked for.
    p = _unique(places(spark, folder), "n_nationkey")
    s = _unique(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    nation = F.col("s_nationkey")
    known = nation % 5 != 0
    rows = left_lookup(l, s, {"l_suppkey": "s_suppkey"})
    rows = left_lookup(rows, p, {"s_nationkey": "n_nationkey"}, keys_from=s)
    rows = left_lookup(rows, o, {"l_orderkey": "o_orderkey"}, keys_from=l).select(
        item_id().alias("shipment_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderpriority").alias("shipping_mode"),
        F.to_date("l_shipdate").alias("ship_date"),
        _choice(F.col("l_returnflag"), DELIVERY_STATUS).alias("delivery_status"),
        F.when(F.col("l_linestatus") == "O", "1").otherwise("0").alias("delivery_risk"),
        F.col("n_name").alias("ship_city"),
        F.col("n_name").alias("ship_state"),
        F.col("r_name").alias("ship_country"),
        F.when(known, (nation * 1.5 - 20).cast(PLACE)).alias("latitude"),
        F.when(known, (nation * 2.25 - 30).cast(PLACE)).alias("longitude"),
    )
    return conform_staging(rows, "stg_slms_shipments", now)


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as untidy CSV text, every defect planted by a rule on the order key.

    Among them: masked, missing and padded texts, numbers and dates that are none, empty columns,
    and a second copy of every tenth order.
    """
    k = F.col("o_orderkey")

    def every(n: int) -> Column:
        return k % n == 0

    sales = (
        F.when(every(53), "x")
        .when(every(59), "-5")
        .when(every(61), " 1e3 ")
        .when(every(67), None)
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    )
    ordered = (
        F.when(every(73), "31/12/2018 1:00")
        .when(every(79), None)
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm"))
    )
    none = F.lit(None).cast("string")
    rows = table(spark, folder, "orders").select(
        F.when(~every(97), k.cast("string")).alias("Order Id"),
        F.when(~every(89), F.col("o_custkey").cast("string")).alias("Customer Id"),
        F.concat(F.lit(" Customer "), F.col("o_custkey"), F.lit("\t")).alias("Customer Fname"),
        F.when(every(2), "XXXXXXXXX")
        .otherwise(F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@example.com")))
        .alias("Customer Email"),
        F.lit("XXXXXXXXX").alias("Customer Password"),
        F.when(~every(83), F.concat(F.lit("  "), "o_orderpriority")).alias("Product Name"),
        sales.alias("Sales"),
        F.when(every(71), "-1").otherwise((k % 7).cast("string")).alias("Order Item Quantity"),
        ordered.alias("order date (DateOrders)"),
        F.concat("o_orderstatus", F.lit(" ")).alias("Delivery Status"),
        none.alias("Unnamed: 3"),
        none.alias("Empty"),
        F.explode(F.sequence(F.lit(1), F.when(every(10), 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def mixed_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as CSV text with columns of every type, each fifth order twice, written otherwise.

    A single row of all makes a column of whole numbers a column of texts.
    """
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    again = F.col("again")
    orders = table(spark, folder, "orders")
    last = orders.agg(F.max("o_orderkey").alias("last"))
    doubled = orders.select("*", F.explode(F.when(k % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return doubled.crossJoin(F.broadcast(last)).select(
        F.concat(F.when(again == 1, F.lit(" +")).otherwise(F.lit("")), k.cast("string")).alias("Order Id"),
        F.concat(price, F.when(again == 1, F.lit("00")).otherwise(F.lit(""))).alias("Price"),
        F.when(k % 2 == 0, F.concat((k % 100).cast("string"), F.lit("e-2")))
        .otherwise(F.concat((k % 100).cast("string"), F.lit("E-2"))).alias("Ratio"),
        F.when(again == 1, F.lit("TRUE")).otherwise(F.lit("true")).alias("Sent"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Day"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("Placed"),
        F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("Two formats"),
        F.concat(F.lit("10000000000000000"), F.lpad(k.cast("string"), 12, "0")).alias("Long number"),
        F.when(k == F.col("last"), F.lit("x")).otherwise(F.col("o_custkey").cast("string")).alias("Nearly whole"),
        F.when(k % 3 == 0, F.lit("NA")).otherwise(F.lit("None")).alias("Nothing"),
        F.col("o_orderpriority").alias("Priority"),
    )
