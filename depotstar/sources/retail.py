"""Tables of the retail system made from the TPC-H-like tables, as input for the audits.

The rules below break some of the declared constraints on purpose: phone numbers and bar codes
repeat, balances are negative, tiers and statuses lie outside their domains, some stores, users and
items are unknown. Columns that are left out show up in the audit as not checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depotstar.sources.standin import MONEY, table

SOURCES = {
    "CUSTOMER": ("customer", [
        "c_custkey AS customer_id",
        "concat('+', CAST(c_custkey % 1400 AS STRING)) AS phone_number",
        "c_name AS full_name",
        "CASE WHEN c_custkey % 3 <> 0 THEN concat(c_name, '@example.com') END AS email",
        "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Silver' WHEN 'MACHINERY' THEN 'Gold' "
        "WHEN 'FURNITURE' THEN 'Diamond' ELSE 'Bronze' END AS membership_tier",
        "CAST(floor(c_acctbal) AS INT) AS total_points",
    ]),
    "STORE": ("supplier", [
        "s_suppkey AS store_id",
        "concat('S', CAST(s_suppkey AS STRING)) AS store_code",
        "s_name AS store_name",
        "CASE WHEN s_nationkey <> 3 THEN concat('City ', CAST(s_nationkey AS STRING)) END AS city",
    ]),
    "PRODUCT": ("part", [
        "p_partkey AS product_id",
        "concat('SKU-', CAST(p_partkey AS STRING)) AS sku",
        "concat('BC-', CAST(p_partkey % 1900 AS STRING)) AS barcode",
        "p_name AS product_name",
        "CASE p_type WHEN 'ECONOMY' THEN 'Men' WHEN 'LARGE' THEN 'Women' WHEN 'SMALL' THEN 'Kids' "
        "ELSE p_type END AS category",
        f"CAST(p_retailprice AS {MONEY}) AS base_price",
    ]),
    "PRODUCT_VARIANT": ("part", [
        "p_partkey AS variant_id",
        "p_partkey - p_partkey % 4 AS product_id",
        "CAST(p_size % 3 AS STRING) AS size",
        "split_part(p_name, ' ', 1) AS color",
        "concat('V-', CAST(p_partkey AS STRING)) AS variant_sku",
    ]),
    "TRANSACTION": ("orders", [
        "o_orderkey AS transaction_id",
        "concat('T', CAST(o_orderkey AS STRING)) AS transaction_number",
        "CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS customer_id",
        "o_custkey % 120 AS store_id",
        "CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey % 115 END AS user_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 2 END AS promotion_id",
        "CAST(o_totalprice AS decimal(12,2)) AS subtotal",
        "CAST(o_orderkey % 9 AS decimal(10,2)) AS discount_amount",
        "CAST(0 AS decimal(10,2)) AS tax_amount",
        "CAST(o_totalprice AS decimal(12,2)) AS total_amount",
        "CAST(o_orderkey % 5 - 1 AS INT) AS loyalty_points_earned",
        "CAST(0 AS INT) AS loyalty_points_used",
        "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Returned' ELSE 'Open' END "
        "AS status",
    ]),
    "TRANSACTION_ITEM": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS transaction_item_id",
        "l_orderkey AS transaction_id",
        "l_partkey AS variant_id",
        "CAST(l_quantity AS INT) - 2 AS quantity",
        f"CAST(l_extendedprice AS {MONEY}) AS unit_price",
        f"CAST(l_discount * 100 - 1 AS {MONEY}) AS discount_amount",
        f"CAST(l_extendedprice AS {MONEY}) AS line_total",
    ]),
    "PAYMENT": ("orders", [
        "o_orderkey AS payment_id",
        "o_orderkey AS transaction_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN 'Card' "
        "WHEN '3-MEDIUM' THEN 'QR' ELSE 'Cheque' END AS payment_method",
        "CAST(o_totalprice AS decimal(12,2)) AS amount_paid",
    ]),
    "LOYALTY_POINT": ("orders", [
        "o_orderkey AS point_id",
        "o_custkey AS customer_id",
        "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey END AS transaction_id",
        "CAST(o_orderkey % 13 AS INT) AS points_earned",
        "CAST(o_orderkey % 17 AS INT) AS points_used",
        "CAST(o_orderkey % 13 - o_orderkey % 17 AS INT) AS points_balance",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'Earn' ELSE 'Redeem' END AS transaction_type",
    ]),
    "USER": ("supplier", [
        "s_suppkey AS user_id",
        "concat('u', CAST(s_suppkey % 90 AS STRING)) AS username",
        "'x' AS password_hash",
        "s_name AS full_name",
        "CASE WHEN s_suppkey % 7 <> 0 THEN concat(CAST(s_suppkey % 95 AS STRING), '@example.com') END AS email",
        "CASE s_nationkey % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Sales' ELSE 'Guest' END AS role",
    ]),
    "INVENTORY": ("part", [
        "p_partkey AS inventory_id",
        "p_partkey - p_partkey % 2 AS variant_id",
        "p_size AS store_id",
        "p_size - 3 AS quantity_on_hand",
        "p_size % 4 - 1 AS reserved_quantity",
        "p_size - 5 AS available_quantity",
    ]),
    "STOCK_ADJUSTMENT": ("orders", [
        "o_orderkey AS adjustment_id",
        "o_custkey * 2 AS inventory_id",
        "o_custkey % 130 AS user_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Initial' WHEN '2-HIGH' THEN 'Addition' "
        "WHEN '3-MEDIUM' THEN 'Transfer' ELSE 'Loss' END AS adjustment_type",
        "CAST(o_orderkey % 7 - 3 AS INT) AS quantity_change",
    ]),
    "STOCK_TRANSFER": ("orders", [
        "o_orderkey AS transfer_id",
        "o_custkey % 110 AS from_store_id",
        "o_orderkey % 110 AS to_store_id",
        "o_custkey % 130 AS user_id",
        "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Lost' END AS status",
    ]),
    "STOCK_TRANSFER_ITEM": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS transfer_item_id",
        "l_orderkey + l_linenumber % 2 AS transfer_id",
        "l_partkey + l_linenumber AS variant_id",
        "CAST(l_quantity AS INT) - 1 AS quantity",
    ]),
    "PROMOTION": ("part", [
        "p_partkey AS promotion_id",
        "concat('P', CAST(p_partkey % 1900 AS STRING)) AS promotion_code",
        "p_name AS promotion_name",
        "CASE p_size % 3 WHEN 0 THEN 'Percentage' WHEN 1 THEN 'Fixed Amount' ELSE 'Gift' END AS discount_type",
        "CAST(p_size - 2 AS decimal(10,2)) AS discount_value",
        "CAST(p_size - 3 AS decimal(10,2)) AS min_purchase_amount",
        "CAST('2024-01-10 00:00:00' AS TIMESTAMP) AS start_date",
        "CASE WHEN p_size % 5 = 0 THEN CAST('2024-01-01 00:00:00' AS TIMESTAMP) "
        "ELSE CAST('2024-02-01 00:00:00' AS TIMESTAMP) END AS end_date",
    ]),
    "PROMOTION_PRODUCT": ("part", [
        "p_partkey AS promotion_product_id",
        "p_partkey * 2 AS promotion_id",
        "p_size AS product_id",
        "CASE p_size % 3 WHEN 0 THEN 'Product' WHEN 1 THEN 'Category' ELSE 'Brand' END AS apply_to",
    ]),
    "RETURN": ("orders", [
        "o_orderkey AS return_id",
        "concat('R', CAST(o_orderkey % 14000 AS STRING)) AS return_number",
        "o_orderkey + o_orderkey % 3 AS transaction_id",
        "CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey + o_orderkey % 2 END AS customer_id",
        "o_custkey % 130 AS user_id",
        "o_custkey % 120 AS store_id",
        "CASE o_orderstatus WHEN 'F' THEN 'Return' WHEN 'O' THEN 'Exchange' ELSE 'Gift' END AS return_type",
        "CAST(o_orderkey % 9 - 1 AS decimal(10,2)) AS refund_amount",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Pending' WHEN '2-HIGH' THEN 'Approved' "
        "WHEN '3-MEDIUM' THEN 'Rejected' ELSE 'Open' END AS status",
    ]),
    "RETURN_ITEM": ("lineitem", [
        "l_orderkey * 10 + l_linenumber AS return_item_id",
        "l_orderkey + l_linenumber % 3 AS return_id",
        "l_partkey AS variant_id",
        "l_orderkey * 10 + l_linenumber + l_linenumber % 2 AS transaction_item_id",
        "CAST(l_quantity AS INT) - 3 AS quantity",
        "CAST(l_linenumber - 2 AS decimal(10,2)) AS refund_amount",
    ]),
    "AUDIT_LOG": ("orders", [
        "o_orderkey AS log_id",
        "o_custkey % 130 AS user_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Create' WHEN '2-HIGH' THEN 'Price Change' "
        "ELSE 'Look' END AS action_type",
        "'ORDER' AS entity_type",
        "o_orderkey AS entity_id",
    ]),
}


def retail_tables(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> dict[str, DataFrame]:
    return {
        n: table(spark, folder, SOURCES[n][0]).selectExpr(*SOURCES[n][1])
        for n in names or SOURCES
    }
