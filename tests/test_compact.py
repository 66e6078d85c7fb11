"""Packed ids and numbers come back as they were, and the fact shuffles its items packed."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import compact
from depotstar.operators.fact import order_items, packed_order_items
from depotstar.operators.staging import conform_staging
from depotstar.plans.warehouse import build_dimensions

D = Decimal
IDS = [
    "54-3-20-10-1996-03-13", "0", "00", "-", "--", "-1", "1-", "", "a1", "A", "f", "F", "FF", "1F", "12\n", "\n",
    "1 ", "é-1", "١", "\x00", "9" * 501,
]
ITEM = T.StructType([T.StructField("id", T.StringType())])


def test_packed_text_is_one_to_one(spark):
    df = spark.createDataFrame([(i,) for i in [*IDS, None]], ITEM).withColumn("packed", compact.packed_text(F.col("id")))
    found = df.withColumn("again", compact.unpacked_text(F.col("packed"))).collect()
    assert [r["id"] for r in found] == [r["again"] for r in found] == [*IDS, None]
    assert len({bytes(r["packed"]) for r in found if r["packed"] is not None}) == len(IDS)
    assert len(found[0]["packed"]) == 11


def test_packed_numbers_and_keys(spark):
    schema = T.StructType([
        T.StructField("n", T.IntegerType()), T.StructField("sales", T.DecimalType(10, 2)),
        T.StructField("profit", T.DecimalType(10, 2)), T.StructField("rate", T.DecimalType(5, 2)),
    ])
    most, rate = D("99999999.99"), D("999.99")
    data = [
        (2**31 - 1, most, -most, rate), (-(2**31), -most, most, -rate), (None, None, None, None),
        (0, D("0.00"), D("0.01"), D("-0.01")), (5, None, D("1.10"), None),
    ]
    packed = spark.createDataFrame(data, schema).select(*compact.packed_numbers(schema.fields, "w"))
    assert len(packed.columns) == 3
    back = compact.unpacked_numbers(schema.fields, "w")
    again = packed.select(*[back[c].alias(c) for c in schema.fieldNames()])
    assert again.schema == schema and [tuple(r) for r in again.collect()] == data

    bits = {"a": 40, "b": 22}
    data = [(1, 1), (None, 7), (7, None), (None, None), (2**40 - 2, 2**22 - 2)]
    df = spark.createDataFrame(data, "a bigint, b bigint").select(compact.packed_keys(bits).alias("w"))
    back = compact.unpacked_keys(F.col("w"), bits)
    assert [tuple(r) for r in df.select(back["a"], back["b"]).collect()] == data


def test_items_travel_packed_and_keep_odd_ids(spark, tmp_path):
    items = conform_staging(spark.createDataFrame(
        [(i, "9", 7, "Ball", 1, D("2.50")) for i in [*IDS, IDS[0], None]],
        "order_item_id string, order_id string, product_id bigint, product_name string, quantity int, sales decimal(10,2)",
    ), "stg_oms_order_items")
    orders = conform_staging(spark.createDataFrame(
        [("9", 1, date(2023, 12, 30))], "order_id string, customer_id bigint, order_date date"
    ), "stg_oms_orders")
    shipments = conform_staging(spark.createDataFrame(
        [(i, "Air") for i in IDS], "shipment_id string, shipping_mode string"
    ), "stg_slms_shipments")
    star = build_dimensions(items, orders, shipments, str(tmp_path))
    packed = packed_order_items(items, orders, shipments, star)
    assert packed.schema["order_item_id"].dataType == T.BinaryType()
    # The id, the product, three words of keys, four of measures, and the month.
    assert len(packed.columns) == 10
    rows = order_items(items, orders, shipments, star).collect()
    assert sorted(r["order_item_id"] or "" for r in rows) == sorted([*IDS, IDS[0], ""])
    assert all((r["order_year"], r["order_month"], r["sales"]) == (2023, 12, D("2.50")) for r in rows)
    assert all((r["shipping_key"] is None) == (r["order_item_id"] is None) for r in rows)
