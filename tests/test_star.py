"""Dimensions, fact, fan-out and marts on hand-written staging rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotstar.operators import dims, fanout, marts
from depotstar.operators.fact import order_items
from depotstar.operators.staging import conform_staging
from depotstar.plans.warehouse import build_star, keyed
from depotstar.sources import tables
from depotstar.streaming.incremental import refresh_star
from depotstar.schemas import WAREHOUSE

D = Decimal


def staging(spark, table, columns, data):
    return conform_staging(spark.createDataFrame(data, columns), table)


@pytest.fixture(scope="module")
def inputs(spark):
    """One customer with two places, one place with three coordinate rows, one product with two
    prices, one category in two departments, flags that are partly and wholly NULL."""
    orders = staging(
        spark, "stg_oms_orders",
        "order_id string, customer_id bigint, customer_fname string, order_city string, "
        "order_state string, order_country string, order_date date, order_status string",
        [
            ("9", 1, "Ana", "Lima", "L", "Peru", date(2023, 12, 30), "DONE"),
            ("10", 1, "Ana", "Cusco", "C", "Peru", date(2023, 12, 30), "DONE"),
            ("11", 2, "Bo", "Lima", "L", "Peru", date(2024, 2, 29), "OPEN"),
            ("12", None, "Nil", None, None, None, None, None),
            ("13", 3, "Cy", "Bare", None, "Peru", date(2024, 1, 1), "OPEN"),
        ],
    )
    items = staging(
        spark, "stg_oms_order_items",
        "order_item_id string, order_id string, product_id bigint, product_name string, "
        "product_price decimal(10,2), quantity int, sales decimal(10,2), discount decimal(10,2), "
        "profit decimal(10,2), discount_rate decimal(5,2), category_id bigint, "
        "category_name string, department_id bigint, department_name string",
        [
            ("a", "9", 100, "Ball", D("5.00"), 2, D("10.00"), D("1.00"), D("2.00"), D("0.10"), 7, "Toys", 1, "Fun"),
            ("b", "9", 100, "Ball", D("6.00"), 1, D("6.00"), D("0.00"), D("1.00"), D("0.00"), 7, "Toys", 2, "Play"),
            ("c", "10", 200, "Net", D("9.00"), 1, D("9.00"), D("0.00"), D("-1.00"), D("0.00"), 8, "Gear", 1, "Fun"),
            ("d", "11", None, None, None, 1, D("1.00"), None, None, None, None, None, None, None),
            ("e", "99", 100, "Ball", D("5.00"), 3, D("15.00"), D("0.00"), D("0.50"), D("0.00"), 7, "Toys", 1, "Fun"),
            ("f", None, 200, "Net", D("9.00"), 1, D("9.00"), D("0.00"), D("0.00"), D("0.00"), 8, "Gear", 1, "Fun"),
            ("g", "13", 200, "Net", D("9.00"), 1, D("9.00"), D("0.00"), D("0.00"), D("0.00"), 8, "Gear", 1, "Fun"),
        ],
    )
    shipments = staging(
        spark, "stg_slms_shipments",
        "shipment_id string, order_id string, shipping_mode string, ship_date date, "
        "delivery_status string, delivery_risk string, ship_city string, ship_state string, "
        "ship_country string, latitude decimal(10,6), longitude decimal(10,6)",
        [
            ("a", "9", "Air", date(2024, 1, 2), "Late", "1", "Lima", "L", "Peru", D("1.5"), D("2.5")),
            ("b", "9", "Air", date(2024, 1, 2), "Late", "1", "Lima", "L", "Peru", D("1.5"), D("1.5")),
            ("c", "10", "Sea", None, None, "0", "Lima", "L", "Peru", None, None),
            ("d", "11", None, date(2024, 1, 6), None, None, None, None, None, D("3"), D("3")),
            ("e", "99", "Air", date(2024, 1, 7), "Late", "1", "Bare", None, "Peru", D("4"), D("4")),
        ],
    )
    return items, orders, shipments


@pytest.fixture(scope="module")
def stars(spark, inputs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stars"))
    return {
        True: build_star(*inputs, f"{path}/one", True, fact_key=True),
        False: build_star(*inputs, f"{path}/all", False),
    }


def test_layouts_and_keys(stars):
    for star in stars.values():
        for table, schema in WAREHOUSE.items():
            if table != "order_items":
                assert star[table].schema == schema, table
                key = dims.SURROGATE_KEYS[table]
                got = sorted(r[0] for r in star[table].select(key).collect())
                assert got == list(range(1, len(got) + 1))


def test_dimension_rows(stars, rows):
    one, all_ = stars[True], stars[False]
    assert rows(one["dim_department"].drop("department_key")) == [(1, "Fun"), (2, "Play")]
    category = one["dim_category"].join(one["dim_department"], "department_key")
    assert rows(category.select("category_id", "category_name", "department_name")) == [
        (7, "Toys", "Fun"), (7, "Toys", "Play"), (8, "Gear", "Fun"),
    ]
    # One category row per product in one-match mode, else one product row per category row.
    assert one["dim_product"].count() == 3 and all_["dim_product"].count() == 5
    assert one["dim_customer"].count() == 5
    assert one["dim_customer"].where("customer_id IS NULL").count() == 1
    assert one["dim_geography"].where("city = 'Lima'").count() == 3
    assert one["dim_geography"].where("city IS NULL").count() == 0
    assert one["dim_shipping"].count() == 2
    days = {r.full_date: r for r in one["dim_date"].collect()}
    assert len(days) == 6 and None not in days
    assert days[date(2023, 12, 30)].is_weekend and days[date(2023, 12, 30)].day_of_week == 6
    assert days[date(2024, 2, 29)].quarter_number == 1


def test_keys_are_the_same_on_every_run(inputs, rows):
    items, orders, _ = inputs
    for table, df in [("dim_customer", dims.customer_rows(orders)), ("dim_department", dims.department_rows(items))]:
        assert rows(keyed(df, table)) == rows(keyed(df.repartition(3), table))


def test_one_match_keeps_the_grain(stars, inputs, rows):
    star = stars[True]
    fact = star["order_items"]
    assert sorted(r.order_item_id for r in fact.collect()) == list("abcdefg")
    assert sorted(r.order_item_key for r in fact.collect()) == list(range(1, 8))

    def resolved(role, *columns):
        dim = marts.role(star, role)
        joined = fact.join(dim, marts.ROLES[role][0], "left")
        return {r[0]: tuple(r[1:]) for r in joined.select("order_item_id", *[F.col(f"`{role}.{c}`") for c in columns]).collect()}

    # Both orders are of one day, so order 10, the greater number, gives the customer's place.
    assert resolved("customer", "customer_id", "customer_city")["a"] == (1, "Cusco")
    assert resolved("customer_geography", "city")["a"] == ("Cusco",)
    # The row with coordinates is taken, and of two the smaller.
    assert resolved("order_geography", "city", "latitude", "longitude")["a"] == ("Lima", D("1.500000"), D("1.500000"))
    # A NULL state still finds its place, the customer id that is NULL finds none.
    assert resolved("order_geography", "city", "latitude")["g"] == ("Bare", D("4.000000"))
    assert resolved("product", "product_price")["a"] == (D("5.00"),)
    assert resolved("shipping", "shipping_mode", "delivery_status", "delivery_risk")["c"] == ("Sea", None, "0")
    assert resolved("shipping", "shipping_mode")["d"] == (None,)
    assert resolved("ship_date", "full_date")["c"] == (None,)
    assert resolved("order_date", "full_date", "year")["d"] == (date(2024, 2, 29), 2024)
    # No order, no shipment, no product.
    missing = {r.order_item_id: r for r in fact.collect()}
    assert missing["e"].customer_key is None and missing["e"].shipping_key is not None
    assert missing["f"].order_date_key is None and missing["f"].shipping_key is None
    assert missing["d"].product_key is None and missing["d"].order_item_discount is None


def test_repeated_shipments_do_not_multiply_in_one_match(inputs, stars):
    items, orders, shipments = inputs
    fact = order_items(items, orders, shipments.union(shipments.withColumn("ship_date", F.lit(date(2024, 1, 7)))), stars[True])
    assert fact.count() == 7
    # The earliest date counts.
    day = {r.full_date: r.date_key for r in stars[True]["dim_date"].collect()}[date(2024, 1, 2)]
    assert fact.where("order_item_id = 'a'").first().shipping_date_key == day


def test_as_written_multiplies_like_plain_joins(inputs, stars, rows):
    items, orders, shipments = inputs
    star = stars[False]
    for t, df in star.items():
        df.createOrReplaceTempView(t)
    items.createOrReplaceTempView("s_item")
    orders.createOrReplaceTempView("s_order")
    shipments.createOrReplaceTempView("s_ship")
    plain = items.sparkSession.sql("""
        SELECT i.order_item_id, c.customer_key, od.date_key, sd.date_key, cg.geography_key,
               og.geography_key, s.shipping_key, p.product_key, i.quantity, i.sales
        FROM s_item i LEFT JOIN s_order o ON i.order_id = o.order_id
        LEFT JOIN s_ship h ON i.order_item_id = h.shipment_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_product p ON i.product_id = p.product_id
        LEFT JOIN dim_date od ON o.order_date = od.full_date
        LEFT JOIN dim_date sd ON h.ship_date = sd.full_date
        LEFT JOIN dim_geography cg ON c.customer_city = cg.city AND c.customer_state = cg.state
             AND c.customer_country = cg.country
        LEFT JOIN dim_geography og ON o.order_city = og.city AND o.order_state = og.state
             AND o.order_country = og.country
        LEFT JOIN dim_shipping s ON h.shipping_mode = s.shipping_mode
             AND h.delivery_status = s.delivery_status AND h.delivery_risk = s.delivery_risk""")
    columns = [
        "order_item_id", "customer_key", "order_date_key", "shipping_date_key",
        "customer_geography_key", "order_geography_key", "shipping_key", "product_key",
        "order_item_quantity", "sales",
    ]
    assert rows(star["order_items"].select(*columns)) == rows(plain)
    # Item a: Lima and Cusco as customer places, three rows for Lima, three products.
    assert star["order_items"].where("order_item_id = 'a'").count() == (3 + 1) * 3 * 4

    totals = fanout.fan_out_totals(items, orders, shipments, star, ["shipping_mode", "order_status"])
    counted = plain.join(items.select("order_item_id", "order_id", "discount", "profit"), "order_item_id")
    counted = counted.join(orders.select("order_id", "order_status"), "order_id", "left").join(
        shipments.select(F.col("shipment_id").alias("order_item_id"), "shipping_mode"), "order_item_id", "left"
    )
    expected = counted.groupBy("shipping_mode", "order_status").agg(
        F.count("*"), F.sum("quantity"), F.sum("sales"), F.sum("discount"), F.sum("profit")
    )
    assert rows(totals) == rows(expected)


def test_fan_out_report(stars):
    report = {r.lookup: r for r in fanout.fan_out(stars[True]).collect()}
    assert (report["customer"].lookup_keys, report["customer"].repeated_keys, report["customer"].most_rows) == (3, 1, 2)
    assert report["product"].most_rows == 2 and report["category"].most_rows == 2
    assert report["geography"].most_rows == 3
    assert report["date"].repeated_keys == report["shipping"].repeated_keys == 0


def test_fact_foreign_keys_hold(stars):
    from depotstar.operators.constraints import ForeignKey, audit_foreign_key
    from depotstar.schemas import STAR_FOREIGN_KEYS

    for column, dim, key in STAR_FOREIGN_KEYS:
        found = audit_foreign_key(ForeignKey("order_items", column, dim, key), stars[True])
        assert found.first().violations == 0


def test_marts(spark, stars, rows):
    star = stars[True]
    by = {"department": "product.department_name"}
    got = rows(marts.grouped_measures(star, by).select("department", "lines", "quantity", "sales"))
    assert got == [(None, 1, 1, D("1.00")), ("Fun", 6, 9, D("58.00"))]
    kept = marts.filter_fact(
        star,
        equals={"product.product_name": "Ball", "shipping.shipping_mode": None},
        one_of={"order_date.year": [2023], "shipping.delivery_risk": []},
        contains={"order_geography.city": "LIM"},
    )
    assert sorted(r.order_item_id for r in kept.collect()) == ["a", "b"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert marts.filter_fact(star).count() == 7

    grants = spark.createDataFrame([("g", "Lima"), ("h", "Cusco")], "user_group string, value string")
    seen = marts.entitled_fact(star, grants, "g", on="order_geography.city")
    assert sorted(r.order_item_id for r in seen.collect()) == ["a", "b", "d"]
    assert marts.entitled_fact(star, grants, "nobody", on="order_geography.city").count() == 0

    late = {r.shipping_mode: (r.lines, r.late_lines, r.late_pct) for r in marts.late_by(star).collect()}
    assert late == {"Air": (3, 3, 100.0), "Sea": (1, 0, 0.0), None: (3, 0, 0.0)}
    effect = {r.order_item_discount_rate: r.sales for r in marts.discount_effect(star).collect()}
    assert effect[D("0.10")] == D("10.00")


def test_refresh_gives_the_star_of_a_full_build(spark, inputs, rows, tmp_path):
    items, orders, shipments = inputs
    root = str(tmp_path / "live")
    first = items.where("order_item_id IN ('a', 'c', 'd')")
    star = refresh_star(spark, first, orders.where("order_id <> '11'"), shipments, root)
    assert sorted(r.order_item_id for r in star["order_items"].collect()) == ["a", "c", "d"]

    # Item a changes and moves to an order of another year, the others and an order are new.
    moved = items.where("order_item_id <> 'a'").unionByName(
        items.where("order_item_id = 'a'").withColumns({"order_id": F.lit("11"), "sales": F.lit(D("77.00"))})
    )
    full = build_star(moved, orders, shipments, str(tmp_path / "full"))
    for turn in range(3):
        star = refresh_star(spark, moved, orders, shipments, root)
        for name in ("product", "customer", "order_geography", "order_date", "ship_date", "shipping"):
            assert rows(resolved(star, name)) == rows(resolved(full, name)), name
        assert tables.versions(spark, root) == [turn + 1, turn + 2]


def test_a_known_ship_date_beats_an_unknown_one(spark, inputs, stars, rows):
    items, orders, shipments = inputs
    unknown = shipments.withColumns(
        {c: F.lit(None).cast(shipments.schema[c].dataType) for c in ("ship_date", "shipping_mode")}
    )
    for again in (unknown, unknown.withColumn("ship_date", F.lit(None).cast("date"))):
        fact = order_items(items, orders, again.unionByName(shipments), stars[True])
        plain = order_items(items, orders, shipments, stars[True])
        shown = ["order_item_id", "shipping_date_key", "shipping_key"]
        assert rows(fact.select(shown)) == rows(plain.select(shown))


def resolved(star, name):
    dim = marts.role(star, name)
    shown = [F.col(f"`{c}`") for c in dim.columns if c.startswith(f"{name}.") and not c.endswith("_key")]
    joined = star["order_items"].join(dim, marts.ROLES[name][0], "left")
    return joined.select("order_item_id", "sales", *shown)
