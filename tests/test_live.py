"""A star kept up by changes equals the star built from all rows."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depotstar.operators import delta, marts
from depotstar.operators.joins import left_lookup
from depotstar.plans.warehouse import build_star
from depotstar.schemas import STAGING, WAREHOUSE
from depotstar.sources import steps
from depotstar.streaming import live
from depotstar.streaming.incremental import Table

NAMES = {"items": "stg_oms_order_items", "orders": "stg_oms_orders", "shipments": "stg_slms_shipments"}
KEYS = {"items": "order_item_id", "orders": "order_id", "shipments": "shipment_id"}
SHOWN = {
    "customer": ["customer_id", "customer_fname", "customer_city"],
    "product": ["product_id", "product_name", "product_price", "category_id", "category_name", "department_name"],
    "order_date": ["full_date"],
    "ship_date": ["full_date"],
    "customer_geography": ["city", "state", "latitude"],
    "order_geography": ["city", "state", "latitude"],
    "shipping": ["shipping_mode", "delivery_status", "delivery_risk"],
}


def shown(star):
    """The fact with what its keys stand for."""
    fact = star["order_items"]
    for name in SHOWN:
        fact = left_lookup(fact, marts.role(star, name), {marts.ROLES[name][0]: marts.ROLES[name][0]})
    measures = [c for c in WAREHOUSE["order_items"].fieldNames() if not c.endswith("_key")]
    columns = [F.col(f"`{n}.{c}`") for n, cs in SHOWN.items() for c in cs]
    return sorted(map(str, fact.select("order_item_id", *columns, *measures, "order_year", "order_month").collect()))


class Feed:
    """Staging tables that take batches of rows, newest `load_timestamp` first to count."""

    def __init__(self, spark, root):
        self.spark, self.root, self.clock = spark, root, 0
        self.tables = {n: Table(f"{root}/{n}", STAGING[NAMES[n]], [KEYS[n]], ["load_timestamp"]) for n in NAMES}

    def take(self, name, batch):
        self.clock += 1
        layout = STAGING[NAMES[name]]
        stamped = [{**dict.fromkeys(layout.fieldNames()), **r, "load_timestamp": datetime(2024, 1, 1, 0, self.clock)} for r in batch]
        df = self.spark.createDataFrame([tuple(r[c] for c in layout.fieldNames()) for r in stamped], layout)
        steps.add(df, self.tables[name].root, [f"{name}{self.clock}"])

    def refresh(self):
        return live.refresh(self.spark, *self.tables.values(), f"{self.root}/star")

    def full(self, path):
        return build_star(*[t.current(self.spark) for t in self.tables.values()], path)


def random_order(r, i):
    return dict(
        order_id=i, customer_id=r.choice([None, 1, 2, 3, 4, 5]), customer_fname=r.choice("ab"), customer_segment="s",
        order_city=r.choice([None, "Rome", "Oslo", "Bonn"]), order_state="x", order_country=r.choice(["y", None]),
        order_date=r.choice([None, date(2020, r.randrange(1, 4), 5), date(2021, 1, 7)]),
    )


def random_item(r, i, orders):
    return dict(
        order_item_id=i, order_id=r.choice(orders), product_id=r.choice([None, 1, 2, 3, 4]),
        product_name=r.choice(["p", "q"]), product_card_id="c", product_price=Decimal(r.randrange(3)),
        category_id=r.choice([None, 1, 2]), category_name=r.choice("mn"), department_id=r.choice([None, 1, 2]),
        department_name=r.choice("uv"), quantity=r.randrange(9), sales=Decimal(r.randrange(99)),
    )


def random_shipment(r, i):
    place = r.choice([(None, None), ("Rome", Decimal(1)), ("Rome", Decimal(2)), ("Oslo", None), ("Paris", Decimal(3))])
    return dict(
        shipment_id=i, ship_city=place[0], ship_state="x", ship_country=r.choice(["y", None]), latitude=place[1],
        longitude=place[1], ship_date=r.choice([None, date(2020, 2, 2), date(2022, 1, 1)]),
        shipping_mode=r.choice([None, "air"]), delivery_status=r.choice([None, "late"]), delivery_risk=r.choice("01"),
    )


def test_refreshes_equal_full_builds(spark, tmp_path):
    r = random.Random(1)
    feed = Feed(spark, str(tmp_path))
    orders = [f"{i}" for i in range(12)]
    items = [f"i{i}" for i in range(30)] + [None]
    numbers = {}
    for n in range(4):
        few = 40 if n == 0 else 3
        feed.take("orders", [random_order(r, i) for i in r.sample(orders, min(few, 9))])
        if n != 2:
            feed.take("items", [random_item(r, i, [*orders, "none", None]) for i in r.sample(items, min(few, 25))])
        if n != 3:
            feed.take("shipments", [random_shipment(r, i) for i in r.sample(items, min(few, 20))])
        star = feed.refresh()
        assert shown(star) == shown(feed.full(str(tmp_path / f"full{n}")))
        # Keys once given stay, and each live row is there once.
        for row in star["dim_product"].select("product_id", "product_name", "product_price", "category_key", "product_key").collect():
            assert numbers.setdefault(tuple(row)[:4], row.product_key) == row.product_key
        for table, key in (("dim_customer", "customer_key"), ("dim_geography", "geography_key"), ("dim_date", "date_key")):
            assert star[table].count() == star[table].select(key).distinct().count()
            full = spark.read.schema(WAREHOUSE[table]).parquet(str(tmp_path / f"full{n}" / table))
            assert star[table].drop(key).exceptAll(full.drop(key)).isEmpty()
            assert full.count() == star[table].count()


def small_feed(spark, root):
    feed = Feed(spark, root)
    r = random.Random(7)
    feed.take("orders", [{**random_order(r, str(i)), "order_date": date(2020, 1 + i % 6, 3), "order_city": "Oslo", "customer_id": i % 3} for i in range(24)])
    feed.take("items", [{**random_item(r, f"i{i}", [str(i % 24)]), "product_id": 1 + i % 4, "product_name": "p", "product_price": Decimal(1), "category_id": 1, "category_name": "m", "department_id": 1, "department_name": "u"} for i in range(48)])
    feed.take("shipments", [random_shipment(r, f"i{i}") for i in range(48)])
    return feed


def files(star):
    return set(star["order_items"].inputFiles())


def test_only_touched_months_are_rewritten(spark, tmp_path):
    feed = small_feed(spark, str(tmp_path))
    before = files(feed.refresh())
    grown = {**random_item(random.Random(1), "new", ["3"]), "product_id": 1, "product_name": "p", "product_price": Decimal(1), "category_id": 1, "category_name": "m", "department_id": 1, "department_name": "u"}
    feed.take("items", [grown])
    star = feed.refresh()
    changed = {f.split("order_month=")[1].split("/")[0] for f in files(star) ^ before}
    assert changed == {"4"}
    assert shown(star) == shown(feed.full(str(tmp_path / "full")))
    run = live._Refresh(feed.tables, f"{tmp_path}/star", spark)
    plan = run.months(star["order_items"], [202004])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_month_left_empty_goes(spark, tmp_path):
    feed = small_feed(spark, str(tmp_path))
    feed.refresh()
    feed.take("orders", [
        {**r.asDict(), "order_date": date(2023, 9, 9)}
        for r in feed.tables["orders"].current(spark).where("month(order_date) = 2").collect()
    ])
    star = feed.refresh()
    assert star["order_items"].where("order_month = 2").count() == 0
    assert shown(star) == shown(feed.full(str(tmp_path / "full")))


def test_lost_refreshes_are_done_again(spark, tmp_path, monkeypatch):
    feed = small_feed(spark, str(tmp_path))
    feed.refresh()
    feed.take("items", [random_item(random.Random(3), "i5", ["2"])])

    def lost(*_):
        raise RuntimeError("lost")

    for name in ("build_fact", "finish"):
        with monkeypatch.context() as m:
            m.setattr(live._Refresh, name, lost)
            with pytest.raises(RuntimeError):
                feed.refresh()
    # More rows come before the lost refresh is ended, which is then lost between the months and the state.
    feed.take("items", [random_item(random.Random(9), "i6", ["3"])])
    with monkeypatch.context() as m:
        m.setattr(live, "put_text", lost)
        with pytest.raises(RuntimeError):
            feed.refresh()
    star = feed.refresh()
    assert shown(star) == shown(feed.full(str(tmp_path / "full")))


def test_nothing_new_and_rows_sent_again_change_nothing(spark, tmp_path):
    feed = small_feed(spark, str(tmp_path))
    before = files(feed.refresh())
    assert files(feed.refresh()) == before
    feed.take("orders", [r.asDict() for r in feed.tables["orders"].current(spark).limit(5).collect()])
    assert files(feed.refresh()) == before


def test_compacted_staging_is_read_whole(spark, tmp_path):
    feed = small_feed(spark, str(tmp_path))
    feed.refresh()
    feed.take("items", [random_item(random.Random(4), "i7", ["1"])])
    table = feed.tables["items"]
    steps.compact(table.current(spark), table.root)
    star = feed.refresh()
    assert shown(star) == shown(feed.full(str(tmp_path / "full")))
    feed.take("items", [random_item(random.Random(5), "i8", ["1"])])
    assert shown(feed.refresh()) == shown(feed.full(str(tmp_path / "again")))


def test_empty_staging(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    for name in NAMES:
        feed.take(name, [])
    assert all(df.count() == 0 for df in feed.refresh().values())


def test_changes(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 5, "x", 1), ("a", 2, 6, "x", 2), ("b", 1, 5, "x", 1), ("b", 0, 9, "late", 2), (None, 1, 1, "n", 2),
         ("c", 1, 7, "x", 1), ("c", 2, 7, "y", 2), ("d", 1, 1, "kept", 1)],
        "k string, at int, v int, note string, _step long",
    )
    found = delta.changes(df, ["k"], ["at"], "_step", 1, ignore=("at", "note"))
    assert rows(found.select("k", "old.v", "new.v")) == [(None, None, 1), ("a", 5, 6)]


def test_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    gone = spark.createDataFrame([(2, "b"), (1, None)], "a int, b string")
    assert rows(delta.add_counts([delta.counted(df), delta.counted(gone, -1)])) == [(1, None, 1)]
