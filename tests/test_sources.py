import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from depotstar.operators import cleanse
from depotstar.operators.cleanse import Cleaner, default_steps
from depotstar.operators.reshape import SOURCE_ORDERS, SOURCE_SHIPPING
from depotstar.plans import ingest, review
from depotstar.plans.warehouse import build_star_version, empty_star
from depotstar.schemas import STAGING
from depotstar.sources import csv, tables

HEADER = csv.source_columns()


def line(**values):
    base = {c: "" for c in HEADER} | {
        "Order Id": "1", "Order Item Id": "1", "Customer Id": "7", "Customer Fname": "Ana",
        "Order City": "Bogotá", "Order State": "DC", "Order Country": "Colombia",
        "order date (DateOrders)": "1/31/2018 22:56", "shipping date (DateOrders)": "2/3/2018 22:56",
        "Product Card Id": "365", "Product Name": "Rip Deck, \"Pro\"", "Product Price": "59.99",
        "Order Item Quantity": "2", "Sales": "119.98", "Order Item Discount": "5",
        "Order Profit Per Order": "-3.5", "Order Item Discount Rate": "0.04",
        "Order Item Profit Ratio": "-0.03", "Category Id": "17", "Category Name": "Cleats",
        "Department Id": "4", "Department Name": "Apparel", "Shipping Mode": "First Class",
        "Delivery Status": "Late delivery", "Late_delivery_risk": "1", "Latitude": "18.25",
        "Longitude": "-66.04",
    }
    return {**base, **values}


def write(path, records, encoding="latin-1", header=HEADER):
    def cell(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n') else v

    with open(path, "w", encoding=encoding) as f:
        f.write(",".join(cell(c) for c in header) + "\n")
        for r in records:
            f.write(",".join(cell(r[c]) for c in header) + "\n")
    return str(path)


def test_staging_load(spark, tmp_path):
    path = write(
        tmp_path / "in.csv",
        [
            line(),
            line(**{"Order Item Id": "2", "Order Status": "LATER", "Order Country": "Peru"}),
            line(**{"Order Id": "2", "Order Item Id": "3", "Customer Id": "NA",
                    "order date (DateOrders)": "31/12/2018 1:00", "Sales": "x"}),
        ],
    )
    now = datetime(2024, 5, 6, 7, 8, 9)
    done = ingest.load_staging(spark, path, str(tmp_path / "staging"), now=now)
    assert {n: df.schema for n, df in done.items()} == STAGING

    orders = {r.order_id: r for r in done["stg_oms_orders"].collect()}
    assert set(orders) == {"1", "2"}
    assert orders["1"].order_country == "Colombia" and orders["1"].order_city == "Bogotá"
    assert orders["1"].order_date == date(2018, 1, 31)
    assert orders["2"].order_date is None and orders["2"].customer_id is None
    assert orders["1"].load_timestamp == now and orders["1"].source_system == "OMS"

    items = {r.order_item_id: r for r in done["stg_oms_order_items"].collect()}
    assert len(items) == 3
    assert str(items["1"].sales) == "119.98" and items["3"].sales is None
    assert items["1"].product_name == 'Rip Deck, "Pro"' and items["1"].quantity == 2

    ship = {r.shipment_id: r for r in done["stg_slms_shipments"].collect()}
    assert ship["2"].ship_country == "Peru" and ship["2"].source_system == "SLMS"
    assert ship["1"].delivery_date is None and str(ship["1"].latitude) == "18.250000"

    # Loading again replaces, and the warehouse follows as one version.
    ingest.load_staging(spark, path, str(tmp_path / "staging"), now=now)
    assert spark.read.parquet(str(tmp_path / "staging/stg_oms_orders")).count() == 2
    root = str(tmp_path / "dwh")
    for expected in (1, 2):
        assert build_star_version(spark, str(tmp_path / "staging"), root, fact_key=True) == expected
    fact = tables.read_version(spark, root, "order_items")
    assert sorted(r.order_item_key for r in fact.collect()) == [1, 2, 3]
    assert tables.read_version(spark, root, "dim_date").count() == 2


def test_versioned_staging_feeds_the_warehouse(spark, tmp_path):
    path = write(tmp_path / "in.csv", [line(), line(**{"Order Item Id": "2"})])
    staging, root = str(tmp_path / "staging"), str(tmp_path / "dwh")
    assert empty_star(spark, root) == 1
    assert tables.read_version(spark, root, "order_items").count() == 0
    version = ingest.load_staging_version(spark, path, staging)
    assert build_star_version(spark, tables.version_path(staging, version), root) == 2
    assert tables.read_version(spark, root, "order_items").count() == 2


def test_empty_staging(spark, tmp_path):
    ingest.empty_staging(spark, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/stg_oms_orders").count() == 0


def test_file_order_spans_files_and_blocks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for f, n in [("b.csv", 400), ("a.csv", 3000), ("c.csv", 10)]:
        (folder / f).write_text("k,v\n" + "".join(f"{f},{i:06d}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = csv.read_flat(spark, str(folder), file_order=True)
        assert df.rdd.getNumPartitions() > 3
        got = [(r.k, r.v) for r in sorted(df.collect(), key=lambda r: (r._file, r._block, r._row))]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [(f, f"{i:06d}") for f, n in [("a.csv", 3000), ("b.csv", 400), ("c.csv", 10)] for i in range(n)]
    assert got == expected


def test_scan_is_pruned(spark, tmp_path):
    path = write(tmp_path / "in.csv", [line()])
    df = csv.read_flat(spark, path, columns=["Order Id", "Sales"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Order Id:string,Sales:string>" in plan


def test_files_without_quoted_line_ends_are_split(spark, tmp_path, rows):
    folder = tmp_path / "odd names %41"
    folder.mkdir()
    (folder / "a.csv").write_text('k,v\n1,"p\nq"\n2,"say ""hi"""\n')
    (folder / "b.csv").write_text("k,v\n" + "".join(f'{i},"x, ""y"" {i}"\n' for i in range(3, 3000)))
    (folder / "c.csv").write_text('v,k\n5" pipe,9000\n')
    (folder / "d.csv").write_text("")
    path = str(folder)
    files = csv.csv_files(spark, path)
    odd = csv.quoted_line_ends(spark, files)
    assert sorted(os.path.basename(f) for f in odd) == ["a.csv", "c.csv"]
    found = csv.read_flat(spark, path, multi_line=None)
    assert rows(found) == rows(csv.read_flat(spark, path, multi_line=True))
    assert found.where("v = 'p\nq'").count() == 1 and found.count() == 3000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split = csv.read_flat(spark, path, ["k"], multi_line=None)
        assert split.rdd.getNumPartitions() > csv.read_flat(spark, path, ["k"], multi_line=True).rdd.getNumPartitions()
        assert rows(split) == rows(found.select("k"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert csv.quoted_line_ends(spark, []) == set()


def test_quoted_line_ends_need_multi_line(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n"x\ny",1\n')
    assert csv.read_flat(spark, str(path), multi_line=True).collect()[0].a == "x\ny"


def test_newest_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.newest_file(spark, str(tmp_path))
    for i, stamp in enumerate(["20240101_000000", "20230101_000000"]):
        path = f"{tmp_path}/in_cleaned_{stamp}.csv"
        csv.write_flat(spark.createDataFrame([(i,)], "v int"), path)
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (time.time() + i * 100,) * 2)
    assert csv.newest_file(spark, str(tmp_path)).endswith("in_cleaned_20230101_000000.csv")


def test_cleaned_path():
    name = csv.cleaned_path("/d/in.csv", datetime(2024, 1, 2, 3, 4, 5))
    assert name == "/d/in_cleaned_20240102_030405.csv"


def test_load_sources_and_services(spark, tmp_path):
    back = {}
    for c in SOURCE_ORDERS + SOURCE_SHIPPING:
        back.setdefault(c, "1")
    header = [
        c.replace("order_date_dateorders", "order date (DateOrders)")
        .replace("shipping_date_dateorders", "shipping date (DateOrders)")
        .replace("_", " ")
        for c in back
    ]
    header = ["ordercustomerid" if c == "order customer id" else c for c in header]
    path = write(tmp_path / "full.csv", [{c: "1" for c in header}], header=header)
    done = ingest.load_sources(spark, path, str(tmp_path / "db"))
    assert done["source_orders"].columns == SOURCE_ORDERS
    assert done["source_shipping"].columns == SOURCE_SHIPPING

    flat = csv.read_flat(spark, write(tmp_path / "in.csv", [line(), line()]), encoding="ISO-8859-1")
    out = ingest.write_services(flat, str(tmp_path / "x.csv"))
    sales, logistics = (csv.read_flat(spark, p) for p in out)
    assert "Sales" in sales.columns and "Market" not in sales.columns
    assert logistics.columns[0] == "Order Id" and logistics.count() == 2


def test_cleaner_runs_whole_and_by_step(spark, tmp_path):
    header = ["Order Id", "Customer Id", "Product Name", "Sales", "Customer Email", "", "Unnamed: 3", "none"]
    record = {c: "" for c in header} | {"Order Id": "1", "Customer Id": "2", "Product Name": " p ", "Sales": "3", "Customer Email": "XXXXXXXXX"}
    path = write(tmp_path / "c.csv", [record, record, {**record, "Sales": "bad"}], "utf-8", header)
    cleaner = Cleaner(spark, path)
    report = cleaner.run(str(tmp_path / "out.csv"), default_steps(datetime(2024, 1, 1))).first()
    assert report.total_rows_original == 3 and report.total_rows_cleaned == 2
    assert report.duplicates_removed == 1
    assert report.columns_dropped == "Unnamed: 3,_c5,none"
    # One bad number, and the email that was masked in both rows.
    assert report.missing_cells == 3
    out = csv.read_flat(spark, str(tmp_path / "out.csv"))
    assert {(r["Product Name"], r["data_quality_score"]) for r in out.collect()} == {("p", "100"), ("p", "75")}

    custom = Cleaner(spark, path).apply(lambda df: df.where("Sales = '3'")).apply(lambda df: df.drop("none"))
    assert custom.df.count() == 2 and custom.dropped == ["none"]


def test_review_of_the_newest_file(spark, tmp_path):
    path = write(
        tmp_path / "in.csv",
        [line(**{"Order Item Id": str(i), "Sales": str(i), "Late_delivery_risk": str(i % 2)}) for i in range(1, 5)],
    )
    raw = csv.read_flat(spark, path, encoding="ISO-8859-1").withColumn("Benefit per order", F.lit("1"))
    cleaned = cleanse.cleanse(raw, cleanse.default_steps(datetime(2024, 1, 1)))
    csv.write_flat(cleaned, str(tmp_path / "in_cleaned_20240101_000000.csv"))

    results, verdict = review.validate_newest(spark, str(tmp_path))
    assert verdict.first().ready and results.where("NOT passed").count() == 0

    found = review.analyse_newest(spark, str(tmp_path))
    assert set(found) == {"numbers", "texts", "totals", "top_products", "delivery_status", "late_rate"}
    totals = found["totals"].first()
    assert (totals.total_revenue, totals.total_profit, totals.mean_line_sales) == (10.0, 4.0, 2.5)
    assert found["late_rate"].first()[0] == 50.0
    sales = {r.column_name: r for r in found["numbers"].collect()}["Sales"]
    assert (sales.q25, sales.q50, sales["max"]) == (1.75, 2.5, 4.0)
    split = csv.read_flat(spark, str(tmp_path / "in_cleaned_20240101_000000_SERVICE_LOGISTICS.csv"))
    # The splits are newer, but are no cleaned files.
    assert csv.newest_file(spark, str(tmp_path)).endswith("in_cleaned_20240101_000000.csv")
    assert split.count() == 4 and "Sales" not in split.columns


def test_versions_are_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "v")
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, root, "t")
    assert tables.write_version(spark, root, {"t": df}) == 1
    # A version whose writer was lost has no mark: readers keep the last one, the next run reuses it.
    tables.replace(df.union(df), f"{root}/v2/t")
    assert tables.read_version(spark, root, "t").count() == 1
    grown = tables.read_version(spark, root, "t").union(df).union(df)
    assert tables.write_version(spark, root, {"t": grown}) == 2
    assert tables.read_version(spark, root, "t").count() == 3
    assert tables.read_version(spark, root, "t", 1).count() == 1


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    tables.append(df, path)
    tables.append(df, path)
    assert tables.read(spark, path).count() == 6
    tables.replace(df.select((F.col("id") * 2).alias("id")), path)
    assert [r.id for r in tables.read(spark, path).orderBy("id").collect()] == [0, 2, 4]


def test_old_versions_expire(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        tables.write_version(spark, root, {"a": spark.range(n)})
    tables.expire(spark, root, keep=2)
    assert tables.versions(spark, root) == [3, 4] and sorted(os.listdir(root)) == ["v3", "v4"]
    assert tables.read_version(spark, root, "a").count() == 3


def test_files_with_different_headers(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    (tmp_path / "b.csv").write_text("v,k,w\ny,2,z\n\"p\nq\",3,\n")
    (tmp_path / "c.csv").write_text("")
    df = csv.read_flat(spark, str(tmp_path), multi_line=True)
    assert df.columns == ["k", "v", "w"]
    assert rows(df) == [("1", "x", None), ("2", "y", "z"), ("3", "p\nq", None)]
    assert rows(csv.read_flat(spark, f"{tmp_path}/*.csv", ["v"], multi_line=True)) == [("p\nq",), ("x",), ("y",)]


def test_ragged_rows(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2\n3,y,z\n")
    (tmp_path / "b.csv").write_text("v,k\nx,1\n")
    assert rows(csv.ragged_rows(spark, str(tmp_path))) == [("a.csv", 2)]
    assert rows(csv.ragged_rows(spark, f"{tmp_path}/b.csv")) == []


def test_values_are_written_as_they_are(spark, rows, tmp_path):
    df = spark.createDataFrame([("  pad ", 'say "x", y'), ("\t", "a\nb")], "k string, v string")
    path = csv.write_flat(df, str(tmp_path / "out"))
    assert rows(csv.read_flat(spark, path, multi_line=True)) == rows(df)


def test_failed_conversions_are_counted(spark, rows, tmp_path):
    path = write(
        tmp_path / "in.csv",
        [line(), line(**{"Sales": "x", "order date (DateOrders)": "31/12/2018 1:00", "Customer Id": ""}),
         line(**{"Sales": " y "})],
    )
    assert rows(ingest.staging_failures(spark, path)) == [
        ("stg_oms_order_items", "sales", 2), ("stg_oms_orders", "order_date", 1),
    ]


def test_cleaner_names_its_output(spark, tmp_path):
    path = write(tmp_path / "in.csv", [line(), line()])
    Cleaner(spark, path).run(now=datetime(2024, 1, 2, 3, 4, 5))
    assert csv.newest_file(spark, str(tmp_path)).endswith("in_cleaned_20240102_030405.csv")
