"""The registered queries: each reads whole tables of a folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import percent, to_number
from depotstar.layouts import read_layout
from depotstar.operators import (
    asof,
    change,
    checks,
    cleanse,
    cluster,
    constraints,
    dedupe,
    digest,
    dims,
    fanout,
    keys,
    kept_audit as kept_audits,
    marts,
    profile,
    reshape,
    retail_rules,
    sketches,
    summary,
)
from depotstar.operators.fact import order_items, repacked, unpacked_order_items
from depotstar.operators.joins import left_lookup
from depotstar.operators.sets import union_all
from depotstar.plans import ingest
from depotstar.plans.warehouse import build_dimensions, empty_star, keyed, temporary_star
from depotstar.schemas import STAR_FOREIGN_KEYS, WAREHOUSE, conform, text_limit
from depotstar.session import fresh_path, stage, together, write_parquet
from depotstar.sources import csv, infer, retail, standin, tables
from depotstar.sources.files import file_system
from depotstar.streaming import incremental, live

# One fixed run time, so that results can be compared.
NOW = datetime(2024, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]

_built: dict[tuple, dict[str, DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike: decimals as double, dates and times as ISO text."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return c.alias(f.name)

    return df.select([column(f) for f in df.schema.fields])


def snake(df: DataFrame) -> DataFrame:
    return reshape.clean_names(df)


# Staging -------------------------------------------------------------------------------------


def stg_orders(spark: SparkSession, folder: str) -> DataFrame:
    return portable(standin.orders(spark, folder, NOW))


def stg_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return portable(standin.items(spark, folder, NOW))


def stg_shipments(spark: SparkSession, folder: str) -> DataFrame:
    return portable(standin.shipments(spark, folder, NOW))


def load_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the retail system in full layout; absent columns get their defaults."""
    batch = standin.table(spark, folder, "customer").selectExpr(
        "c_custkey AS customer_id", "c_name AS full_name", "concat('+', c_custkey) AS phone_number"
    )
    values = retail_rules.defaults("CUSTOMER", reshape.run_time(NOW))
    return portable(conform(batch, retail_rules.layout("CUSTOMER"), values))


def table_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the retail system that has a default, filled by it: a digest of its values."""
    found = []
    for name, df in retail.retail_tables(spark, folder).items():
        values = retail_rules.defaults(name, reshape.run_time(NOW))
        if values:
            whole = conform(df.drop(*values), retail_rules.layout(name), values)
            filled = digest.column_digests(whole.select(*values))
            found.append(filled.withColumn("table_name", F.lit(name)))
    return union_all(found)


def split_services(spark: SparkSession, folder: str) -> DataFrame:
    wanted = [
        "Order Id", "Sales", "Market", "Product Name", "shipping date (DateOrders)",
        "Delivery Status", "Late_delivery_risk",
    ]
    flat = standin.flat_lines(spark, folder, wanted)
    sales, logistics = reshape.split_tolerant(
        flat, reshape.SALES_SERVICE, reshape.LOGISTICS_SERVICE
    )
    return portable(reshape.link_services(sales, logistics))


# Dimensions ----------------------------------------------------------------------------------


def dim_department(spark: SparkSession, folder: str) -> DataFrame:
    return keyed(dims.department_rows(standin.items(spark, folder)), "dim_department")


def _categories(seen: DataFrame) -> DataFrame:
    departments = keyed(dims.department_rows(seen), "dim_department")
    return keyed(dims.category_rows(seen, departments), "dim_category")


def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    named = standin.items(spark, folder).select(
        "category_id", "category_name", "department_id", "department_name"
    )
    return _categories(stage(named.distinct(), "category_names"))


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    seen = stage(dims.item_attributes(standin.items(spark, folder)), "item_attributes")
    return portable(keyed(dims.product_rows(seen, _categories(seen)), "dim_product"))


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return keyed(dims.customer_rows(standin.orders(spark, folder)), "dim_customer")


def dim_geography(spark: SparkSession, folder: str) -> DataFrame:
    rows = dims.geography_rows(standin.orders(spark, folder), standin.shipments(spark, folder))
    return portable(keyed(rows, "dim_geography"))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = dims.date_rows(standin.orders(spark, folder), standin.shipments(spark, folder))
    return portable(keyed(rows, "dim_date"))


def dim_shipping(spark: SparkSession, folder: str) -> DataFrame:
    return keyed(dims.shipping_rows(standin.shipments(spark, folder)), "dim_shipping")


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys 1..n for all order lines."""
    lines = standin.table(spark, folder, "lineitem")
    natural = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = lines.select(*natural[:-1], F.to_date("l_shipdate").alias("l_shipdate")).distinct()
    return portable(keys.assign_keys(lines, natural, "line_key"))


# Fact and star -------------------------------------------------------------------------------


def inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, orders and shipments; each use of them scans only the columns it needs."""
    return (
        standin.items(spark, folder, NOW),
        standin.orders(spark, folder, NOW),
        standin.shipments(spark, folder, NOW),
    )


def _files(spark: SparkSession, folder: str) -> tuple[str, ...]:
    """Names, lengths and times of what a folder holds."""
    fs, p = file_system(spark, folder)
    return tuple(sorted(
        f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(p)
    ))


def _once(
    spark: SparkSession, folder: str, what: str, build: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Tables built once per application, as any warehouse is before it is read.

    A folder whose tables were written anew is another one.
    """
    at = (spark.sparkContext.applicationId, folder, what, _files(spark, folder))
    if at not in _built:
        _built[at] = build()
    return _built[at]


def star_for(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return _once(spark, folder, "star", lambda: temporary_star(*inputs(spark, folder)))


def all_matches_for(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Dimensions whose lookups of each other find every match."""

    def build() -> dict[str, DataFrame]:
        path = fresh_path(spark, "dims")
        return build_dimensions(*inputs(spark, folder), path, one_match=False)

    return _once(spark, folder, "all matches", build)


def fact_one_match(spark: SparkSession, folder: str) -> DataFrame:
    """The fact computed from staging; each key is shown as what it stands for."""
    star = star_for(spark, folder)
    items, orders, shipments = inputs(spark, folder)
    # Every third shipment was sent twice, once before its date was known.
    again = shipments.where(F.pmod(F.xxhash64("shipment_id"), F.lit(3)) == 0)
    shipments = shipments.unionByName(again.withColumn("ship_date", F.lit(None).cast("date")))
    fact = order_items(items, orders, shipments, star)
    return _shown(fact, star)


def _shown(fact: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    """The rows of the fact with what their keys stand for.

    They are packed while the customers and products, which may be many, are looked up.
    """
    attributes = {
        "customer": ["customer_id"],
        "product": ["product_id", "category_name", "department_name"],
        "order_date": ["full_date"],
        "ship_date": ["full_date"],
        "customer_geography": ["city", "latitude"],
        "order_geography": ["city", "latitude", "longitude"],
        "shipping": ["shipping_mode", "delivery_status", "delivery_risk"],
    }
    fact = repacked(fact, ("customer_key",))
    met = []
    for name, columns in attributes.items():
        key = marts.ROLES[name][0]
        if len(met) == 2:
            fact = unpacked_order_items(fact, [f"{n}.{c}" for n in met for c in attributes[n]])
        fact = left_lookup(fact, marts.role(star, name), {key: key}, keys_from=star["order_items"])
        met.append(name)
    measures = [c for c in WAREHOUSE["order_items"].fieldNames() if not c.endswith("_key")]
    shown = [
        F.col(f"`{name}.{c}`").alias(f"{name}_{c}") for name, cs in attributes.items() for c in cs
    ]
    return portable(fact.select("order_item_id", *shown, *measures))


def fact_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Size and sums of the fact that plain joins to all dimensions give."""
    items, orders, shipments = inputs(spark, folder)
    star = all_matches_for(spark, folder)
    by = ["shipping_mode", "order_status"]
    return portable(fanout.fan_out_totals(items, orders, shipments, star, by))


def fact_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated lookup keys per dimension, and those of categories known by brand alone."""
    found = fanout.fan_out(star_for(spark, folder))
    items = standin.items(spark, folder)
    by_brand = items.withColumns(
        {
            "category_id": F.floor(F.col("category_id") / 10).cast("bigint"),
            "category_name": F.split_part("category_name", F.lit(" "), F.lit(1)),
        }
    )
    seen = by_brand.select("category_id", "category_name", "department_id").distinct()
    brand = fanout.fan_out({"dim_category": seen})
    return found.unionByName(brand.withColumn("lookup", F.lit("category_by_brand")))


def star_revenue(spark: SparkSession, folder: str) -> DataFrame:
    by = {"department_name": "product.department_name", "year": "order_date.year"}
    return portable(marts.grouped_measures(star_for(spark, folder), by))


def star_products(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and margin per product name."""
    by = {"product_name": "product.product_name"}
    found = marts.grouped_measures(star_for(spark, folder), by)
    return portable(found.withColumn("margin_pct", percent(F.col("profit"), F.col("sales"))))


def star_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Measures by order month and whether the goods left on a weekend."""
    by = {
        "year": "order_date.year",
        "month": "order_date.month_number",
        "ship_weekend": "ship_date.is_weekend",
    }
    return portable(marts.grouped_measures(star_for(spark, folder), by))


def star_filtered(spark: SparkSession, folder: str) -> DataFrame:
    star = star_for(spark, folder)
    fact = marts.filter_fact(
        star,
        equals={"product.department_name": "PROMO", "ship_date.is_weekend": None},
        one_of={
            "shipping.shipping_mode": ["1-URGENT", "2-HIGH"],
            "order_date.year": [1996, 1997, 1998],
        },
        contains={"product.category_name": "brand#1"},
    )
    by = {"country": "order_geography.country", "quarter": "order_date.quarter_number"}
    return portable(marts.grouped_measures(star, by, fact))


def star_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and sales by three filters on a fact written along a curve of their keys.

    `pruned` tells that fewer than three tenths of the files can hold rows of the filter: less than a
    fifth at 600,000 lines, but at a dozen rows a file the files don't end where the slices do.
    """
    star = dict(star_for(spark, folder))
    roles = {"product": "product_key", "customer": "customer_key", "order_date": "order_date_key"}
    path = fresh_path(spark, "clustered")
    cluster.write_clustered(
        star["order_items"], path, list(roles.values()), files=512, pack=repacked, unpack=unpacked_order_items
    )
    star["order_items"] = spark.read.schema(star["order_items"].schema).parquet(path)
    filters = {
        "product": {"product.product_id": 7}, "customer": {"customer.customer_id": 7},
        "order_date": {"order_date.full_date": date(1996, 3, 13)},
    }
    parts = []
    for name, equals in filters.items():
        fact = marts.filter_fact(star, equals=equals, clustered=tuple(roles))
        kept = marts.role(star, name).where(F.col(f"`{next(iter(equals))}`") == next(iter(equals.values())))
        low, high = kept.agg(F.min(roles[name]), F.max(roles[name])).first()
        share = cluster.share_read(star["order_items"], roles[name], low, high).scalar()
        parts.append(
            fact.agg(F.lit(name).alias("filter"), F.count(F.lit(1)).alias("lines"), F.sum("sales").alias("sales"))
            .withColumn("pruned", share < 0.3)
        )
    return portable(union_all(parts))


def star_entitled(spark: SparkSession, folder: str) -> DataFrame:
    """What a group entitled to the regions with A sees."""
    star = star_for(spark, folder)
    entitlements = standin.table(spark, folder, "region").select(
        F.when(F.col("r_name").startswith("A"), "south").otherwise("north").alias("user_group"),
        F.col("r_name").alias("value"),
    )
    fact = marts.entitled_fact(star, entitlements, "south")
    return portable(marts.grouped_measures(star, {"country": "order_geography.country"}, fact))


def late_by_mode(spark: SparkSession, folder: str) -> DataFrame:
    return marts.late_by(star_for(spark, folder))


def discount_effect(spark: SparkSession, folder: str) -> DataFrame:
    return portable(marts.discount_effect(star_for(spark, folder)))


# Summaries -----------------------------------------------------------------------------------


def eda_totals(spark: SparkSession, folder: str) -> DataFrame:
    return portable(
        summary.totals(standin.flat_lines(spark, folder, ["Sales", "Benefit per order"]))
    )


def eda_top_products(spark: SparkSession, folder: str) -> DataFrame:
    flat = standin.flat_lines(spark, folder, ["Product Name", "Sales"])
    return portable(snake(summary.top_groups(flat)))


def eda_top_contribution(spark: SparkSession, folder: str) -> DataFrame:
    flat = standin.flat_lines(spark, folder, ["Product Name", "Sales"])
    return portable(summary.top_contribution(flat))


def eda_status_share(spark: SparkSession, folder: str) -> DataFrame:
    return summary.status_share(standin.flat_lines(spark, folder, ["Delivery Status"]))


def eda_late_risk(spark: SparkSession, folder: str) -> DataFrame:
    return summary.late_rate(standin.flat_lines(spark, folder, ["Late_delivery_risk"]))


def eda_market_sales(spark: SparkSession, folder: str) -> DataFrame:
    flat = standin.flat_lines(spark, folder, ["Market", "Sales"])
    return portable(snake(summary.ranked_sums(flat, "Market")))


# Profiles ------------------------------------------------------------------------------------


def describe_numeric(spark: SparkSession, folder: str) -> DataFrame:
    lines = standin.table(spark, folder, "lineitem")
    found = profile.describe_numeric(
        lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )
    rounded = {c: F.round(c, 3) for c in ["mean", "std", "q25", "q50", "q75"]}
    return found.withColumns(rounded)


def describe_categorical(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["Product Name", "Delivery Status", "Shipping Mode"]
    return profile.describe_categorical(standin.flat_lines(spark, folder, wanted))


def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_profile(standin.dirty_orders(spark, folder))


def frame_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, columns and missing cells of the untidy frame."""
    return profile.census(standin.dirty_orders(spark, folder))


def impute(spark: SparkSession, folder: str) -> DataFrame:
    """Untidy sales and product names filled with median and most frequent value."""
    dirty = standin.dirty_orders(spark, folder)
    typed = cleanse.cleanse(dirty, [cleanse.clean_numbers, cleanse.trim_texts])
    filled = profile.impute(typed, ["Sales"], ["Product Name"])
    return snake(filled.select("Order Id", "Customer Id", "Sales", "Product Name"))


def profile_by_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of the lines, from states of four parts that came one after the other.

    Counts and extremes as they are; for means, deviations, quartiles, distinct values and the values
    that two halves share, whether they are within the stated error of the exact ones.
    """
    lines = standin.table(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", F.col("l_partkey").cast("string").alias("part"), "l_returnflag",
        F.pmod("l_orderkey", F.lit(4)).alias("quarter"),
    )
    columns = lines.drop("quarter")
    kept = sketches.Profile(spark, fresh_path(spark, "profile"))
    for n in (0, 1, 2, 3, 1):
        kept.add(lines.where(F.col("quarter") == n).drop("quarter"), f"q{n}")
    numbers, texts = stage(sketches.describe_numeric(kept.numeric()), "numbers"), kept.text()
    # Where the estimated quartiles lie among all values.
    found = {r["column_name"]: r for r in numbers.collect()}
    marks = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[
                # Equal values have all ranks from `below` to `upto`.
                ((F.count_if(F.col(c) < found[c][q]) / F.count(c) <= p + 0.01) & (F.count_if(F.col(c) <= found[c][q]) / F.count(c) >= p - 0.01)).alias(f"{q}_right")
                for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
            ],
            (F.abs(F.avg(c) / found[c]["mean"] - 1) < 1e-9).alias("mean_right"),
            (F.abs(F.stddev_samp(c) / found[c]["std"] - 1) < 1e-9).alias("std_right"),
            (F.abs(F.countDistinct(c) / found[c]["distinct_values"] - 1) <= 0.05).alias("distinct_right"),
        )
        for c in found
    ]
    judged = columns.agg(F.array(*marks).alias("m")).select(F.inline("m"))
    text_rows = sketches.describe_categorical(texts).join(
        sketches.overlap(kept.text(["q0", "q1"]), kept.text(["q2", "q3"])), "column_name"
    )
    exact = columns.agg(F.countDistinct("part").alias("part"), F.countDistinct("l_returnflag").alias("l_returnflag"))
    half = F.col("quarter") < 2
    both = lines.groupBy("part").agg(F.max(half).alias("a"), F.max(~half).alias("b")).where("a and b").count()
    distinct = exact.first()
    limits = F.when(F.col("column_name") == "part", both).otherwise(distinct["l_returnflag"])
    ones = F.when(F.col("column_name") == "part", distinct["part"]).otherwise(distinct["l_returnflag"])
    text_part = text_rows.select(
        "column_name", "n", F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"),
        *[F.lit(None).cast("boolean").alias(f"{q}_right") for q in ("mean", "std", "q25", "q50", "q75")],
        (F.abs(F.col("distinct_values") / ones - 1) <= 0.05).alias("distinct_right"),
        (F.abs(F.col("common") / limits - 1) <= 0.1).alias("common_right"),
    )
    number_part = numbers.join(judged, "column_name").select(
        "column_name", "n", "min", "max", "mean_right", "std_right", "q25_right", "q50_right", "q75_right", "distinct_right", F.lit(None).cast("boolean").alias("common_right"),
    )
    return number_part.unionByName(text_part)


# Cleansing and validation --------------------------------------------------------------------


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse.cleanse(standin.dirty_orders(spark, folder), cleanse.default_steps(NOW))


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return portable(snake(_cleaned(spark, folder)))


def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, distinct rows and surplus copies."""
    return dedupe.row_census(standin.dirty_orders(spark, folder))


def dedupe_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each order."""
    lines = standin.table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        "l_quantity",
        "l_extendedprice",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
    )
    return dedupe.keep_first(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    )


def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse.score_distribution(_cleaned(spark, folder))


def _mixed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV file with columns of every type, read as text."""
    path = csv.write_flat(standin.mixed_cells(spark, folder), fresh_path(spark, "mixed.csv"))
    return csv.read_flat(spark, path)


def type_census(spark: SparkSession, folder: str) -> DataFrame:
    """The type of each column of a CSV file, from the merged states of two halves of its rows."""
    cells = _mixed_csv(spark, folder)
    half = F.pmod(F.xxhash64("Order Id"), F.lit(2)) == 0
    states = infer.type_states(cells.where(half)).union(infer.type_states(cells.where(~half)))
    types = infer.resolve(infer.merge_states(states))
    return infer.described(types, spark)


def typed_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, distinct rows and surplus copies of a CSV file, by value and by text."""
    cells = _mixed_csv(spark, folder)
    by_value, by_text = dedupe.row_census(infer.infer_types(cells)), dedupe.row_census(cells)
    return by_value.withColumn("told_by", F.lit("value")).union(by_text.withColumn("told_by", F.lit("text")))


def masked_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values of the untidy orders that the masking text hides, by column."""
    return cleanse.masked_counts(standin.dirty_orders(spark, folder))


def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The trimmed delivery statuses in order, with their counts."""
    return cleanse.status_counts(_cleaned(spark, folder))


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the cleansing did, measured while the raw and the cleaned rows are written."""
    cleaner = cleanse.Cleaner.of(standin.dirty_orders(spark, folder))
    return cleaner.write(lambda df: stage(df, "cleaned"), now=NOW)[1]


def custom_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    """The cleansing with own steps: a filter, a rename where the column is there, long lineage."""
    own = [
        *cleanse.default_steps(NOW),
        lambda df: df.where("Sales >= 0"),
        lambda df: reshape.rename_if_present(df, "Delivery Status", "status"),
        lambda df: reshape.rename_if_present(df, "No Such Column", "other"),
        lambda df: reshape.with_record_lineage(df, "manual", NOW, "night job"),
    ]
    cleaner = cleanse.Cleaner.of(standin.dirty_orders(spark, folder))
    kept, _ = cleaner.write(lambda df: stage(df, "own"), own)
    by = ["status", "source_system", "load_date", "loaded_by"]
    return portable(kept.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("Sales").cast("decimal(18,2)")).alias("sales")))


def cleaning_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """Negative numbers and invalid dates per column."""
    cleaned = _cleaned(spark, folder)
    found = [cleanse.negative_counts(cleaned), cleanse.invalid_dates(cleaned)]
    parts = [
        f.select(
            F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.col(f"`{c}`").alias("n")
        )
        for f, kind in zip(found, ["negative", "invalid date"])
        for c in f.columns
    ]
    return union_all(parts)


def _validated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The cleaned rows as written, and the checks made while writing them."""
    cleaned = _cleaned(spark, folder)
    return checks.checked_write(cleaned, checks.standard_checks(cleaned), lambda df: stage(df, "cleaned"))


def validation_checks(spark: SparkSession, folder: str) -> DataFrame:
    observed = F.round("observed", 6).alias("observed")
    return _validated(spark, folder)[1].select("check_name", "severity", "passed", observed)


def validation_verdict(spark: SparkSession, folder: str) -> DataFrame:
    written, found = _validated(spark, folder)
    perfect = cleanse.score_summary(written).select("perfect_records").scalar()
    return checks.verdict(found).select("*", perfect.alias("perfect_records"))


# Audits --------------------------------------------------------------------------------------


def fk_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Foreign keys of the star, and of source tables some of whose parents are taken away."""
    star = star_for(spark, folder)
    found = [
        constraints.audit_foreign_key(
            constraints.ForeignKey("order_items", column, dim, key), star
        )
        for column, dim, key in STAR_FOREIGN_KEYS
    ]
    source = {
        "lineitem": standin.table(spark, folder, "lineitem"),
        "orders": standin.table(spark, folder, "orders"),
        "solvent_customer": standin.table(spark, folder, "customer").where("c_acctbal >= 0"),
        "small_part": standin.table(spark, folder, "part").where("p_size <= 25"),
        "order_items": star["order_items"],
        "some_customers": star["dim_customer"].where("customer_id % 5 <> 0"),
    }
    declared = [
        constraints.ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
        constraints.ForeignKey("lineitem", "l_partkey", "small_part", "p_partkey"),
        constraints.ForeignKey("orders", "o_custkey", "solvent_customer", "c_custkey"),
        constraints.ForeignKey("order_items", "customer_key", "some_customers", "customer_key"),
    ]
    found += [constraints.audit_foreign_key(fk, source) for fk in declared]
    return union_all(found)


def check_audit(spark: SparkSession, folder: str) -> DataFrame:
    """NOT NULL, length, domain and CHECK rules on staging and source tables."""
    orders = standin.orders(spark, folder)
    lines = standin.table(spark, folder, "lineitem")
    dates = standin.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    dated = left_lookup(lines, dates, {"l_orderkey": "o_orderkey"})
    rules = {
        "stg_oms_orders": constraints.TableRules(
            not_null=["order_id", "customer_id", "customer_lname"],
            lengths={c: text_limit(c) for c in ("customer_fname", "order_city")}
            | {"customer_segment": 8},
            domains={"customer_segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]},
        ),
        "lineitem": constraints.TableRules(
            not_null=["l_orderkey"],
            domains={"l_returnflag": ["A", "N"]},
            checks={
                "ship_after_order": "l_shipdate >= o_orderdate",
                "sales_not_negative": "l_extendedprice >= 0",
                "quantity_range": "l_quantity BETWEEN 1 AND 45",
            },
        ),
    }
    tables = {"stg_oms_orders": orders, "lineitem": dated}
    return union_all(
        [constraints.audit_rows(t, df, rules[t]) for t, df in tables.items()]
    )


def unique_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Unique keys, single and composite."""
    wanted = [
        ("lineitem", ["l_orderkey", "l_linenumber"]),
        ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]),
        ("part", ["p_name"]),
        ("orders", ["o_orderkey"]),
    ]
    found = [
        constraints.audit_unique(t, standin.table(spark, folder, t), key) for t, key in wanted
    ]
    return union_all(found)


def kept_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of unique and foreign keys after two batches, each judged from what changed.

    The first batch brings most rows; the second brings the other customers, takes some away with
    and without their orders, and gives some orders to another customer.
    """
    customers = standin.table(spark, folder, "customer").selectExpr("c_custkey", "c_custkey % 1400 AS phone")
    orders = standin.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    audit = kept_audits.KeptAudit(
        spark, fresh_path(spark, "kept_audit"),
        {"customer": [["c_custkey"], ["phone"]], "orders": [["o_orderkey"], ["o_custkey", "o_orderpriority"]]},
        [constraints.ForeignKey("orders", "o_custkey", "customer", "c_custkey")],
    )
    Change = kept_audits.Change
    audit.apply({"customer": Change(customers.where("c_custkey % 7 <> 0")), "orders": Change(orders)})
    moved = orders.where("o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0")
    given = moved.withColumn("o_custkey", F.col("o_custkey") + 1)
    return audit.apply(
        {
            "customer": Change(customers.where("c_custkey % 7 = 0"), customers.where("c_custkey % 7 <> 0 AND c_custkey % 5 = 0")),
            "orders": Change(given, orders.where("o_orderkey % 11 = 0").unionByName(moved)),
        }
    )


def retail_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule of the retail system that its stand-in tables can break."""
    return constraints.audit(
        retail.retail_tables(spark, folder), retail_rules.rules(), retail_rules.foreign_keys()
    )


def delete_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Delete the customers in debt: what each foreign key does, and the rows left."""
    tables = retail.retail_tables(spark, folder, ["CUSTOMER", "TRANSACTION", "LOYALTY_POINT"])
    debtors = tables["CUSTOMER"].where("total_points < 0").select("customer_id")
    result = constraints.delete_parents(
        tables, retail_rules.foreign_keys(), retail_rules.primary_keys(), "CUSTOMER", debtors
    )
    left = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.lit("rows with a customer").alias("rule"),
            F.lit("AFTER").alias("action"),
            F.count("customer_id").alias("affected"),
        )
        for name, df in result.tables.items()
    ]
    return union_all([result.report, *left])


def delete_restricted(spark: SparkSession, folder: str) -> DataFrame:
    """Delete the small products: their variants forbid it."""
    tables = retail.retail_tables(spark, folder, ["PRODUCT", "PRODUCT_VARIANT"])
    small = tables["PRODUCT"].where("category = 'Kids'").select("product_id")
    return constraints.delete_parents(
        tables, retail_rules.foreign_keys(), retail_rules.primary_keys(), "PRODUCT", small
    ).report


def delete_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Delete some customers where orders go with their customer, and customers with their first order.

    What each key did over all rounds, and the rows left with the sum of their keys.
    """
    tables = {
        "client": standin.table(spark, folder, "customer").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 + 3 END AS first_order"),
        "purchase": standin.table(spark, folder, "orders").selectExpr("o_orderkey AS id", "o_custkey AS client_id"),
    }
    cascades = [
        constraints.ForeignKey("purchase", "client_id", "client", "id", "CASCADE"),
        constraints.ForeignKey("client", "first_order", "purchase", "id", "CASCADE"),
    ]
    some = tables["client"].where("id % 97 = 1").select("id")
    result = constraints.delete_parents(tables, cascades, {"client": "id", "purchase": "id"}, "client", some)
    done = result.report.select("table_name", "action", F.col("affected").alias("n"), F.lit(0).cast("bigint").alias("key_sum"))
    left = [
        df.agg(F.lit(name).alias("table_name"), F.lit("LEFT").alias("action"), F.count("*").alias("n"),
               F.sum("id").alias("key_sum"))
        for name, df in result.tables.items()
    ]
    return union_all([done, *left])


# Change --------------------------------------------------------------------------------------


def scd2_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of each customer's priority and status, from their orders."""
    orders = standin.table(spark, folder, "orders")
    found = change.history(
        orders, ["o_custkey"], ["o_orderpriority", "o_orderstatus"], "o_orderdate", ["o_orderkey"]
    )
    return portable(found)


def scd2_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A first load of customers, then a snapshot with changed segments and new customers.

    An earlier snapshot of the same day, with other changes, leaves no trace.
    """
    customers = standin.table(spark, folder, "customer")
    first = customers.select("c_custkey", "c_name", "c_mktsegment")
    dim = change.with_open_history(first, F.lit(date(2024, 1, 1)))
    moved = customers.select(
        F.when(F.col("c_nationkey") == 7, F.col("c_custkey") + 10_000_000)
        .otherwise(F.col("c_custkey"))
        .alias("c_custkey"),
        "c_name",
        F.when(F.col("c_acctbal") < 0, "RISK")
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )
    wrong = moved.withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, "DRAFT").otherwise(F.col("c_mktsegment"))
    )
    compared, day = ["c_name", "c_mktsegment"], date(2024, 6, 1)
    draft = stage(change.apply_snapshot(dim, wrong, ["c_custkey"], compared, day), "history")
    return portable(change.apply_snapshot(draft, moved, ["c_custkey"], compared, day))


def _segment_days(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The n-th snapshot of the customers: some are missing, and some have another segment."""
    c = standin.table(spark, folder, "customer").where(F.col("c_custkey") % (n + 2) != 0)
    other = (F.col("c_custkey") % 7 + n) % 3 == 0
    return c.select("c_custkey", F.when(other, F.lit("OTHER")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


def scd2_late_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Customer history from snapshots of six days that come out of order, one of them twice."""
    key, compared = ["c_custkey"], ["c_mktsegment"]
    empty = _segment_days(spark, folder, 0).limit(0)
    found = change.seen_history(
        empty.withColumn("day", F.lit(date(2020, 1, 1))), key, compared, "day", ["day"]
    )
    for n in (3, 5, 0, 4, 1, 2):
        day = date(2020, 1, 1 + n)
        if n == 4:
            wrong = _segment_days(spark, folder, n).withColumn("c_mktsegment", F.lit("WRONG"))
            found = stage(change.put_snapshot(found, wrong.where("c_custkey % 6 <> 0"), key, compared, day), "history")
        found = stage(change.put_snapshot(found, _segment_days(spark, folder, n), key, compared, day), "history")
    return portable(found.withColumn("seen", F.array_join("seen", ",")))


def revenue_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by the segment of the customer that was valid on the day of shipping.

    Segments are told by every fourth order (its priority); one customer has a third of all orders,
    and the first versions begin later than some lines.
    """
    custkey = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")).alias("custkey")
    orders = standin.table(spark, folder, "orders")
    told = orders.where("o_orderkey % 4 = 0").select(
        custkey, F.col("o_orderpriority").alias("segment"), "o_orderdate", "o_orderkey"
    )
    segments = stage(change.history(told, ["custkey"], ["segment"], "o_orderdate", ["o_orderkey"]), "segments")
    lines = left_lookup(
        standin.table(spark, folder, "lineitem").select(
            "l_orderkey", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").cast("decimal(12,2)").alias("sales"),
        ),
        orders.select("o_orderkey", custkey), {"l_orderkey": "o_orderkey"},
    ).select("custkey", "day", "sales")
    found = asof.valid_version(lines, segments, {"custkey": "custkey"}, "day", ["segment"])
    return portable(found.groupBy("segment").agg(F.count("*").alias("lines"), F.sum("sales").alias("sales")))


def upsert_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a batch of changed and new ones applied, twice."""
    target = standin.table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    batch = standin.table(spark, folder, "customer").select(
        F.when(F.col("c_nationkey") < 3, F.col("c_custkey") + 10_000_000)
        .otherwise(F.col("c_custkey"))
        .alias("c_custkey"),
        F.upper("c_name").alias("c_name"),
        F.abs("c_acctbal").alias("c_acctbal"),
        "c_nationkey",
    )
    batch = batch.where("c_nationkey < 6").drop("c_nationkey")
    once = change.upsert(target, batch, ["c_custkey"])
    return change.upsert(once, batch, ["c_custkey"])


def _arrive(df: DataFrame, folder: str) -> None:
    """New files of `df` in a watched folder."""
    write_parquet(df, folder, "append")


def _third(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(3)) == n


def incremental_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines streamed into a table that keeps the first line of each order.

    Orders grow in later files, are sent again, and are read again after the checkpoint is lost.
    """
    lines = standin.table(spark, folder, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    watched, target = fresh_path(spark, "order_files"), fresh_path(spark, "order_table")
    begun = dedupe.first_match(lines, ["l_orderkey"], order).select(*lines.columns)
    for arrived in (
        begun.where(_third("l_orderkey", 0)),
        lines.where(_third("l_orderkey", 0) | _third("l_orderkey", 2)),
        lines.where(~_third("l_orderkey", 2)),
    ):
        _arrive(arrived, watched)
        loaded = incremental.append_new(
            spark, watched, lines.schema, target, fresh_path(spark, "order_checkpoint"),
            key=["l_orderkey"], order=order,
        )
    return loaded.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def incremental_orders_once(spark: SparkSession, folder: str) -> DataFrame:
    """As `incremental_orders`; lines sent again are dropped as they arrive."""
    lines = standin.table(spark, folder, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    watched, target = fresh_path(spark, "order_files"), fresh_path(spark, "order_table")
    kept = fresh_path(spark, "order_checkpoint")
    begun = dedupe.first_match(lines, ["l_orderkey"], order).select(*lines.columns)
    for arrived, checkpoint in (
        (begun.where(_third("l_orderkey", 0)), kept),
        (lines.where(_third("l_orderkey", 0) | _third("l_orderkey", 2)), kept),
        (lines.where(~_third("l_orderkey", 2)), fresh_path(spark, "order_checkpoint")),
    ):
        _arrive(arrived, watched)
        loaded = incremental.append_once(
            spark, watched, lines.schema, target, checkpoint, key=["l_orderkey"], order=order,
        )
    return loaded.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def incremental_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events streamed into a table with the last event of each user; late files come last.

    The second call goes on from the checkpoint, the third has lost it.
    """
    events = standin.table(spark, folder, "events")
    watched, root = fresh_path(spark, "event_files"), fresh_path(spark, "event_table")
    mark = fresh_path(spark, "event_checkpoint")
    day = F.pmod(F.dayofmonth("ts"), F.lit(3))
    for n, checkpoint in ((2, mark), (0, mark), (1, fresh_path(spark, "event_checkpoint"))):
        _arrive(events.where(day == n), watched)
        loaded = incremental.upsert_new(
            spark, watched, events.schema, root, checkpoint, key=["user_id"],
            latest=["ts", "event_id"], files_per_batch=64,
        )
    return loaded.select("user_id", "event_id", "event_type", "value")


def _one_in(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)) == 0


def _live_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Items, orders and shipments streamed into staging, and a star refreshed after each arrival.

    Nearly everything comes first. What comes later belongs to orders of one quarter: a part of the
    orders is late, others had another date before, or grow by a line; some lines stood under another
    product, some shipments had another status; some rows come again as they were.
    """
    items, orders, shipments = inputs(spark, folder)
    placed = (F.year("order_date") == 1996) & (F.quarter("order_date") == 2)
    quarter = stage(orders.where(placed).select(F.col("order_id").alias("_order")), "quarter")

    def marked(df: DataFrame) -> DataFrame:
        here = quarter.withColumn("_here", F.lit(True))
        return left_lookup(df, here, {"order_id": "_order"})

    def split(df: DataFrame, key: str, column: str, wrong: Column) -> tuple[DataFrame, DataFrame]:
        """The rows as they come first, some with a wrong value in `column`, and what comes later."""
        here = F.col("_here").isNotNull()
        all_rows = marked(df)
        missing, changed, again = (here & _one_in(key, n) for n in (3, 5, 7))
        first = all_rows.where(~missing).withColumns(
            {column: F.when(changed, wrong).otherwise(F.col(column)), "load_timestamp": F.lit(NOW - timedelta(days=1))}
        )
        return first.drop("_here"), all_rows.where(missing | changed | again).drop("_here")

    staged_items = split(items, "order_item_id", "product_id", F.col("product_id") % 7 + 1)
    staged_orders = split(orders, "order_id", "order_date", F.date_sub("order_date", 30))
    staged_shipments = split(shipments, "shipment_id", "delivery_status", F.lit("Unknown"))
    arrivals = list(zip(staged_items, staged_orders, staged_shipments))
    paths = {n: (fresh_path(spark, f"{n}_files"), fresh_path(spark, n)) for n in ("items", "orders", "shipments")}
    root = fresh_path(spark, "live_star")

    def load(name: str, arrived: DataFrame, key: str, *more: str) -> Callable[[], incremental.Table]:
        watched, target = paths[name]

        def run() -> incremental.Table:
            _arrive(arrived, watched)
            return incremental.upsert_into(
                spark, watched, arrived.schema, target, fresh_path(spark, "checkpoint"), key=[key],
                latest=["load_timestamp", *more],
            )

        return run

    for some_items, some_orders, some_shipments in arrivals:
        staged = together(
            load("items", some_items, "order_item_id", "sales"),
            load("orders", some_orders, "order_id"),
            load("shipments", some_shipments, "shipment_id"),
        )
        star = live.refresh(spark, *staged, root)
    return star


def live_star_for(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return _once(spark, folder, "live star", lambda: _live_star(spark, folder))


def incremental_star(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by department and year of a star kept up by what changed."""
    by = {"department_name": "product.department_name", "year": "order_date.year"}
    return portable(marts.grouped_measures(live_star_for(spark, folder), by))


def incremental_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the fact kept up by what changed; each key is shown as what it stands for."""
    star = live_star_for(spark, folder)
    return _shown(star["order_items"], star)


def hot_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by part name; one part and no part at all own a third of the lines each.

    The size below which a lookup is left to Spark is zero here, so hot keys are looked for, and
    spread if the names are too many to broadcast.
    """
    key = F.col("l_orderkey") % 3
    lines = standin.table(spark, folder, "lineitem").select(
        F.when(key == 0, F.lit(1)).when(key == 1, None).otherwise(F.col("l_partkey")).cast("bigint").alias("part"),
        "l_quantity",
    )
    names = standin.table(spark, folder, "part").select("p_partkey", "p_name")
    found = left_lookup(lines, names, {"part": "p_partkey"}, floor=0, broadcast=False)
    return found.groupBy("p_name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")
    )


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written as flat CSV, read back in file order, and staged as orders."""
    wanted = [
        "Order Id", "Customer Id", "Customer Segment", "order date (DateOrders)", "Order Status",
        "Order Item Id", "Product Name", "Sales",
    ]
    flat = standin.flat_lines(spark, folder, wanted)
    dated = F.date_format("`order date (DateOrders)`", "M/d/yyyy H:mm")
    path = fresh_path(spark, "flat.csv")
    csv.write_flat(flat.withColumn("order date (DateOrders)", dated), path)
    back = csv.read_flat(spark, path, encoding="ISO-8859-1", file_order=True)
    mapping = {
        "Order Id": "order_id", "Customer Id": "customer_id",
        "Customer Segment": "customer_segment", "order date (DateOrders)": "order_date",
        "Order Status": "order_status",
    }
    first = dedupe.keep_first(
        reshape.map_columns(back, mapping, keep=csv.FILE_ORDER), ["order_id"], csv.FILE_ORDER
    )
    layout = read_layout(
        "order_id STRING, customer_id BIGINT, customer_segment STRING, order_date DATE, "
        "order_status STRING"
    )
    return portable(conform(first, layout))


def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written as two CSV files with their columns in different orders, read as one.

    Names have blanks at their ends and a line end within.
    """
    flat = standin.flat_lines(spark, folder, ["Order Item Id", "Product Name", "Sales", "Order Id"])
    odd = F.concat(F.lit("  "), "Product Name", F.lit("\n x "))
    flat = flat.withColumn("Product Name", odd)
    even = F.pmod(F.xxhash64("Order Id"), F.lit(2)) == 0
    path = fresh_path(spark, "mixed")
    csv.write_flat(flat.where(even), f"{path}/a.csv")
    csv.write_flat(flat.where(~even).select(*reversed(flat.columns)), f"{path}/b.csv")
    back = csv.read_flat(spark, f"{path}/*.csv", multi_line=True)
    return snake(back.select("Order Item Id", "Product Name", "Sales"))


def staging_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of the untidy orders that the staging load can't convert, by table and column."""
    path = f"{fresh_path(spark, 'untidy')}.csv"
    csv.write_flat(standin.dirty_orders(spark, folder), path)
    return ingest.staging_failures(spark, path, encoding="UTF-8")


def warehouse_writes(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back after each kind of write: loads, reloads, versions, and emptied tables.

    For every column its NULLs and a digest of its values, and for `*` the rows. Orders without id
    count among the rows only: which one of them a load keeps depends on their order in the file.
    """
    path = fresh_path(spark, "writes")
    csv.write_flat(standin.dirty_orders(spark, folder), f"{path}/in.csv")
    cleaner = cleanse.Cleaner(spark, f"{path}/in.csv")
    cleaner.run(now=NOW)
    newest = csv.newest_file(spark, path)
    found = {"newest cleaned file": csv.read_flat(spark, newest)}

    staging = f"{path}/staging"
    for _ in range(2):  # a second load replaces the first
        loaded = ingest.load_staging(spark, newest, staging, "UTF-8", csv.WRITTEN_TIME_FORMAT, NOW)
    # Read before the tables are emptied.
    found |= {f"loaded {name}": stage(df, name) for name, df in loaded.items()}
    root = f"{path}/versions"
    for _ in range(2):
        ingest.load_staging_version(spark, newest, root, "UTF-8", csv.WRITTEN_TIME_FORMAT, NOW)
    found |= {f"newest version of {name}": tables.read_version(spark, root, name) for name in loaded}
    tables.append(loaded["stg_oms_orders"], f"{path}/appended")
    tables.append(loaded["stg_oms_orders"], f"{path}/appended")
    found["appended twice"] = tables.read(spark, f"{path}/appended")
    ingest.empty_staging(spark, staging)
    found |= {
        f"emptied {name}": tables.read(spark, f"{staging}/{name}") for name in loaded
    }
    emptied = empty_star(spark, f"{path}/star")
    found["emptied fact"] = tables.read_version(spark, f"{path}/star", "order_items", emptied)
    sales, logistics = ingest.write_services(csv.read_flat(spark, newest), newest)
    found |= {"sales file": csv.read_flat(spark, sales), "logistics file": csv.read_flat(spark, logistics)}
    numbers = ["Sales", "Order Item Quantity", "data_quality_score"]

    def values(df: DataFrame) -> DataFrame:
        if "customer_fname" in df.columns:
            return df.where("order_id IS NOT NULL")
        return df.withColumns({c: to_number(F.col(f"`{c}`")) for c in numbers if c in df.columns})

    parts = []
    for written, df in found.items():
        rows = df.agg(
            F.lit("*").alias("column_name"), F.count(F.lit(1)).alias("rows_read"), F.lit(0).cast("bigint").alias("nulls"),
            F.lit("0").alias("digest"),
        )
        both = rows if written.startswith("emptied") else rows.unionByName(digest.column_digests(values(df)))
        parts.append(both.withColumn("written", F.lit(written)))
    return union_all(parts)


def load_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The two source tables, replaced from one CSV after another, read back by value.

    The file has all columns the tables need; those that the data lacks are NULL.
    """
    wanted = [*reshape.SOURCE_ORDERS, *reshape.SOURCE_SHIPPING]
    flat = standin.flat_lines(spark, folder, standin.flat_columns())
    cleaned = reshape.clean_names(flat)
    texts = cleaned.select(
        *[F.col(c).cast("string") for c in cleaned.columns if c in wanted],
        *[F.lit(None).cast("string").alias(c) for c in dict.fromkeys(wanted) if c not in cleaned.columns],
    )
    path = fresh_path(spark, "sources")
    csv.write_flat(texts.limit(0), f"{path}/before.csv")
    csv.write_flat(texts, f"{path}/in.csv", "gzip")
    for name in ("before", "in"):
        loaded = ingest.load_sources(spark, f"{path}/{name}.csv", f"{path}/db", "UTF-8")
    return union_all(
        [digest.column_digests(df).withColumn("written", F.lit(name)) for name, df in loaded.items()]
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        stg_orders, stg_order_items, stg_shipments, load_defaults, table_defaults, split_services,
        dim_department, dim_category, dim_product, dim_customer, dim_geography, dim_date,
        dim_shipping, surrogate_keys,
        fact_one_match, fact_as_written, fact_fanout,
        star_revenue, star_products, star_calendar, star_filtered, star_clustered, star_entitled, late_by_mode,
        discount_effect,
        eda_totals, eda_top_products, eda_top_contribution, eda_status_share, eda_late_risk,
        eda_market_sales,
        describe_numeric, describe_categorical, profile_by_parts, null_profile, frame_shape, impute,
        clean_orders, dedupe_rows, dedupe_keep_first, status_counts, quality_score,
        cleaning_report, custom_cleaning, cleaning_warnings, validation_checks, validation_verdict,
        fk_audit, check_audit, unique_audit, kept_audit, retail_audit, delete_actions, delete_restricted, delete_cycle,
        scd2_customer, scd2_snapshot, scd2_late_snapshots, revenue_by_segment, upsert_customer,
        incremental_orders, incremental_orders_once, incremental_events, incremental_star, incremental_fact, hot_key_lookup, csv_round_trip,
        csv_mixed_headers, staging_failures, type_census, typed_duplicates, masked_values, warehouse_writes, load_sources,
    ]
}
