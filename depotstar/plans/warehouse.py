"""From staging tables to the star: seven dimensions with keys, then the fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from depotstar.operators import dims as d
from depotstar.operators.fact import MONTH, packed_order_items, unpacked_order_items
from depotstar.operators.keys import assign_keys
from depotstar.schemas import STAGING, WAREHOUSE
from depotstar.session import fresh_path, stage, together
from depotstar.sources import tables
from depotstar.sources.files import remove

FACT = "order_items"


def keyed(rows: DataFrame, table: str) -> DataFrame:
    """A dimension in table layout with its surrogate key."""
    key = d.SURROGATE_KEYS[table]
    return d.to_layout(assign_keys(rows, d.NATURAL_KEYS[table], key), table)


def _dimension_frames(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    one_match: bool,
) -> dict[str, DataFrame]:
    """All dimensions with their keys; independent ones at the same time."""

    def products() -> dict[str, DataFrame]:
        seen = stage(d.item_attributes(items), "item_attributes")
        department = keyed(d.department_rows(seen), "dim_department")
        category = keyed(d.category_rows(seen, department, one_match), "dim_category")
        product = keyed(d.product_rows(seen, category, one_match), "dim_product")
        return {"dim_department": department, "dim_category": category, "dim_product": product}

    def single(table: str, rows: DataFrame) -> Callable[[], dict[str, DataFrame]]:
        return lambda: {table: keyed(rows, table)}

    built = together(
        products,
        single("dim_customer", d.customer_rows(orders)),
        single("dim_geography", d.geography_rows(orders, shipments)),
        single("dim_date", d.date_rows(orders, shipments)),
        single("dim_shipping", d.shipping_rows(shipments)),
    )
    return {t: df for part in built for t, df in part.items()}


def build_dimensions(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    path: str,
    one_match: bool = True,
) -> dict[str, DataFrame]:
    """Write the dimensions below `path` and return them as read back.

    Read back from files, a dimension has a known size: Spark broadcasts those under the session's
    limit and shuffles for the others.
    """
    spark = items.sparkSession
    frames = _dimension_frames(items, orders, shipments, one_match)

    def write(table: str) -> Callable[[], None]:
        return lambda: tables.replace(frames[table], f"{path}/{table}")

    together(*[write(t) for t in frames])
    return {t: spark.read.schema(WAREHOUSE[t]).parquet(f"{path}/{t}") for t in frames}


def build_star(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    path: str,
    one_match: bool = True,
    fact_key: bool = False,
) -> dict[str, DataFrame]:
    """Write all eight tables below `path` and return them as read back.

    The fact is partitioned by order year and month, so that queries on some read only those.
    `fact_key` adds `order_item_key` 1..n. It costs a sort of the whole fact by `order_item_id`,
    which identifies a row already, and is therefore off unless asked for.
    """
    star = build_dimensions(items, orders, shipments, path, one_match)
    months = ["order_year", "order_month"]
    spark = items.sparkSession
    between = fresh_path(spark, "items_by_id")
    packed = packed_order_items(items, orders, shipments, star, one_match, path=between)
    # Rows of a month meet in few files; a month too large for one task is spread over several.
    if fact_key:
        fact = unpacked_order_items(packed)
        fact = assign_keys(fact, fact.columns, "order_item_key").hint("rebalance", *months)
    else:
        fact = unpacked_order_items(packed.hint("rebalance", MONTH))
    tables.replace(fact, f"{path}/{FACT}", months)
    remove(spark, between)
    star[FACT] = spark.read.schema(fact.schema).parquet(f"{path}/{FACT}")
    return star


def write_star(
    items: DataFrame,
    orders: DataFrame,
    shipments: DataFrame,
    root: str,
    one_match: bool = True,
    fact_key: bool = False,
) -> dict[str, DataFrame]:
    """A star in a new version below `root`, visible only when all its tables are there."""
    spark = items.sparkSession
    version = tables.next_version(spark, root)
    path = tables.version_path(root, version)
    star = build_star(items, orders, shipments, path, one_match, fact_key)
    tables.finish(spark, root, version)
    return star


def build_star_version(
    spark: SparkSession,
    staging: str,
    root: str,
    one_match: bool = True,
    fact_key: bool = False,
) -> int:
    """Full reload of the warehouse from staging tables; returns the version."""
    src = {t: spark.read.schema(s).parquet(f"{staging}/{t}") for t, s in STAGING.items()}
    write_star(
        src["stg_oms_order_items"], src["stg_oms_orders"], src["stg_slms_shipments"], root,
        one_match, fact_key,
    )
    return tables.versions(spark, root)[-1]


def empty_star(spark: SparkSession, root: str) -> int:
    """A version of the warehouse with all eight tables and no rows."""
    return tables.write_version(
        spark, root, {t: spark.createDataFrame([], s) for t, s in WAREHOUSE.items()}
    )


def temporary_star(
    items: DataFrame, orders: DataFrame, shipments: DataFrame, one_match: bool = True
) -> dict[str, DataFrame]:
    """A star in the session's shared folder."""
    path = fresh_path(items.sparkSession, "star")
    return build_star(items, orders, shipments, path, one_match)
