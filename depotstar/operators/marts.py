"""Queries over the star: filters, entitlements and grouped measures.

Measures are summed per dimension key before any dimension is joined. The join input is then the
size of the dimensions, and a key with a large share of the fact is one row per task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotstar.functions import percent
from depotstar.operators.joins import broadcast_limit, left_lookup, matching
from depotstar.session import estimated_bytes

# Fact column -> (dimension, its key, columns offered with a prefix where roles repeat).
ROLES = {
    "customer": ("customer_key", "dim_customer", "customer_key"),
    "product": ("product_key", "dim_product", "product_key"),
    "order_date": ("order_date_key", "dim_date", "date_key"),
    "ship_date": ("shipping_date_key", "dim_date", "date_key"),
    "customer_geography": ("customer_geography_key", "dim_geography", "geography_key"),
    "order_geography": ("order_geography_key", "dim_geography", "geography_key"),
    "shipping": ("shipping_key", "dim_shipping", "shipping_key"),
}


def role(star: dict[str, DataFrame], name: str) -> DataFrame:
    """A dimension in one of its roles: the fact's key column, then `<role>.<column>` columns.

    Products come with their category and department.
    """
    fact_key, table, key = ROLES[name]
    dim = star[table]
    if name == "product":
        category = star["dim_category"].join(star["dim_department"], "department_key", "left")
        dim = dim.join(category, "category_key", "left")
    own = [c for c in dim.columns if c != key]
    return dim.select(
        F.col(key).alias(fact_key), *[F.col(c).alias(f"{name}.{c}") for c in own]
    )


def _conditions(
    equals: dict[str, object], one_of: dict[str, list], contains: dict[str, str]
) -> dict[str, list[Column]]:
    """Conditions by role, for filters named `<role>.<column>`; an absent value filters nothing."""
    found: dict[str, list[Column]] = {}
    for name, value in equals.items():
        if value is not None:
            found.setdefault(name.split(".")[0], []).append(F.col(f"`{name}`") == F.lit(value))
    for name, values in one_of.items():
        if values:
            found.setdefault(name.split(".")[0], []).append(F.col(f"`{name}`").isin(values))
    for name, text in contains.items():
        if text:
            test = F.lower(F.col(f"`{name}`")).contains(text.lower())
            found.setdefault(name.split(".")[0], []).append(test)
    return found


def filter_fact(
    star: dict[str, DataFrame],
    equals: dict[str, object] | None = None,
    one_of: dict[str, list] | None = None,
    contains: dict[str, str] | None = None,
    clustered: tuple[str, ...] = (),
) -> DataFrame:
    """Fact rows that meet dashboard filters: dropdown, checkbox list, text (any letter case).

    Each filter is applied to its dimension and only the keys left over restrict the fact. A filter
    on the order year is also put to the fact's partitions, so other years are not read. For the
    roles in `clustered`, by whose keys the fact was written, the least and greatest key left over are
    looked up first and put to the scan, which then skips row groups.
    """
    fact = star["order_items"]
    years = [y for y in [(equals or {}).get("order_date.year")] if y is not None]
    years = years or (one_of or {}).get("order_date.year") or []
    if years and "order_year" in fact.columns:
        fact = fact.where(F.col("order_year").isin(years))
    for name, tests in _conditions(equals or {}, one_of or {}, contains or {}).items():
        key = ROLES[name][0]
        kept = role(star, name).where(reduce(and_, tests))
        if name in clustered:
            low, high = kept.agg(F.min(key), F.max(key)).first()
            fact = fact.where(F.col(key).between(low, high))
        fact = matching(fact, kept, {key: key}, keys_from=star["order_items"])
    return fact


def entitled_fact(
    star: dict[str, DataFrame],
    entitlements: DataFrame,
    user_group: str,
    on: str = "order_geography.country",
) -> DataFrame:
    """Fact rows a user group may see; `entitlements` has (user_group, value)."""
    name = on.split(".")[0]
    allowed = entitlements.where(F.col("user_group") == user_group).select(
        F.col("value").alias("_allowed")
    )
    dim = role(star, name)
    keys = dim.join(allowed, dim[f"`{on}`"] == allowed["_allowed"], "left_semi")
    return matching(star["order_items"], keys, {ROLES[name][0]: ROLES[name][0]})


def grouped_measures(
    star: dict[str, DataFrame], by: dict[str, str], fact: DataFrame | None = None
) -> DataFrame:
    """Lines, quantity, sales, discount and profit by dimension attributes.

    `by` maps an output column to `<role>.<column>`. Dimensions that Spark broadcasts are looked up
    before the first sums, which are made by their attributes: pairs of keys, of a product and a day
    say, may be as many as there are lines.
    """
    fact = star["order_items"] if fact is None else fact
    roles = list(dict.fromkeys(c.split(".")[0] for c in by.values()))
    wanted = {r: [c for c in dict.fromkeys(by.values()) if c.split(".")[0] == r] for r in roles}
    dims = {r: role(star, r).select(ROLES[r][0], *[F.col(f"`{c}`") for c in wanted[r]]) for r in roles}
    small = [r for r in roles if estimated_bytes(dims[r]) <= broadcast_limit(fact)]
    keys = []
    for r in roles:
        key = ROLES[r][0]
        if r in small:
            fact = left_lookup(fact, dims[r], {key: key}, keys_from=star["order_items"])
            keys += [F.col(f"`{c}`") for c in wanted[r]]
        else:
            keys.append(F.col(key))
    sums = {
        "quantity": "order_item_quantity",
        "sales": "sales",
        "discount": "order_item_discount",
        "profit": "order_item_profit",
    }
    part = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    for r in roles:
        key = ROLES[r][0]
        if r not in small:
            part = left_lookup(part, dims[r], {key: key}, keys_from=star["order_items"])
    return part.groupBy(*[F.col(f"`{c}`").alias(n) for n, c in by.items()]).agg(
        F.sum("lines").alias("lines"), *[F.sum(n).alias(n) for n in sums]
    )


def late_by(star: dict[str, DataFrame], column: str = "shipping_mode") -> DataFrame:
    """Lines and percent of late lines by a shipping attribute."""
    part = star["order_items"].groupBy("shipping_key").agg(F.count(F.lit(1)).alias("lines"))
    part = left_lookup(
        part, star["dim_shipping"], {"shipping_key": "shipping_key"}, keys_from=star["order_items"]
    )
    late = F.sum(F.when(F.col("delivery_risk") == "1", F.col("lines")).otherwise(0))
    return part.groupBy(column).agg(
        F.sum("lines").alias("lines"),
        late.alias("late_lines"),
        percent(late, F.sum("lines")).alias("late_pct"),
    )


def discount_effect(star: dict[str, DataFrame]) -> DataFrame:
    """Lines, sales and profit by discount rate, with the margin in percent."""
    return star["order_items"].groupBy("order_item_discount_rate").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("sales").alias("sales"),
        F.sum("order_item_profit").alias("profit"),
        percent(F.sum("order_item_profit"), F.sum("sales")).alias("margin_pct"),
    )
