"""Sales and logistics summaries of the flat frame.

Groups without a name are left out and an all-NULL group sums to zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotstar.functions import percent
from depotstar.operators.profile import value_counts, with_total


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def totals(df: DataFrame) -> DataFrame:
    """One row: revenue, mean sales per line, profit, and the margin in percent."""
    revenue, profit = F.sum("Sales"), F.sum("`Benefit per order`")
    return df.agg(
        revenue.alias("total_revenue"),
        F.avg("Sales").alias("mean_line_sales"),
        profit.alias("total_profit"),
        percent(profit, revenue).alias("margin_pct"),
    )


def group_sums(df: DataFrame, by: str, value: str = "Sales") -> DataFrame:
    """(by, total) per group."""
    named = df.where(_c(by).isNotNull())
    return named.groupBy(_c(by)).agg(F.coalesce(F.sum(_c(value)), F.lit(0)).alias("total"))


def ranked_sums(df: DataFrame, by: str, value: str = "Sales") -> DataFrame:
    """Group sums, the greatest first; equal sums by name."""
    return group_sums(df, by, value).orderBy(F.desc("total"), _c(by))


def top_groups(df: DataFrame, by: str = "Product Name", k: int = 5) -> DataFrame:
    """The k greatest group sums. Each task keeps its own k, so nothing is sorted in full."""
    return ranked_sums(df, by).limit(k)


def top_contribution(df: DataFrame, by: str = "Product Name", k: int = 5) -> DataFrame:
    """One row: sum of the k greatest groups and its share of all sales in percent."""
    # Rows without a name are a group here, so that the groups add up to all sales.
    groups = df.groupBy(_c(by).alias("_name")).agg(F.sum("Sales").alias("total"))
    named = with_total(groups, "total", "_all").where("_name IS NOT NULL")
    ranked = named.withColumn("total", F.coalesce("total", F.lit(0)))
    top = ranked.orderBy(F.desc("total"), "_name").limit(k).agg(
        F.sum("total").alias("top_sales"), F.max("_all").alias("_all")
    )
    return top.select("top_sales", percent(F.col("top_sales"), F.col("_all")).alias("share_pct"))


def status_share(df: DataFrame, column: str = "Delivery Status") -> DataFrame:
    """Share of each value in percent, the most frequent first; NULL does not count."""
    return value_counts(df, column).orderBy(F.desc("n"), "value")


def late_rate(df: DataFrame, flag: str = "Late_delivery_risk") -> DataFrame:
    """One row: percent of rows with the flag set."""
    return df.agg((F.avg(_c(flag).cast("double")) * 100).alias("late_pct"))
