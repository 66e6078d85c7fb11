"""Duplicate rows and repeated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of each row; NULLs count as equal. Copies collapse before the shuffle."""
    return df.distinct()


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each repeated row once, with the number of its surplus copies."""
    counted = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where("_n > 1").withColumn("surplus", F.col("_n") - 1).drop("_n")


def count_duplicates(df: DataFrame, name: str = "duplicate_rows") -> DataFrame:
    """One row: rows minus distinct rows."""
    return duplicate_rows(df).agg(F.coalesce(F.sum("surplus"), F.lit(0)).alias(name))


def row_census(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and surplus copies, from one grouping."""
    counted = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    distinct = F.count(F.lit(1))
    return counted.agg(
        rows.alias("n_rows"),
        distinct.alias("distinct_rows"),
        (rows - distinct).alias("duplicate_rows"),
    )


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; the order columns are dropped.

    An aggregate, not a window: every task reduces its own copies of a key first, so a key with a
    large share of the rows costs one row per task in the shuffle.
    """
    kept = [c for c in df.columns if c not in set(order)]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    position = F.struct(*[F.col(f"`{c}`") for c in order])
    keys = [F.col(f"`{c}`").alias(f"_key{i}") for i, c in enumerate(key)]
    first = df.groupBy(*keys).agg(F.min_by(row, position).alias("_row"))
    return first.select("_row.*")


def first_match(df: DataFrame, key: list[str], prefer: list) -> DataFrame:
    """One row per key: the one whose `prefer` values come first."""
    kept = F.struct(*[F.col(c) for c in df.columns if c not in set(key)])
    best = df.groupBy(*key).agg(F.min(F.struct(F.struct(*prefer), kept)).alias("_best"))
    return best.select(*key, "_best.col2.*")
