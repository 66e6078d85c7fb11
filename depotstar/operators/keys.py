"""Surrogate keys 1..n that come out the same on every run."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotstar.operators.joins import left_lookup
from depotstar.session import stage

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def assign_keys(df: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    """Number the rows 1..n in natural key order, NULLs first; `natural_key` must be unique.

    One range shuffle sorts the rows. Each task numbers its own range while writing it to the
    shared folder; the starting number of a range follows from the row counts of the ranges
    before it. Range limits do not show in the result, and no task sees more than one range.
    """
    placed = stage(
        df.orderBy(*natural_key).withColumn("_pos", F.monotonically_increasing_id()), key
    )
    part = F.shiftright("_pos", _PARTITION_BIT)
    row = F.col("_pos").bitwiseAND((1 << _PARTITION_BIT) - 1) + 1
    starts = range_starts(placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")))
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select((F.col("_start") + row).alias(key), *df.columns)


def extend_keys(rows: DataFrame, known: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    """`rows` with the keys they have in `known`; others get the next numbers, in natural key order.

    `natural_key` is unique on both sides, NULL equals NULL. Keys once given stay.
    """
    same = {c: c for c in natural_key}
    met = stage(left_lookup(rows, known.select(*natural_key, key), same, null_safe=True), key)
    new = met.where(F.col(key).isNull())
    if new.isEmpty():
        return met
    last = known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = assign_keys(new.drop(key), natural_key, key)
    fresh = fresh.withColumn(key, (F.col(key) + last).cast(known.schema[key].dataType))
    return met.where(F.col(key).isNotNull()).unionByName(fresh)


def range_starts(sizes: DataFrame) -> DataFrame:
    """(_part, _start): rows before each range, from (_part, _n).

    There is one row per written range, as many as the session has shuffle partitions at most, so
    the sums are made on the driver.
    """
    counted = sorted((r["_part"], r["_n"]) for r in sizes.collect())
    before = accumulate((n for _, n in counted), initial=0)
    starts = [(part, start) for (part, _), start in zip(counted, before)]
    return sizes.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
