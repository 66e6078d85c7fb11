"""Rows placed along a space-filling curve of several columns.

Each column is cut into slices of about equally many rows, and the bits of the slice numbers are
interleaved. Rows near each other on the curve are near in every column, so the files and row groups
written along it hold a narrow range of each, and a filter on any one column skips most of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotstar.functions.sqltext import name
from depotstar.session import write_parquet


def _slice(column: str, bounds: list) -> Column:
    """Number of bounds below the value; NULL is in the first slice."""
    tests = [f"if({name(column)} > {b}D, 1, 0)" for b in bounds]
    return F.expr(f"coalesce({' + '.join(tests) or '0'}, 0)")


def curve(df: DataFrame, columns: list[str], bits: int = 4) -> Column:
    """The place of a row on the curve, from 2 ** bits slices of each numeric column.

    The limits of the slices come from one pass over the columns, by a quantile sketch; they are all
    that reaches the driver. A value with many rows fills whole slices.
    """
    points = [i / (1 << bits) for i in range(1, 1 << bits)]
    wanted = f"array({', '.join(map(str, points))})"
    row = df.selectExpr(
        *[f"percentile_approx(cast({name(c)} as double), {wanted}, 1000) as b{i}" for i, c in enumerate(columns)]
    ).first()
    slices = [_slice(c, sorted(set(row[f"b{i}"] or []))) for i, c in enumerate(columns)]
    place = F.lit(0).cast("bigint")
    for i, s in enumerate(slices):
        for bit in range(bits):
            part = F.shiftright(s, bit).bitwiseAND(1).cast("bigint")
            place = place + F.shiftleft(part, bit * len(slices) + i)
    return place


def write_clustered(
    df: DataFrame, path: str, columns: list[str], files: int, bits: int = 4, partitions: list[str] | None = None,
    pack: Callable[[DataFrame, tuple[str, ...]], DataFrame] | None = None,
    unpack: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a table along the curve of `columns`, in about `files` files, within its partitions.

    Rows of one place on the curve are spread by a hash, so a frequent combination of values does not
    make one file large. Parquet keeps the least and greatest value of each column by row group.
    Rows are shuffled as `pack` makes them, with the columns that it is given beside, and written as
    `unpack` gives them back.
    """
    whole = df.withColumn("_place", curve(df, columns, bits))
    order = [*(partitions or []), "_place"]
    spread = F.hash(*[F.col(name(c)) for c in df.columns])
    own = whole.withColumn("_spread", spread)
    if pack:
        own = pack(own, (*order, "_spread"))
    placed = own.repartitionByRange(files, *order, "_spread")
    sorted_rows = placed.sortWithinPartitions(*order).drop("_place", "_spread")
    if unpack:
        sorted_rows = unpack(sorted_rows)
    write_parquet(sorted_rows, path, "overwrite", partitions)


def share_read(df: DataFrame, column: str, low, high) -> DataFrame:
    """One row, `share`: the files of a written table whose range of a column meets low to high."""
    ranges = df.groupBy(F.col("_metadata.file_path")).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    meets = (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    return ranges.agg((F.count_if(meets) / F.count(F.lit(1))).alias("share"))
