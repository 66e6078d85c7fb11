"""Digests that tell whether two tables hold the same values, whatever their order.

A column's digest is the sum of 60-bit hashes of its values as text. Sums of parts add up to that of
the whole, rows need no order, and a value that occurs twice counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions.sqltext import name, text

# Mask of the pieces in which hashes are summed.
_PIECE = (1 << 20) - 1


def value_text(column: str, kind: T.DataType) -> str:
    """SQL: a value as the text that other engines write, too; fractions with six places."""
    c = name(column)
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return f"cast(cast({c} as decimal(38,6)) as string)"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
    if isinstance(kind, T.DateType):
        return f"date_format({c}, 'yyyy-MM-dd')"
    return f"cast({c} as string)"


def column_digests(df: DataFrame) -> DataFrame:
    """(column_name, rows_read, nulls, digest) for each column, from one pass.

    Each task turns a row into one text per column and sums these by column: code that is short however
    many columns there are, so that the JVM compiles it. Hashes are whole numbers, summed in three
    pieces of 20 bits; only the sums are decimals.
    """
    texts = ", ".join(value_text(f.name, f.dataType) for f in df.schema.fields)
    names = ", ".join(text(f.name) for f in df.schema.fields)
    hashed = "cast(conv(substr(md5(cast(col as binary)), 1, 15), 16, 10) as bigint) as h"
    cells = df.selectExpr(f"posexplode(array({texts}))").selectExpr("pos", hashed)
    pieces = [f"coalesce(sum(shiftright(h, {at}) & {_PIECE}), 0) as s{i}" for i, at in enumerate((40, 20, 0))]
    sums = cells.groupBy("pos").agg(*map(F.expr, ["count(1) as n", "count(1) - count(h) as nulls", *pieces]))
    s0, s1, s2 = (f"cast(found[i].s{i} as decimal(19,0))" for i in range(3))
    high = f"cast({s0} * 1048576 + {s1} as decimal(28,0))"
    digest = f"cast(cast({high} * 1048576 + {s2} as decimal(38,0)) as string)"
    # One row of all sums, also where the table has none.
    whole = sums.selectExpr("map_from_entries(collect_list(struct(pos, struct(n, nulls, s0, s1, s2)))) as found")
    return whole.selectExpr(
        f"""inline(transform(array({names}), (c, i) -> struct(
            c as column_name, coalesce(found[i].n, 0L) as rows_read, coalesce(found[i].nulls, 0L) as nulls,
            coalesce({digest}, '0') as digest)))"""
    )
