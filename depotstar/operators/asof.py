"""The version of a dimension that is valid on a fact's date.

Versions and facts are brought into one order of key and date, cut into ranges, and the last version
before each fact is carried forward. No join compares dates, and a key with many facts lies in as
many ranges as it needs: within a key and a date, facts are told apart by a hash. What a range does
not know, the last version before its first row, is passed on from the range before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotstar.operators.change import OPEN_END
from depotstar.session import stage

_VERSION, _FACT = 0, 1


def valid_version(
    facts: DataFrame,
    history: DataFrame,
    on: dict[str, str],
    at: str,
    columns: list[str],
    effective: str = "effective_date",
    expiry: str | None = "expiry_date",
    ranges: int | None = None,
) -> DataFrame:
    """`facts` with `columns` of the version whose key `on` (fact column -> history column) equals
    theirs and that is valid on `at`; NULL where there is none.

    A version counts from its effective date on, until the next one or its expiry. A NULL key or date
    meets nothing. Each fact comes out once; columns of equal name are not replaced but an error.
    """
    spark = facts.sparkSession
    keys = [f"_k{i}" for i in range(len(on))]
    until = F.col(expiry) if expiry else F.lit(OPEN_END)
    kind = facts.schema[at].dataType

    version = F.struct(
        F.col(effective).cast(kind).alias("_from"), until.cast("date").alias("_until"),
        *[F.col(c) for c in columns],
    )
    known = history.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on.values())).select(
        *[F.col(c).alias(k) for c, k in zip(on.values(), keys)],
        F.col(effective).cast(kind).alias("_at"), F.lit(_VERSION).alias("_what"), F.lit(0).cast("bigint").alias("_tie"),
        version.alias("_version"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    asked = facts.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.col(at).alias("_at"), F.lit(_FACT).alias("_what"),
        F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).alias("_tie"), row.alias("_fact"),
    )
    order = [*keys, "_at", "_what", "_tie"]
    both = known.unionByName(asked, allowMissingColumns=True)
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        both.repartitionByRange(count, *order).withColumn("_range", F.spark_partition_id()), "as_of"
    )

    # Within a range, the last version of the key.
    w = Window.partitionBy("_range", *keys).orderBy("_at", "_what", "_tie")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = placed.withColumn("_own", F.last("_version", ignorenulls=True).over(before)).where("_fact IS NOT NULL")
    carried = _carried(placed, keys, count)
    met = filled.join(F.broadcast(carried), "_range", "left")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_last.{k}"))
    found = F.coalesce(F.col("_own"), F.when(same, F.col("_last._version")))
    valid = F.when((F.col("_at") >= found["_from"]) & (F.col("_at").cast("date") <= found["_until"]), found)
    return met.select("_fact.*", *[valid[c].alias(c) for c in columns])


def _carried(placed: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    """(_range, _last): the last version that lies in an earlier range, with its key.

    One version a range is brought to the driver; a range without any passes on what it was given.
    """
    last = F.max(F.struct(*keys, "_at", "_version")).alias("_last")
    ends = placed.where(F.col("_what") == _VERSION).groupBy("_range").agg(last)
    known = {r["_range"]: r["_last"] for r in ends.collect()}
    rows, running = [], None
    for n in range(ranges):
        if running is not None:
            rows.append((n, running))
        running = known.get(n, running)
    return placed.sparkSession.createDataFrame(rows, ends.schema)
