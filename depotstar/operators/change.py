"""Upserts by business key and dimension history."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotstar.operators.dedupe import first_match
from depotstar.operators.joins import left_lookup, matching
from depotstar.session import stage

# Fixed value: the end date of a row that is still valid.
OPEN_END = date(9999, 12, 31)


def upsert(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The target with every key of the batch replaced or added. Applying a batch twice is once.

    The batch must hold each key once. A batch small enough is broadcast by Spark, and then the
    target is not shuffled.
    """
    kept = target.join(batch.select(*key), key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def new_keys(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """The rows of the batch whose key the target does not hold yet."""
    return batch.join(target.select(*key), key, "left_anti").select(*batch.columns)


def with_open_history(df: DataFrame, effective: Column) -> DataFrame:
    """History columns of a first load: every row is version 1 and open."""
    return df.withColumns(
        {
            "effective_date": effective.cast("date"),
            "expiry_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
            "version": F.lit(1),
        }
    )


def _chain(changes: DataFrame, key: list[str]) -> DataFrame:
    """Expiry, current flag and version from the sequence of effective dates per key."""
    w = Window.partitionBy(*key).orderBy("effective_date")
    following = F.lead("effective_date").over(w)
    return changes.withColumns(
        {
            "expiry_date": F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END)),
            "is_current": following.isNull(),
            "version": F.row_number().over(w),
        }
    )


def history(
    events: DataFrame, key: list[str], attributes: list[str], at: str, order: list[str]
) -> DataFrame:
    """Versions of each key from dated observations of its attributes.

    Of several observations on one day the last in `order` counts. This leaves one row per key and
    day, reduced before the shuffle, so the windows see no more rows of a key than there are days,
    however many observations a key has. Days that change nothing are left out.
    """
    state = F.struct(*attributes)
    daily = events.groupBy(*key, F.col(at).cast("date").alias("effective_date")).agg(
        F.max_by(state, F.struct(*order)).alias("_state")
    )
    w = Window.partitionBy(*key).orderBy("effective_date")
    before = F.lag("_state").over(w)
    first = F.row_number().over(w) == 1
    changes = daily.withColumns({"_before": before, "_first": first}).where(
        F.col("_first") | ~F.col("_state").eqNullSafe(F.col("_before"))
    )
    return _chain(changes.select(*key, "_state.*", "effective_date"), key)


def apply_snapshot(
    dim: DataFrame, snapshot: DataFrame, key: list[str], attributes: list[str], as_of: date
) -> DataFrame:
    """Add a snapshot to a history: changed keys get a new version, new keys their first.

    Keys the snapshot lacks stay as they are. Attributes are compared in full, so no change is
    missed, and applying the same snapshot again changes nothing. A second snapshot of a day takes
    the place of the first: that day's version of a key in it is taken back before. For a key whose
    history is newer than `as_of`, the snapshot comes too late and changes nothing.
    """
    columns = [*key, *attributes, "effective_date", "expiry_date", "is_current", "version"]
    day = F.lit(as_of)
    snapshot = first_match(snapshot.select(*key, *attributes), key, attributes)

    # Versions of the same day go; the ones before them are open again.
    same_day = dim.where(F.col("effective_date") == day).join(
        snapshot.select(*key), key, "left_semi"
    ).select(*key, F.col("version").alias("_undone"))
    marked = dim.join(same_day, key, "left").where("_undone IS NULL OR version <> _undone")
    reopened = F.coalesce(F.col("version") == F.col("_undone") - 1, F.lit(False))
    dim = marked.withColumns(
        {
            "expiry_date": F.when(reopened, F.lit(OPEN_END)).otherwise(F.col("expiry_date")),
            "is_current": F.col("is_current") | reopened,
        }
    ).drop("_undone")

    # Each current row meets its key in the snapshot; a key without one is new.
    s = snapshot.select(
        F.struct(*key).alias("_key"), F.struct(*attributes).alias("_new"),
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
    )
    same_key = [dim[k] == s[f"_k{i}"] for i, k in enumerate(key)]
    met = dim.join(s, reduce(and_, [*same_key, dim["is_current"]]), "full")
    is_new = F.col("version").isNull()
    changed = (
        F.col("_new").isNotNull() & ~F.struct(*attributes).eqNullSafe(F.col("_new"))
        & (F.col("effective_date") < day)
    )
    old = F.struct(
        *key, *attributes, "effective_date",
        F.when(changed, F.date_sub(day, 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        (F.col("is_current") & ~changed).alias("is_current"), "version",
    )
    new = F.struct(
        *[F.col("_key")[k].alias(k) for k in key],
        *[F.col("_new")[c].alias(c) for c in attributes],
        day.alias("effective_date"), F.lit(OPEN_END).alias("expiry_date"),
        F.lit(True).alias("is_current"),
        (F.coalesce("version", F.lit(0)) + 1).alias("version"),
    )
    rows = F.when(is_new, F.array(new)).when(changed, F.array(old, new)).otherwise(F.array(old))
    return met.select(F.inline(rows)).select(*columns)


# Histories that know on which days each version was seen. Snapshots may be put in in any order.


def _versions_of(daily: DataFrame, key: list[str], attributes: list[str]) -> DataFrame:
    """Versions from one state (`_state`) a key and day (`_day`): runs of days with equal states."""
    w = Window.partitionBy(*key).orderBy("_day")
    begins = (F.row_number().over(w) == 1) | ~F.col("_state").eqNullSafe(F.lag("_state").over(w))
    numbered = daily.withColumn("_begins", begins.cast("int")).withColumn("version", F.sum("_begins").over(w).cast("int"))
    runs = numbered.groupBy(*key, "version").agg(
        F.first("_state").alias("_state"), F.sort_array(F.collect_list("_day")).alias("seen")
    )
    dated = runs.select(*key, "_state.*", F.col("seen")[0].alias("effective_date"), "seen")
    chained = _chain(dated, key)
    return chained.select(*key, *attributes, "effective_date", "expiry_date", "is_current", "version", "seen")


def seen_history(
    events: DataFrame, key: list[str], attributes: list[str], at: str, order: list[str]
) -> DataFrame:
    """As `history`, with the days on which each version was seen, for `put_snapshot`."""
    daily = events.groupBy(*key, F.col(at).cast("date").alias("_day")).agg(
        F.max_by(F.struct(*attributes), F.struct(*order)).alias("_state")
    )
    return _versions_of(daily, key, attributes)


def put_snapshot(
    dim: DataFrame, snapshot: DataFrame, key: list[str], attributes: list[str], as_of: date
) -> DataFrame:
    """Put a snapshot of any day into a history with `seen` days.

    The result is that of the whole set of snapshots, whatever their order: a late one splits the
    version valid on its day, or joins the ones beside it, and a second one of a day replaces the
    first. Keys the snapshot lacks stay as they are; keys are told apart NULL-safe.

    For keys not seen since that day only the current version is looked at. The versions of other
    keys are taken apart into their days, at most one a snapshot, and put together again.
    """
    columns = [*key, *attributes, "effective_date", "expiry_date", "is_current", "version", "seen"]
    day, same = F.lit(as_of), {k: k for k in key}
    new = first_match(snapshot.select(*key, *attributes), key, attributes).select(
        *key, F.struct(*attributes).alias("_new")
    )
    current = dim.where("is_current").select(*key, F.element_at("seen", -1).alias("_last"))
    placed = stage(left_lookup(new, current, same, null_safe=True), "snapshot")
    late = placed.where(F.col("_last") >= day).select(*key, "_new")
    fresh = placed.where(F.col("_last").isNull() | (F.col("_last") < day)).select(*key, "_new")

    # Keys seen on that day or later: their days, with the new one in place.
    old = matching(dim, late, same, null_safe=True).select(
        *key, F.struct(*attributes).alias("_state"), F.explode("seen").alias("_day")
    )
    days = old.where(F.col("_day") != day).unionByName(
        late.select(*key, F.col("_new").alias("_state"), day.alias("_day"))
    )
    mended = _versions_of(days, key, attributes)

    # The others: the current version is seen again, or ends and is followed by a new one.
    rest = matching(dim, late, same, negate=True, null_safe=True)
    met = left_lookup(rest, fresh, same, null_safe=True)
    hit = F.col("is_current") & F.col("_new").isNotNull()
    again = hit & F.struct(*attributes).eqNullSafe(F.col("_new"))
    ends = hit & ~again
    kept = F.struct(
        *key, *attributes, "effective_date",
        F.when(ends, F.date_sub(day, 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        (F.col("is_current") & ~ends).alias("is_current"), "version",
        F.when(again, F.concat("seen", F.array(day))).otherwise(F.col("seen")).alias("seen"),
    )

    def begun(version: Column) -> Column:
        return F.struct(
            *key, *[F.col("_new")[c].alias(c) for c in attributes], day.alias("effective_date"),
            F.lit(OPEN_END).alias("expiry_date"), F.lit(True).alias("is_current"),
            version.alias("version"), F.array(day).alias("seen"),
        )

    grown = met.select(
        F.inline(F.when(ends, F.array(kept, begun(F.col("version") + 1))).otherwise(F.array(kept)))
    )
    first = matching(fresh, dim, same, negate=True, null_safe=True).select(
        F.inline(F.array(begun(F.lit(1))))
    )
    return grown.select(*columns).unionByName(first.select(*columns)).unionByName(mended)
