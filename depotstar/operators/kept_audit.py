"""Unique and foreign keys judged from what changed.

Beside the tables lie counts of their keys, as signed steps: a row that comes counts one, a row that
goes takes one away. A batch needs the counts of the keys it touches only, before and after; what it
adds to the violations, or mends, follows from these. So an audit after a batch costs what the batch
costs, and says what the full audit would.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotstar.operators import delta
from depotstar.operators.constraints import ForeignKey
from depotstar.operators.joins import left_lookup, matching
from depotstar.operators.sets import union_all
from depotstar.session import stage, together
from depotstar.sources import tables
from depotstar.sources.files import exists

_RULE = "table_name string, rule string, kind string, violations bigint"


@dataclass(frozen=True)
class Change:
    """The rows of one table that came and that went; an update is one of each."""

    came: DataFrame | None = None
    went: DataFrame | None = None


@dataclass(frozen=True)
class Side:
    """Columns of a table whose values are counted."""

    table: str
    columns: tuple[str, ...]

    @property
    def folder(self) -> str:
        return f"{self.table}-{'-'.join(self.columns)}"


class KeptAudit:
    """Counts and violations below `root`; batches are applied one after the other, each once.

    A batch is a version: its counts and the violations after it, seen when both are complete. A
    batch lost on the way leaves nothing behind that counts, and can be applied again.
    """

    def __init__(
        self, spark: SparkSession, root: str, unique: dict[str, list[list[str]]], foreign_keys: list[ForeignKey]
    ):
        self.spark, self.root = spark, root
        self.unique = [Side(t, tuple(key)) for t, keys in unique.items() for key in keys]
        self.foreign_keys = foreign_keys

    def violations(self) -> DataFrame:
        """(table_name, rule, kind, violations) after the last batch."""
        done = tables.versions(self.spark, self.root)
        if done:
            return self.spark.read.schema(_RULE).parquet(f"{self.root}/v{done[-1]}/violations")
        rules = [(s.table, ", ".join(s.columns), "UNIQUE", 0) for s in self.unique]
        rules += [(fk.child, fk.name, "FOREIGN KEY", 0) for fk in self.foreign_keys]
        return self.spark.createDataFrame(rules, _RULE)

    def apply(self, changes: dict[str, Change]) -> DataFrame:
        """Take a batch into account; returns the violations after it."""
        version = tables.next_version(self.spark, self.root)
        path = f"{self.root}/v{version}"
        self._done = tables.versions(self.spark, self.root)
        sides = {s for s in self.unique} | {
            s for fk in self.foreign_keys for s in (Side(fk.child, (fk.column,)), Side(fk.parent, (fk.parent_column,)))
        }
        touched = sorted((s for s in sides if s.table in changes), key=lambda s: s.folder)
        if not touched:
            return self.violations()
        together(*[
            lambda s=s: tables.replace(self._signed(s, changes[s.table]), f"{path}/counts/{s.folder}") for s in touched
        ])
        self._fresh = {s: self.spark.read.parquet(f"{path}/counts/{s.folder}") for s in touched}
        parts = [self._unique_change(s) for s in self.unique if s in self._fresh]
        parts += [
            self._foreign_change(fk) for fk in self.foreign_keys
            if {Side(fk.child, (fk.column,)), Side(fk.parent, (fk.parent_column,))} & set(self._fresh)
        ]
        total = union_all([self.violations(), *parts]).groupBy("table_name", "rule", "kind").agg(
            F.sum("violations").alias("violations")
        )
        tables.replace(total, f"{path}/violations")
        tables.finish(self.spark, self.root, version)
        return self.violations()

    def _signed(self, side: Side, change: Change) -> DataFrame:
        """Counts that the change adds, by key; keys with a NULL part are exempt from both rules."""
        present = " AND ".join(f"`{c}` IS NOT NULL" for c in side.columns)
        parts = [
            delta.counted(df.where(present).select(*side.columns), sign)
            for df, sign in ((change.came, 1), (change.went, -1)) if df is not None
        ]
        whole = reduce(DataFrame.unionByName, parts)
        return whole.groupBy(*side.columns).agg(F.sum(delta.COUNT).alias(delta.COUNT)).where(F.col(delta.COUNT) != 0)

    def _before(self, side: Side, keys: DataFrame) -> DataFrame:
        """The counts of some keys before this batch, from the steps of all batches."""
        paths = [f"{self.root}/v{v}/counts/{side.folder}" for v in self._done]
        paths = [p for p in paths if exists(self.spark, p)]
        if not paths:
            return keys.select(*side.columns, F.lit(0).cast("bigint").alias("before")).limit(0)
        steps = self.spark.read.parquet(*paths)
        found = matching(steps, keys, {c: c for c in side.columns})
        return found.groupBy(*side.columns).agg(F.sum(delta.COUNT).alias("before"))

    def _counts(self, side: Side, keys: DataFrame, before: str, after: str) -> DataFrame:
        """`keys` with the counts of a side before and after the batch."""
        own = {c: c for c in side.columns}
        met = left_lookup(keys, self._before(side, keys), own)
        if side in self._fresh:
            met = left_lookup(met, self._fresh[side], own)
        else:
            met = met.withColumn(delta.COUNT, F.lit(0).cast("bigint"))
        was, more = F.coalesce("before", F.lit(0)), F.coalesce(delta.COUNT, F.lit(0))
        return met.withColumns({before: was, after: was + more}).drop(
            *{"before", delta.COUNT} - {before, after}
        )

    @staticmethod
    def _finding(rows: DataFrame, table: str, rule: str, kind: str, change: Column) -> DataFrame:
        return rows.agg(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(kind).alias("kind"),
            F.coalesce(F.sum(change), F.lit(0)).cast("bigint").alias("violations"),
        )

    def _unique_change(self, side: Side) -> DataFrame:
        keys = self._fresh[side].select(*side.columns)
        met = self._counts(side, keys, "was", "is")
        more = F.greatest(F.col("is") - 1, F.lit(0)) - F.greatest(F.col("was") - 1, F.lit(0))
        return self._finding(met, side.table, ", ".join(side.columns), "UNIQUE", more)

    def _foreign_change(self, fk: ForeignKey) -> DataFrame:
        """Orphans among the keys that changed on either side."""
        child, parent = Side(fk.child, (fk.column,)), Side(fk.parent, (fk.parent_column,))
        keys = [self._fresh[s].select(F.col(s.columns[0]).alias("key")) for s in (child, parent) if s in self._fresh]
        keys = stage(reduce(DataFrame.union, keys).distinct(), "touched")
        own = self._counts(child, keys.withColumnRenamed("key", fk.column), "was", "is")
        met = self._counts(parent, own.withColumnRenamed(fk.column, fk.parent_column), "parent_was", "parent_is")
        orphans = [F.when(F.col(p) > 0, 0).otherwise(F.col(c)) for p, c in (("parent_is", "is"), ("parent_was", "was"))]
        return self._finding(met, fk.child, fk.name, "FOREIGN KEY", orphans[0] - orphans[1])
