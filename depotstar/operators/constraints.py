"""Audits of declared rules: NOT NULL, length, domain, CHECK, UNIQUE and foreign key.

Spark does not enforce such rules on Parquet tables, so each is counted. Result rows are
(table_name, rule, kind, violations).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotstar.functions.sqltext import text
from depotstar.operators.joins import left_lookup, matching
from depotstar.session import stage
from depotstar.operators.sets import union_all


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str = "RESTRICT"

    @property
    def name(self) -> str:
        return f"{self.column} -> {self.parent}.{self.parent_column}"


@dataclass(frozen=True)
class TableRules:
    """What is declared for one table; `checks` maps a name to an SQL condition."""

    not_null: list[str] = field(default_factory=list)
    lengths: dict[str, int] = field(default_factory=dict)
    domains: dict[str, list[str]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    unique: list[list[str]] = field(default_factory=list)


def row_rules(rules: TableRules, columns: list[str]) -> list[tuple[str, str, str]]:
    """(rule, kind, SQL condition that breaks it) for all rules that one row can break.

    As in SQL, a NULL breaks NOT NULL only. A rule on a column the frame lacks can't be checked:
    its condition is NULL.
    """
    have = set(columns)
    broken = [(c, "NOT NULL", f"{c} IS NULL", {c}) for c in rules.not_null]
    broken += [
        (f"{c} <= {n}", "LENGTH", f"length({c}) > {n}", {c}) for c, n in rules.lengths.items()
    ]
    broken += [
        (c, "DOMAIN", f"{c} NOT IN ({', '.join(map(text, values))})", {c})
        for c, values in rules.domains.items()
    ]
    broken += [
        (name, "CHECK", f"NOT ({test})", columns_of(test)) for name, test in rules.checks.items()
    ]
    return [(rule, kind, test if needs <= have else None) for rule, kind, test, needs in broken]


def columns_of(test: str) -> set[str]:
    """The columns an SQL condition names: its words in lower case outside of quotes."""
    bare = re.sub(r"'[^']*'", "", test)
    return {w for w in re.findall(r"[A-Za-z_]\w*(?!\w*\()", bare) if w.lower() == w}


def audit_rows(table: str, df: DataFrame, rules: TableRules) -> DataFrame:
    """All row rules of a table in one pass; NULL violations where a column is missing."""
    broken = row_rules(rules, df.columns)
    counts = df.agg(
        *[
            F.expr(f"{f'count_if({test})' if test else 'CAST(NULL AS BIGINT)'} AS _{i}")
            for i, (_, _, test) in enumerate(broken)
        ]
    )
    rows = [
        f"struct({text(table)} AS table_name, {text(rule)} AS rule, {text(kind)} AS kind, "
        f"_{i} AS violations)"
        for i, (rule, kind, _) in enumerate(broken)
    ]
    return counts.selectExpr(f"inline(array({', '.join(rows)}))")


def _finding(table: str, rule: str, kind: str, violations: str) -> list[Column]:
    """The result row of one rule, as aggregates."""
    return [
        F.expr(f"{text(table)} AS table_name"),
        F.expr(f"{text(rule)} AS rule"),
        F.expr(f"{text(kind)} AS kind"),
        F.expr(f"coalesce(sum({violations}), 0) AS violations"),
    ]


def audit_unique(table: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Rows too many for a unique key. Keys with a NULL part are exempt."""
    if not set(key) <= set(df.columns):
        return _unchecked(df, table, ", ".join(key), "UNIQUE")
    present = " AND ".join(f"{c} IS NOT NULL" for c in key)
    keyed = df.where(present).groupBy(*key).agg(F.expr("count(1) AS n"))
    return keyed.where("n > 1").agg(*_finding(table, ", ".join(key), "UNIQUE", "n - 1"))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, n): child keys without a parent row, with their row counts; NULL keys pass.

    Child rows are counted per key before the join, so a frequent key is one row in the shuffle.
    """
    held = child.where(f"{column} IS NOT NULL").groupBy(F.expr(f"{column} AS key"))
    counted = held.agg(F.expr("count(1) AS n"))
    return counted.join(parent.selectExpr(f"{parent_column} AS key"), "key", "left_anti")


def _unchecked(df: DataFrame, table: str, rule: str, kind: str) -> DataFrame:
    """The row of a rule whose columns are missing."""
    row = [(table, rule, kind, None)]
    return df.sparkSession.createDataFrame(
        row, "table_name string, rule string, kind string, violations bigint"
    )


def audit_foreign_key(fk: ForeignKey, tables: dict[str, DataFrame]) -> DataFrame:
    if fk.column not in tables[fk.child].columns:
        return _unchecked(tables[fk.child], fk.child, fk.name, "FOREIGN KEY")
    orphans = orphan_keys(tables[fk.child], fk.column, tables[fk.parent], fk.parent_column)
    return orphans.agg(*_finding(fk.child, fk.name, "FOREIGN KEY", "n"))


def audit(
    tables: dict[str, DataFrame], rules: dict[str, TableRules], foreign_keys: list[ForeignKey]
) -> DataFrame:
    """Every rule declared for the given tables, with its number of violations.

    Violations are NULL for a rule that was not checked, since a column or the parent is missing.
    """
    parts = []
    for name, df in tables.items():
        declared = rules.get(name, TableRules())
        if row_rules(declared, df.columns):
            parts.append(audit_rows(name, df, declared))
        parts += [audit_unique(name, df, key) for key in declared.unique]
    parts += [
        audit_foreign_key(fk, tables)
        if fk.parent in tables
        else _unchecked(tables[fk.child], fk.child, fk.name, "FOREIGN KEY")
        for fk in foreign_keys
        if fk.child in tables
    ]
    return union_all(parts)


# ---------------------------------------------------------------------------------------------
# Delete actions
# ---------------------------------------------------------------------------------------------


@dataclass
class DeleteResult:
    """`report`: (table_name, rule, action, affected). `tables`: the state after the delete.

    If any RESTRICT row of the report has a count above zero, the delete must not be carried out
    and `tables` is not to be used.
    """

    report: DataFrame
    tables: dict[str, DataFrame]


def delete_parents(
    tables: dict[str, DataFrame],
    foreign_keys: list[ForeignKey],
    primary_keys: dict[str, str],
    parent: str,
    keys: DataFrame,
) -> DeleteResult:
    """Delete the rows of `parent` whose primary key is in the one-column frame `keys`.

    Children follow their declared action: RESTRICT counts the rows that forbid the delete, CASCADE
    deletes them and goes on to their own children, SET NULL clears the reference. The report has
    every key that the delete can reach.

    Cascades may form cycles. A round looks at the keys deleted in the round before only; those seen
    already are left out, all are staged, and the rounds end when no key is new.
    """
    spark, key = keys.sparkSession, keys.columns[0]
    gone = {parent: stage(keys.select(F.col(key).alias("key")).distinct(), "gone")}
    reached = _reached(foreign_keys, parent, set(tables))
    front = dict(gone)
    counts: list[DataFrame] = []
    cleared: dict[ForeignKey, list[DataFrame]] = {}
    while front:
        found: dict[str, list[DataFrame]] = {}
        for fk in reached:
            if fk.parent not in front:
                continue
            hit = matching(tables[fk.child], front[fk.parent], {fk.column: "key"})
            counts.append(hit.agg(F.lit(reached.index(fk)).alias("_fk"), F.count(F.lit(1)).alias("n")))
            if fk.on_delete == "CASCADE":
                found.setdefault(fk.child, []).append(hit.select(F.col(primary_keys[fk.child]).alias("key")))
            elif fk.on_delete == "SET NULL":
                cleared.setdefault(fk, []).append(front[fk.parent])
        front = {}
        for name, parts in found.items():
            fresh = reduce(DataFrame.union, parts).distinct()
            if name in gone:
                fresh = matching(fresh, gone[name], {"key": "key"}, negate=True)
            fresh = stage(fresh, "gone")
            if not fresh.isEmpty():
                front[name] = fresh
                gone[name] = gone[name].union(fresh) if name in gone else fresh

    after = dict(tables)
    for name, dropped in gone.items():
        after[name] = matching(after[name], dropped, {primary_keys[name]: "key"}, negate=True)
    for fk, parts in cleared.items():
        mark = reduce(DataFrame.union, parts).select("key", F.lit(True).alias("_gone"))
        marked = left_lookup(after[fk.child], mark, {fk.column: "key"})
        kept = F.when(F.col("_gone").isNull(), F.col(fk.column))
        after[fk.child] = marked.withColumn(fk.column, kept).drop("_gone")

    rules = spark.createDataFrame(
        [(i, fk.child, fk.name, fk.on_delete) for i, fk in enumerate(reached)],
        "_fk int, table_name string, rule string, action string",
    )
    if counts:
        sums = stage(union_all(counts), "affected").groupBy("_fk").agg(F.sum("n").alias("affected"))
        rules = rules.join(sums, "_fk", "left")
    else:
        rules = rules.withColumn("affected", F.lit(0).cast("bigint"))
    affected = F.coalesce("affected", F.lit(0)).cast("bigint").alias("affected")
    return DeleteResult(rules.select("table_name", "rule", "action", affected), after)


def _reached(foreign_keys: list[ForeignKey], parent: str, present: set[str]) -> list[ForeignKey]:
    """The keys that a delete in `parent` can reach, through cascades, among the tables present."""
    todo, seen, out = [parent], {parent}, []
    while todo:
        table = todo.pop(0)
        for fk in foreign_keys:
            if fk.parent == table and fk.child in present:
                out.append(fk)
                if fk.on_delete == "CASCADE" and fk.child not in seen:
                    seen.add(fk.child)
                    todo.append(fk.child)
    return out
