"""The validation suite: named checks on one frame, and the verdict."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from depotstar.functions.sqltext import text
from depotstar.operators.cleanse import CRITICAL_COLUMNS, SENSITIVE_COLUMNS, SENTINEL, number
from depotstar.operators.dedupe import count_duplicates

# Columns that must not be negative, and the lowest good mean score.
NON_NEGATIVE = ["Sales", "Product Price", "Order Item Quantity"]
GOOD_SCORE = 80

_DUPLICATES = "Duplicates"


@dataclass(frozen=True)
class Check:
    """A named test: an aggregate to observe and the condition it has to meet.

    `passes` is SQL over the name `observed`, for example `observed = 0`. A failed check that is a
    warning does not spoil the verdict.
    """

    name: str
    observed: Column
    passes: str = "observed = 0"
    warning: bool = False
    ok: str = "ok"
    fail: str = "violated"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def standard_checks(df: DataFrame) -> list[Check]:
    """The checks for a cleaned frame, of those columns it has."""
    have = set(df.columns)
    empties = [F.when(F.count(_c(c)) == 0, 1).otherwise(0) for c in df.columns]
    checks = [
        Check("Empty Columns", sum(empties, F.lit(0)), ok="no empty columns", fail="empty columns")
    ]
    checks += [
        Check(f"Critical Field '{c}'", F.count_if(_c(c).isNull()), fail="missing values")
        for c in CRITICAL_COLUMNS
        if c in have
    ]
    checks += [
        Check(
            f"Masked '{c}'",
            F.count_if(_c(c).cast("string").contains(SENTINEL)),
            fail="masking text found",
        )
        for c in SENSITIVE_COLUMNS
        if c in have
    ]
    checks += [
        Check(
            f"Non-negative '{c}'",
            F.count_if(number(df, c) < 0),
            warning=True,
            fail="negative values",
        )
        for c in NON_NEGATIVE
        if c in have
    ]
    if "data_quality_score" in have:
        checks.append(
            Check(
                "Data Quality Score",
                F.avg(number(df, "data_quality_score")),
                f"observed >= {GOOD_SCORE}",
                warning=True,
                ok="average score is high",
                fail="average score is low",
            )
        )
    return checks


def run_checks(df: DataFrame, checks: list[Check], duplicates: bool = True) -> DataFrame:
    """(check_name, severity, passed, observed, message) per check.

    One pass answers all checks together; only the duplicate check has a shuffle of its own.
    """
    return _judged(df.agg(*_observed(checks)), checks, df if duplicates else None)


def checked_write(
    df: DataFrame, checks: list[Check], write: Callable[[DataFrame], DataFrame], duplicates: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Write a frame by `write`, which returns what it wrote, and check it in the same pass.

    Only the duplicate check reads what was written.
    """
    seen = Observation()
    written = write(df.observe(seen, *_observed(checks)))
    got = seen.get
    layout = ", ".join(f"_{i} double" for i in range(len(checks)))
    wide = df.sparkSession.createDataFrame([tuple(got[f"_{i}"] for i in range(len(checks)))], layout)
    return written, _judged(wide, checks, written if duplicates else None)


def _observed(checks: list[Check]) -> list[Column]:
    return [c.observed.cast("double").alias(f"_{i}") for i, c in enumerate(checks)]


def _judged(wide: DataFrame, checks: list[Check], whole: DataFrame | None) -> DataFrame:
    """Results of the one row of observed values; duplicates are counted in `whole`, if given."""
    if whole is not None:
        found = count_duplicates(whole).scalar().cast("double")
        wide = wide.withColumn(f"_{len(checks)}", found)
        checks = [*checks, Check(_DUPLICATES, F.lit(0), fail="duplicate rows")]
    rows = [
        f"struct({text(c.name)} AS check_name, "
        f"'{'warning' if c.warning else 'error'}' AS severity, "
        f"{c.passes.replace('observed', f'_{i}')} AS passed, _{i} AS observed, "
        f"{text(c.ok)} AS ok, {text(c.fail)} AS fail)"
        for i, c in enumerate(checks)
    ]
    return wide.selectExpr(f"inline(array({', '.join(rows)}))").select(
        "check_name",
        "severity",
        # A check that has nothing to observe, as the mean of no rows, does not pass.
        F.coalesce("passed", F.lit(False)).alias("passed"),
        "observed",
        F.when(F.col("passed"), F.col("ok")).otherwise(F.col("fail")).alias("message"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: passed, failed and warning counts, and whether the data is ready to load."""
    failed = F.count_if(~F.col("passed") & (F.col("severity") == "error"))
    return results.agg(
        F.count_if("passed").alias("passed"),
        failed.alias("failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "warning")).alias("warnings"),
        (failed == 0).alias("ready"),
    )
