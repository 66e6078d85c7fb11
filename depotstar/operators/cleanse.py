"""The cleansing steps, each a function DataFrame -> DataFrame, and the runner."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import blank_tokens, drop_sentinel, parse_timestamp, percent, strip, to_number
from depotstar.functions.values import SOURCE_DATE_FORMAT
from depotstar.operators.dedupe import drop_duplicate_rows
from depotstar.operators.profile import empty_columns, missing_cells, value_counts
from depotstar.operators.reshape import nameless_columns, with_record_lineage
from depotstar.schemas import DATE_COLUMNS
from depotstar.session import stage
from depotstar.sources.csv import cleaned_path, read_flat, write_flat
from depotstar.sources.infer import infer_types

# The columns each step works on, the masking text, the score.
SENTINEL = "XXXXXXXXX"
SENSITIVE_COLUMNS = ["Customer Email", "Customer Password"]
NAME_COLUMNS = ["Customer Fname", "Customer Lname"]
NUMERIC_COLUMNS = [
    "Days for shipping (real)", "Days for shipment (scheduled)", "Benefit per order",
    "Sales per customer", "Order Item Discount", "Order Item Discount Rate",
    "Order Item Product Price", "Order Item Profit Ratio", "Order Item Quantity", "Sales",
    "Order Item Total", "Order Profit Per Order", "Product Price", "Latitude", "Longitude",
]
NON_NEGATIVE_COLUMNS = [
    "Days for shipping (real)", "Days for shipment (scheduled)", "Order Item Quantity", "Sales",
    "Product Price",
]
CRITICAL_COLUMNS = ["Order Id", "Customer Id", "Product Name", "Sales"]
PENALTY = 25

RECORD_SOURCE = "supply_chain"

Step = Callable[[DataFrame], DataFrame]
T_ = TypeVar("T_")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def number(df: DataFrame, name: str) -> Column:
    """A column as a number, whether it was read as text or not."""
    text = isinstance(df.schema[name].dataType, T.StringType)
    return to_number(_c(name)) if text else _c(name)


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def drop_empty_columns(df: DataFrame, empty: list[str] | None = None) -> DataFrame:
    """Drop nameless columns and those without any value.

    Which columns are empty decides the plan of all later steps, so it takes one pass over the
    data now; pass `empty` if it is known.
    """
    empty = empty_columns(df)[0] if empty is None else empty
    return df.drop(*nameless_columns(df), *empty)


def clean_customers(df: DataFrame) -> DataFrame:
    """NULL for masked email and password, names trimmed."""
    changed = {c: drop_sentinel(_c(c), SENTINEL) for c in _present(df, SENSITIVE_COLUMNS)}
    changed |= {c: strip(_c(c)) for c in _present(df, NAME_COLUMNS)}
    return df.withColumns(changed)


def clean_numbers(df: DataFrame) -> DataFrame:
    """Numeric columns to double, bad text to NULL; negative values stay."""
    return df.withColumns({c: to_number(_c(c)) for c in _present(df, NUMERIC_COLUMNS)})


def clean_dates(df: DataFrame, date_format: str = SOURCE_DATE_FORMAT) -> DataFrame:
    """Date columns to timestamp, bad text to NULL; columns that are dates already stay."""
    texts = [c for c in _present(df, DATE_COLUMNS) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_timestamp(_c(c), date_format) for c in texts})


def trim_texts(df: DataFrame) -> DataFrame:
    """Trim every text column but the sensitive ones; NULL stays NULL."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip(_c(c)) for c in texts if c not in SENSITIVE_COLUMNS})


def quality_score(df: DataFrame) -> Column:
    """100, less 25 for each critical column that is NULL; absent columns cost nothing."""
    lost = [F.when(_c(c).isNull(), PENALTY).otherwise(0) for c in _present(df, CRITICAL_COLUMNS)]
    return reduce(lambda total, x: total - x, lost, F.lit(100))


def add_quality_flags(
    df: DataFrame, source: str = RECORD_SOURCE, now: datetime | None = None
) -> DataFrame:
    """Add the score and the record's lineage."""
    return with_record_lineage(df.withColumn("data_quality_score", quality_score(df)), source, now)


def default_steps(
    now: datetime | None = None,
    date_format: str = SOURCE_DATE_FORMAT,
    source: str = RECORD_SOURCE,
    empty: list[str] | None = None,
    dedupe_after_trim: bool = False,
    drop_empty_last: bool = False,
) -> list[Step]:
    """The steps in their standard order; a caller may add own steps to the list.

    Standard order removes duplicates before trimming and empty columns before masking, so either
    may come back. The two options add a second pass of that step at the end.
    """
    steps: list[Step] = [
        partial(drop_empty_columns, empty=empty),
        drop_duplicate_rows,
        clean_customers,
        clean_numbers,
        partial(clean_dates, date_format=date_format),
        trim_texts,
    ]
    if dedupe_after_trim:
        steps.append(drop_duplicate_rows)
    if drop_empty_last:
        steps.append(drop_empty_columns)
    steps.append(partial(add_quality_flags, source=source, now=now))
    return steps


def cleanse(df: DataFrame, steps: list[Step] | None = None) -> DataFrame:
    """Apply the steps in turn; one lazy plan."""
    return reduce(DataFrame.transform, steps or default_steps(), df)


def status_counts(df: DataFrame, column: str = "Delivery Status") -> DataFrame:
    """The values of a categorical column in order, with their counts."""
    return value_counts(df, column).select("value", "n").orderBy("value")


def negative_counts(df: DataFrame) -> DataFrame:
    """One row: negative values per column that should have none."""
    found = _present(df, NON_NEGATIVE_COLUMNS)
    return df.agg(*[F.count_if(number(df, c) < 0).alias(c) for c in found])


def invalid_dates(df: DataFrame) -> DataFrame:
    """One row: NULL dates per cleaned date column."""
    return df.agg(*[F.count_if(_c(c).isNull()).alias(c) for c in _present(df, DATE_COLUMNS)])


def masked_counts(df: DataFrame) -> DataFrame:
    """(column_name, masked): values of the sensitive columns that the masking text hides."""
    found = _present(df, SENSITIVE_COLUMNS)
    counts = df.agg(*[F.count_if(_c(c) == SENTINEL).alias(c) for c in found])
    cells = [F.struct(F.lit(c).alias("column_name"), _c(c).alias("masked")) for c in found]
    return counts.select(F.inline(F.array(*cells)))


def score_distribution(df: DataFrame) -> DataFrame:
    """Rows and percent per quality score, best score first."""
    counts = value_counts(df, "data_quality_score")
    named = counts.select(F.col("value").alias("data_quality_score"), "n", "pct")
    return named.orderBy(F.desc("data_quality_score"))


def cleaning_report(raw: DataFrame, cleaned: DataFrame, dropped: list[str]) -> DataFrame:
    """One row: rows before and after, duplicates removed, missing cells, dropped columns.

    Give the cleaned rows as read back from where they were written; then no cleansing is repeated.
    """
    before = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    missing = missing_cells(cleaned).scalar()
    after = cleaned.agg(F.count(F.lit(1)).alias("total_rows_cleaned"))
    return after.select(
        before.alias("total_rows_original"),
        "total_rows_cleaned",
        (before - F.col("total_rows_cleaned")).alias("duplicates_removed"),
        missing.alias("missing_cells"),
        F.lit(",".join(sorted(dropped))).alias("columns_dropped"),
    )


def score_summary(df: DataFrame) -> DataFrame:
    """One row: mean score and the number and percent of full scores."""
    full = F.count_if(F.col("data_quality_score") == 100)
    return df.agg(
        F.avg("data_quality_score").alias("mean_score"),
        full.alias("perfect_records"),
        percent(full, F.count(F.lit(1)), 1).alias("perfect_pct"),
    )


@dataclass(frozen=True)
class Measures:
    """What was seen of a frame while it was written: rows, and missing values by column."""

    rows: int
    missing: dict[str, int]

    @property
    def empty(self) -> list[str]:
        return [c for c, n in self.missing.items() if n == self.rows]


def measured(df: DataFrame, write: Callable[[DataFrame], T_]) -> tuple[T_, Measures]:
    """Write a frame by `write` and measure it in the same pass; nothing is read for it again.

    The measures are taken in the tasks that write, so a task done again counts once. A text that a
    reader of the written file takes for missing counts as such.
    """
    seen = Observation()
    cells = [
        blank_tokens(_c(f.name)) if isinstance(f.dataType, T.StringType) else _c(f.name)
        for f in df.schema.fields
    ]
    missing = [F.count_if(c.isNull()).alias(f"_m{i}") for i, c in enumerate(cells)]
    out = write(df.observe(seen, F.count(F.lit(1)).alias("_rows"), *missing))
    got = seen.get
    return out, Measures(got["_rows"], {c: got[f"_m{i}"] for i, c in enumerate(df.columns)})


def measured_report(
    spark: SparkSession, before: int, after: Measures, dropped: list[str]
) -> DataFrame:
    """As `cleaning_report`, of what was measured."""
    return spark.createDataFrame(
        [(before, after.rows, before - after.rows, sum(after.missing.values()), ",".join(sorted(dropped)))],
        "total_rows_original bigint, total_rows_cleaned bigint, duplicates_removed bigint, "
        "missing_cells bigint, columns_dropped string",
    )


class Cleaner:
    """Cleansing of one file: any step alone through `apply`, or all of them through `run`.

    With `typed`, columns have the types that all their texts allow, and duplicates are told by
    value: 1.0 and 1.00 are the same.
    """

    def __init__(self, spark: SparkSession, path: str, encoding: str = "UTF-8", typed: bool = False):
        self.path = path
        self._take(read_flat(spark, path, encoding=encoding), typed)

    @classmethod
    def of(cls, df: DataFrame, path: str = "frame.csv") -> Cleaner:
        """Of a frame in place of a file."""
        self = cls.__new__(cls)
        self.path = path
        self._take(df, False)
        return self

    def _take(self, df: DataFrame, typed: bool) -> None:
        # Parsing text is the dear part; the steps that look at all rows read the staged copy.
        self.spark = df.sparkSession
        self.raw, self.before = measured(df, lambda d: stage(d, "raw"))
        if typed:
            self.raw = infer_types(self.raw)
        self.df = self.raw
        self.dropped: list[str] = []

    def apply(self, step: Step) -> Cleaner:
        before = self.df.columns
        self.df = step(self.df)
        self.dropped += [c for c in before if c not in self.df.columns]
        return self

    def run(
        self,
        output: str | None = None,
        steps: list[Step] | None = None,
        now: datetime | None = None,
    ) -> DataFrame:
        """Cleanse, write to `output`, and report on what was written, measured by the write.

        Without `output`, the name is that of the source with the time of the run.
        """
        output = output or cleaned_path(self.path, now or datetime.now())
        return self.write(lambda df: write_flat(df, output), steps, now)[1]

    def write(
        self, write: Callable[[DataFrame], T_], steps: list[Step] | None = None, now: datetime | None = None
    ) -> tuple[T_, DataFrame]:
        """Cleanse and hand the rows to `write`; what that returns, and the report."""
        for step in steps or default_steps(now, empty=self.before.empty):
            self.apply(step)
        out, after = measured(self.df, write)
        return out, measured_report(self.spark, self.before.rows, after, self.dropped)
