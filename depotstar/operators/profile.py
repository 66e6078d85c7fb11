"""Column profiles: missing values, type census, numeric and categorical summaries, imputation."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import percent
from depotstar.functions.sqltext import name, text
from depotstar.session import stage, together


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def census(df: DataFrame) -> DataFrame:
    """Row and column count and missing cells, from one pass."""
    missing = [F.expr(f"count_if({name(c)} IS NULL)") for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        sum(missing, F.lit(0).cast("bigint")).alias("missing_cells"),
    )


def type_census(df: DataFrame) -> dict[str, int]:
    """Columns per data type; needs no data."""
    return dict(Counter(t for _, t in df.dtypes))


def missing_counts(df: DataFrame) -> DataFrame:
    """Every column with its missing count and percent, from one pass over the data."""
    counts = df.agg(
        F.expr("count(1) AS _rows"),
        *[F.expr(f"count_if({name(c)} IS NULL) AS _m{i}") for i, c in enumerate(df.columns)],
    )
    cells = [
        f"struct({text(c)} AS column_name, _m{i} AS missing)" for i, c in enumerate(df.columns)
    ]
    long = counts.selectExpr("_rows", f"inline(array({', '.join(cells)}))")
    return long.select(
        "column_name", "missing", percent(F.col("missing"), F.col("_rows")).alias("missing_pct")
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, the worst first; equal counts by name."""
    found = missing_counts(df).where(F.col("missing") > 0)
    return found.orderBy(F.desc("missing"), "column_name")


def missing_cells(df: DataFrame) -> DataFrame:
    """One row: missing cells of the whole frame."""
    return missing_counts(df).agg(F.sum("missing").alias("missing_cells"))


def empty_columns(df: DataFrame) -> tuple[list[str], int]:
    """Columns without any value, and the row count; one pass."""
    row = df.agg(
        F.expr("count(1) AS _rows"),
        *[F.expr(f"count({name(c)}) AS _n{i}") for i, c in enumerate(df.columns)],
    ).first()
    return [c for i, c in enumerate(df.columns) if row[f"_n{i}"] == 0], row["_rows"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def value_frequencies(df: DataFrame, columns: list[str], as_type: str) -> DataFrame:
    """(column, value, n) for every value that is not NULL; all columns in one pass.

    `column` is the place of the column in `columns`.
    """
    cells = [
        f"struct({i} AS column, cast({name(c)} AS {as_type}) AS value)"
        for i, c in enumerate(columns)
    ]
    long = df.selectExpr(f"inline(array({', '.join(cells)}))").where("value IS NOT NULL")
    if as_type == "double":
        long = long.where("NOT isnan(value)")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _named(df: DataFrame, columns: list[str]) -> DataFrame:
    """`column`, a place in `columns`, replaced by the name there."""
    names = F.array(*[F.lit(c) for c in columns])
    rest = [c for c in df.columns if c != "column"]
    return df.select(names[F.col("column")].alias("column_name"), *rest)


def sorted_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """value_frequencies in written ranges, sorted by column and value over many tasks.

    Values are counted first, so repeats cost nothing. The one pass over `df` that number profiles
    need; `_part` tells the range.
    """
    counts = value_frequencies(df, columns, "double")
    return stage(
        counts.orderBy("column", "value").withColumn("_part", F.spark_partition_id()), "quantiles"
    )


def exact_quantiles(df: DataFrame, columns: list[str], points: list[float]) -> DataFrame:
    """(column_name, point, quantile), linearly interpolated, for any number of rows."""
    return _named(_quantiles(_ranges(sorted_values(df, columns)), points), columns)


def _ranges(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The placed values, and a staged row of sums for each column and written range."""
    sums = placed.groupBy("column", "_part").agg(
        F.sum("n").alias("_in"), F.min("value").alias("_min"), F.max("value").alias("_max"),
        F.sum(F.col("n") * F.col("value")).alias("_sum"),
    )
    return placed, stage(sums, "ranges")


def _quantiles(values: tuple[DataFrame, DataFrame], points: list[float]) -> DataFrame:
    """(column, point, quantile) of values and ranges.

    From the count of each range follows which range holds a wanted position; only those ranges, a
    few per point, are walked through. No task holds more than one range.
    """
    placed, sums = values
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = sums.withColumns(
        {
            "_start": F.coalesce(F.sum("_in").over(before), F.lit(0)),
            "_total": F.sum("_in").over(Window.partitionBy("column")),
        }
    )
    position = F.col("point") * (F.col("_total") - 1)
    ends = F.array(F.floor(position), F.ceil(position))
    # A few rows for each column and point.
    wanted = stage(
        ranges.withColumn("point", F.explode(F.array(*[F.lit(p) for p in points])))
        .withColumn("_fraction", position - F.floor(position))
        .select("*", F.posexplode(ends).alias("_end", "_at"))
        .where("_at >= _start and _at < _start + _in")
        .select("column", "_part", "_start", "point", "_fraction", "_end", "_at"),
        "wanted",
    )
    walked = placed.join(
        F.broadcast(wanted.select("column", "_part", "_start").distinct()), ["column", "_part"]
    )
    running = Window.partitionBy("column", "_part").orderBy("value")
    walked = walked.withColumn("_upto", F.col("_start") + F.sum("n").over(running))
    hits = walked.drop("_start").join(F.broadcast(wanted), ["column", "_part"]).where(
        "_at >= _upto - n and _at < _upto"
    )
    low = F.max(F.when(F.col("_end") == 0, F.col("value")))
    high = F.max(F.when(F.col("_end") == 1, F.col("value")))
    return hits.groupBy("column", "point").agg(
        (low + (high - low) * F.max("_fraction")).alias("quantile")
    )


def describe_numeric(
    df: DataFrame, columns: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    `df` is read once. `approximate` replaces the sorted quartiles by a sketch in that pass; else
    all figures come from the sorted counts of the values.
    """
    columns = columns or numeric_columns(df)
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    shown = ["column_name", "n", "mean", "std", "min", *quartiles, "max"]
    if approximate:
        return _sketched(df, columns, quartiles).select(shown)
    values = _ranges(sorted_values(df, columns))
    placed, sums = values
    every = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("column"))
    totals = sums.groupBy("column").agg(
        F.sum("_in").alias("n"), F.min("_min").alias("min"), F.max("_max").alias("max"),
        (F.sum("_sum") / F.sum("_in")).alias("mean"),
    )
    # One row per column beside the values.
    apart = placed.join(F.broadcast(totals.select("column", "mean")), "column")
    square = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2))
    spread = apart.groupBy("column").agg(
        F.when(F.sum("n") > 1, F.sqrt(square / (F.sum("n") - 1))).alias("std")
    )
    found = _quantiles(values, list(quartiles.values())).groupBy("column").agg(
        *[
            F.max(F.when(F.col("point") == p, F.col("quantile"))).alias(s)
            for s, p in quartiles.items()
        ]
    )
    result = every.join(totals, "column", "left").join(spread, "column", "left")
    result = result.join(found, "column", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _named(result, columns).select(shown)


def _sketched(df: DataFrame, columns: list[str], points: dict[str, float]) -> DataFrame:
    value = {c: F.nullif(_c(c).cast("double"), F.lit(float("nan"))) for c in columns}
    stats = {
        "n": lambda c: F.count(value[c]).cast("double"),
        "mean": lambda c: F.avg(value[c]),
        "std": lambda c: F.stddev_samp(value[c]),
        "min": lambda c: F.min(value[c]),
        "max": lambda c: F.max(value[c]),
    }
    for s, p in points.items():
        stats[s] = lambda c, p=p: F.percentile_approx(value[c], p, 10000)
    cells = [f(c).alias(f"{s}_{i}") for i, c in enumerate(columns) for s, f in stats.items()]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), *[F.col(f"{s}_{i}").alias(s) for s in stats]
            )
            for i, c in enumerate(columns)
        ]
    )
    wide = df.agg(*cells).select(F.inline(rows))
    return wide.withColumn("n", F.col("n").cast("bigint"))


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n, distinct_values, top, freq); of equally frequent values the smallest."""
    counts = value_frequencies(df, columns, "string")
    found = counts.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.min(F.struct(-F.col("n"), "value")).alias("_top"),
    ).select(
        "column", "n", "distinct_values", F.col("_top.value").alias("top"),
        (-F.col("_top.col1")).alias("freq"),
    )
    return _named(found, columns)


def describe_categorical(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, distinct values, top value and its frequency per text column."""
    return most_frequent(df, columns or text_columns(df))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL left out, with the share of the counted rows in percent."""
    counts = df.where(_c(column).isNotNull()).groupBy(_c(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return with_total(counts, "n", "_total").select(
        "value", "n", (F.col("n") / F.col("_total") * 100).alias("pct")
    )


def with_total(groups: DataFrame, column: str, total: str) -> DataFrame:
    """Aggregated groups with the sum of one of their columns beside each.

    Both sides of the join start from the shuffle of the groups, which Spark then makes once: what
    the groups were made of is read once. The total is one row.
    """
    return groups.crossJoin(F.broadcast(groups.agg(F.sum(column).alias(total))))


def impute(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Fill numbers with the median and texts with the most frequent value of the column.

    Whole number columns become double, as their median may lie between two values. One fill value
    per column reaches the driver; a column without any value stays as it is.
    """
    # Both are passes of their own, so they run beside each other.
    found = together(
        *([lambda: exact_quantiles(df, numeric, [0.5]).collect()] if numeric else []),
        *([lambda: most_frequent(df, categorical).collect()] if categorical else []),
    )
    fills: dict[str, object] = {r[0]: r["quantile" if "quantile" in r.asDict() else "top"] for rows in found for r in rows}

    def filled(f: T.StructField) -> Column:
        want = T.DoubleType() if isinstance(f.dataType, T.IntegralType) else f.dataType
        return F.coalesce(_c(f.name).cast(want), F.lit(fills[f.name]).cast(want))

    return df.withColumns({f.name: filled(f) for f in df.schema.fields if f.name in fills})

