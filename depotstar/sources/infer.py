"""Types of text columns, told from all rows by one aggregate.

Each cell says which types its text can have, one bit a type; a column has what all its cells allow,
the `and` of the bits. With the most digits before and after the point that is a state of three
numbers a column, and states of parts merge to the state of the whole. So no sample decides, and a
grown table is judged by the new rows and the state of the old ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import parse_timestamp, strip, to_number
from depotstar.functions.sqltext import name, text
from depotstar.functions.values import SOURCE_DATE_FORMAT
from depotstar.sources import csv

#: Formats looked for; those without a time of day make dates.
DATE_FORMATS = (SOURCE_DATE_FORMAT, "M/d/yyyy", "yyyy-MM-dd", csv.WRITTEN_TIME_FORMAT)

# Bits of the types; those of the date formats follow.
_BOOLEAN, _WHOLE, _DECIMAL, _DOUBLE, _FIRST_DATE = 1, 2, 4, 8, 16
_MOST_DIGITS = 38

STATE = "column_name string, bits bigint, whole_digits int, places int"


@dataclass(frozen=True)
class Inferred:
    """The type of a column, and the date format if it has one."""

    type: str
    date_format: str | None = None

    def value(self, cell: Column) -> Column:
        """The typed value of a text; all texts of the column have one."""
        if self.date_format:
            return parse_timestamp(cell, self.date_format).cast(self.type)
        if self.type == "boolean":
            return F.lower(strip(cell)) == "true"
        if self.type == "double":
            return to_number(cell)
        return cell if self.type == "string" else strip(cell).cast(self.type)


def _form(date_format: str) -> str:
    """A pattern that texts of a date format have, cheaper to test than the format."""
    return "^" + re.sub(r"[yMdHhms]+", r"\\\\d+", re.escape(date_format).replace("\\", "\\\\")) + "$"


def _bits(c: str, date_formats: tuple[str, ...]) -> str:
    """SQL: the types that the stripped text `c` can have; NULL allows all."""
    tests = [
        (_BOOLEAN, f"lower({c}) in ('true', 'false')"),
        (_WHOLE, rf"{c} rlike '^[+-]?\\d+$' and try_cast({c} as bigint) is not null"),
        (_DECIMAL, rf"{c} rlike '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$'"),
        (_DOUBLE, rf"{c} rlike '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$|^(?i)[+-]?inf(inity)?$'"),
    ]
    for i, f in enumerate(date_formats):
        tests.append((
            _FIRST_DATE << i, f"{c} rlike '{_form(f)}' and try_to_timestamp({c}, {text(f)}) is not null"
        ))
    return f"if({c} is null, null, {' | '.join(f'if({t}, {bit}L, 0L)' for bit, t in tests)})"


def type_states(df: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """One row a column of texts: what all its values allow. One pass, nothing is shuffled but a row
    a task."""
    stripped = df.select([strip(F.col(name(c))).alias(f"c{i}") for i, c in enumerate(df.columns)])
    numbers = r"'^[+-]?(\\d+\\.?\\d*|\\.\\d+)$'"
    aggregates = []
    for i in range(len(df.columns)):
        c = f"c{i}"
        plain = rf"ltrim('0', regexp_extract({c}, '^[+-]?(\\d*)', 1))"
        aggregates += [
            F.expr(f"bit_and({_bits(c, date_formats)}) as b{i}"),
            F.expr(f"max(if({c} rlike {numbers}, length({plain}), null)) as w{i}"),
            F.expr(f"max(if({c} rlike {numbers}, length(split_part({c}, '.', 2)), null)) as p{i}"),
        ]
    states = ", ".join(
        f"struct({text(c)} as column_name, b{i} as bits, w{i} as whole_digits, p{i} as places)"
        for i, c in enumerate(df.columns)
    )
    return stripped.agg(*aggregates).selectExpr(f"inline(array({states}))")


def merge_states(states: DataFrame) -> DataFrame:
    """The states of whole columns from those of their parts."""
    return states.groupBy("column_name").agg(
        F.bit_and("bits").alias("bits"), F.max("whole_digits").alias("whole_digits"),
        F.max("places").alias("places"),
    )


def _resolve(bits: int | None, whole: int | None, places: int | None, formats: tuple[str, ...]) -> Inferred:
    if bits is None:
        return Inferred("string")
    if bits & _BOOLEAN:
        return Inferred("boolean")
    if bits & _WHOLE:
        return Inferred("bigint")
    if bits & _DECIMAL and whole + places <= _MOST_DIGITS:
        return Inferred(f"decimal({max(whole + places, 1)},{places})")
    if bits & _DOUBLE:
        return Inferred("double")
    for i, f in enumerate(formats):
        if bits & _FIRST_DATE << i:
            return Inferred("timestamp" if re.search("[Hhms]", f) else "date", f)
    return Inferred("string")


def resolve(states: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS) -> dict[str, Inferred]:
    """The narrowest type of each column: boolean, whole number, decimal, double, dates in the order
    given, text. A column without any value is text. One row a column reaches the driver."""
    return {
        r["column_name"]: _resolve(r["bits"], r["whole_digits"], r["places"], date_formats)
        for r in states.collect()
    }


def typed(df: DataFrame, types: dict[str, Inferred]) -> DataFrame:
    """The columns as values of their types; `types` must be those of all rows."""
    return df.select([types[c].value(F.col(name(c))).alias(c) for c in df.columns])


def infer_types(df: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """A frame of texts with the types that all its rows allow.

    Equal values are equal then, however they are written: 1.0 and 1.00, True and TRUE.
    """
    return typed(df, resolve(type_states(df, date_formats), date_formats))


def read_typed(
    spark: SparkSession, path: str, date_formats: tuple[str, ...] = DATE_FORMATS, **options
) -> DataFrame:
    """A CSV scan with inferred types; `options` are those of `csv.read_flat`."""
    return infer_types(csv.read_flat(spark, path, **options), date_formats)


def described(types: dict[str, Inferred], spark: SparkSession) -> DataFrame:
    """One row a column: its type and date format."""
    layout = T.StructType([T.StructField(n, T.StringType()) for n in ("column_name", "type", "date_format")])
    return spark.createDataFrame([(c, t.type, t.date_format) for c, t in types.items()], layout)
