"""Reads a column list such as `id BIGINT NOT NULL, name VARCHAR(50)`; needs no running session."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
}
_SIZED = {"DECIMAL": T.DecimalType, "VARCHAR": T.VarcharType}


def read_layout(text: str) -> T.StructType:
    fields = []
    for column in re.split(r",\s+", text.strip()):
        name, kind, *rest = column.split()
        base, _, size = kind.rstrip(")").partition("(")
        kind_of = _SIZED[base](*map(int, size.split(","))) if size else _TYPES[base]
        fields.append(T.StructField(name, kind_of, nullable=rest != ["NOT", "NULL"]))
    return T.StructType(fields)
