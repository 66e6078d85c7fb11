"""Names and texts written into SQL expressions.

Wide constructs, one part per column or rule, are written as one SQL expression: building them
column by column costs a call to the JVM for every piece.
"""

from __future__ import annotations


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A text literal; a backslash begins an escape in Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
