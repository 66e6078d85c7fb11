"""Column functions: text, numbers, dates."""

from depotstar.functions.values import (
    NULL_TOKENS,
    blank_tokens,
    date_parts,
    drop_sentinel,
    parse_date,
    parse_timestamp,
    percent,
    strip,
    to_number,
)

__all__ = [
    "NULL_TOKENS", "blank_tokens", "date_parts", "drop_sentinel", "parse_date", "parse_timestamp",
    "percent", "strip", "to_number",
]
