"""Column -> Column helpers. All of them stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text a CSV reader of the pandas family takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the date format of the source file.
SOURCE_DATE_FORMAT = "M/d/yyyy H:mm"

# Every character Python's str.strip removes; none lies above U+3000.
_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# try_cast alone would also take Java literals such as '1d'.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(?i)[+-]?inf(inity)?$"


def strip(c: Column) -> Column:
    """Trim tabs, line ends and Unicode spaces as well as blanks."""
    return F.btrim(c, F.lit(_WHITESPACE))


def blank_tokens(c: Column) -> Column:
    """NULL for every text that stands for a missing value."""
    return F.when(~c.isin(NULL_TOKENS), c)


def drop_sentinel(c: Column, sentinel: str) -> Column:
    """NULL where the value is the masking text."""
    return F.when(~c.eqNullSafe(F.lit(sentinel)), c)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_timestamp(c: Column, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """Text to timestamp by one stated format; anything else becomes NULL."""
    return F.try_to_timestamp(strip(c), F.lit(fmt))


def parse_date(c: Column, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """As `parse_timestamp`, without the time of day."""
    return parse_timestamp(c, fmt).cast("date")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """part / whole * 100, rounded half to even; NULL when the whole is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.rint(ratio * 10**places) / 10**places


def date_parts(d: Column) -> dict[str, Column]:
    """Calendar columns of a date, weekdays counted from Monday = 1."""
    return {
        "day_of_week": F.weekday(d) + 1,
        "month_number": F.month(d),
        "quarter_number": F.quarter(d),
        "year": F.year(d),
        "is_weekend": F.weekday(d) >= 5,
    }
