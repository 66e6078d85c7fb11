"""The flat CSV source: scan, null texts, file order, newest file, cleaned output."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.functions import blank_tokens, parse_timestamp
from depotstar.functions.values import SOURCE_DATE_FORMAT
from depotstar.operators.sets import union_all
from depotstar.schemas import DATE_COLUMNS, ITEM_MAPPING, ORDER_MAPPING, SHIPMENT_MAPPING
from depotstar.session import shuffles_freed
from depotstar.sources.files import file_system

# Times in the files this library writes.
WRITTEN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Names of the file-position columns added by `with_file_order`.
FILE_ORDER = ["_file", "_block", "_row"]


def header_names(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Column names from the header line; Spark names a blank header `_c` plus its position."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    return reader.option("inferSchema", False).csv(path).columns


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files at `path`: itself, those of a folder, or those a pattern matches."""
    fs, glob = file_system(spark, path)
    found = []
    for entry in fs.globStatus(glob) or []:
        parts = fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [
            str(f.getPath()) for f in parts
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))
        ]
    return sorted(found)


def _first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    fs, p = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf())
    codec, opened = codecs.getCodec(p), fs.open(p)
    stream = opened if codec is None else codec.createInputStream(opened)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
    try:
        return reader.readLine()
    finally:
        reader.close()


def by_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[tuple[list[str], list[str]]]:
    """(column names, files) for each header line that occurs; empty files have none.

    One line of each file is read, several files at a time.
    """
    files = csv_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f, encoding), files))
    groups: dict[str, list[str]] = {}
    for line, file in zip(lines, files):
        if line is not None:
            groups.setdefault(line, []).append(file)
    return [(header_names(spark, own[0], encoding), own) for own in groups.values()]


def quoted_line_ends(spark: SparkSession, files: list[str]) -> set[str]:
    """The files that may hold line ends within quotes: those with a line of unpaired quotes.

    One pass over the lines of all files, which can be split among tasks; one row a file reaches the
    driver.
    """
    if not files:
        return set()
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2
    quoted = spark.read.text(files).where(F.contains("value", F.lit('"')))
    lines = quoted.select(F.col("_metadata.file_path").alias("file"), quotes.alias("odd"))
    found = lines.groupBy("file").agg(F.max("odd").alias("odd")).where("odd = 1").collect()
    # A scan names files by URL, a listing as they are.
    odd = {_without_scheme(unquote(r["file"])) for r in found}
    return {f for f in files if _without_scheme(f) in odd}


def _without_scheme(path: str) -> str:
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", path)


def _reader(spark: SparkSession, names: list[str], encoding: str, multi_line: bool, extra: str = ""):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *filter(None, [extra])]])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
    )


def read_flat(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    encoding: str = "UTF-8",
    null_tokens: bool = True,
    multi_line: bool | None = False,
    file_order: bool = False,
) -> DataFrame:
    """Every column as text, without type inference; `columns` prunes the scan.

    Columns are told by the header of each file, so files may have them in different orders, and a
    column that a file lacks is NULL there. `multi_line` reads quoted values with line ends as one
    value; such files cannot be split among tasks. With None, a first pass tells which files may have
    such values, and the others are split.
    """
    found = by_header(spark, path, encoding) or [(header_names(spark, path, encoding), [path])]
    wanted = columns or list(dict.fromkeys(n for names, _ in found for n in names))
    if multi_line is None:
        odd = quoted_line_ends(spark, [f for _, files in found for f in files])
        groups = [
            (names, own, whole)
            for names, files in found
            for whole, own in ((False, [f for f in files if f not in odd]), (True, [f for f in files if f in odd]))
            if own
        ]
    else:
        groups = [(names, files, multi_line) for names, files in found]
    parts = []
    for names, files, whole in groups:
        df = _reader(spark, names, encoding, whole).csv(files)
        if file_order:
            df = with_file_order(df)
        cells = []
        for n in wanted:
            cell = F.col(f"`{n}`") if n in names else F.lit(None).cast("string")
            cells.append((blank_tokens(cell) if null_tokens else cell).alias(n))
        parts.append(df.select(*cells, *(FILE_ORDER if file_order else [])))
    return union_all(parts)


def ragged_rows(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """(file, n): rows with more or fewer cells than their file's header, for files that have any.

    Spark cuts such rows, or fills them with NULL, without a word.
    """
    parts = []
    for names, files in by_header(spark, path, encoding):
        df = _reader(spark, names, encoding, multi_line, "_ragged").option(
            "columnNameOfCorruptRecord", "_ragged"
        ).option("columnPruning", False).csv(files)
        # All columns are asked for, or the parser would not look at all cells.
        cells = F.concat_ws("", *[F.col(f"`{n}`") for n in names])
        ragged = df.where(F.col("_ragged").isNotNull() & (F.length(cells) >= 0))
        parts.append(ragged.select(F.col("_metadata.file_name").alias("file")))
    if not parts:
        return spark.createDataFrame([], "file string, n bigint")
    return union_all(parts).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def source_columns() -> list[str]:
    """The source columns the three staging mappings need, each once."""
    return list(dict.fromkeys([*ORDER_MAPPING, *ITEM_MAPPING, *SHIPMENT_MAPPING]))


def read_for_staging(
    spark: SparkSession,
    path: str,
    encoding: str = "ISO-8859-1",
    date_format: str = SOURCE_DATE_FORMAT,
    file_order: bool = True,
    multi_line: bool | None = None,
) -> DataFrame:
    """The pruned scan behind the staging load, both dates parsed.

    Files without line ends in their values are split among tasks; `multi_line` tells whether there
    are any, where it is known.
    """
    df = read_flat(
        spark, path, source_columns(), encoding, multi_line=multi_line, file_order=file_order
    )
    return df.withColumns({c: parse_timestamp(F.col(f"`{c}`"), date_format) for c in DATE_COLUMNS})


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the position of each row: file, block within the file, row within the block.

    Must sit directly on the scan. The row id alone follows the order in which Spark packs blocks
    into tasks; with file and block start before it the order is that of the files.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def newest_file(
    spark: SparkSession, folder: str, pattern: str = "*_cleaned_*[0-9].csv"
) -> str:
    """Path of the cleaned output written last, told from file times alone; no data is read.

    An output is a folder of part files and is as new as its newest part. Unfinished outputs, which
    have no part yet, do not count. Equal times go to the greater name.
    """
    fs, glob = file_system(spark, f"{folder}/{pattern}")
    found = []
    for entry in fs.globStatus(glob) or []:
        files = [f for f in fs.listStatus(entry.getPath()) if f.isFile()]
        if files:
            found.append((max(f.getModificationTime() for f in files), str(entry.getPath())))
    if not found:
        raise FileNotFoundError(f"no {pattern} below {folder}")
    return max(found)[1]


def cleaned_path(path: str, now: datetime) -> str:
    """Name of the cleaned copy of `path`."""
    return f"{path.removesuffix('.csv')}_cleaned_{now:%Y%m%d_%H%M%S}.csv"


def write_flat(df: DataFrame, path: str, compression: str = "none") -> str:
    """Write UTF-8 CSV with a header, values as they are; the result is a folder of part files.

    With `compression`, `gzip` say, each of them is packed; `read_flat` reads them alike, but a packed
    file is not split among tasks.
    """
    writer = (
        df.write.option("header", True)
        .option("compression", compression)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("timestampFormat", WRITTEN_TIME_FORMAT)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with shuffles_freed(df.sparkSession):
        writer.csv(path)
    return path
