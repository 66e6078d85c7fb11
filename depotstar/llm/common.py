"""Helpers of the operators here: tables, folds, Arrow batches, tokens of bytes."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A Python worker is handed at most this much of a table at once.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make Python workers ready: they get this package, and batches bounded by bytes.

    The package goes to executors with Spark's own file distribution, once an application, so that
    it need not be installed there. Without the bound on bytes, long texts would pile up.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        out.write(file, os.path.relpath(file, os.path.dirname(package)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a NULL id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns an operator needs, under fixed names; a NULL text counts as empty."""
    return docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def words_of(text: bytes) -> list[bytes]:
    """Words between blanks x09-x0D and x20, with A-Z in lower case.

    For bytes, Python's lower() and split() mean just these letters and blanks.
    """
    return text.lower().split()
