"""Parquet tables: plain loads and whole-set versions that switch at once."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from depotstar.session import together, write_parquet
from depotstar.sources.files import exists, file_system

_MARK = "_COMPLETE"


def append(df: DataFrame, path: str) -> None:
    """Add rows to a table."""
    write_parquet(df, path, "append")


def replace(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Put `df` in the place of a table. `df` must not read the table itself."""
    write_parquet(df, path, "overwrite", partitions)


def empty(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Leave a table with its layout and no rows."""
    replace(spark.createDataFrame([], schema), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions below `root`, oldest first. One small listing, no data read."""
    if not exists(spark, root):
        return []
    fs, p = file_system(spark, root)
    found = []
    for status in fs.listStatus(p):
        m = re.fullmatch(r"v(\d+)", status.getPath().getName())
        if m and exists(spark, f"{root}/{status.getPath().getName()}/{_MARK}"):
            found.append(int(m.group(1)))
    return sorted(found)


def version_path(root: str, version: int) -> str:
    return f"{root}/v{version}"


def next_version(spark: SparkSession, root: str) -> int:
    done = versions(spark, root)
    return done[-1] + 1 if done else 1


def finish(spark: SparkSession, root: str, version: int) -> None:
    """Make a version visible. One file creation, so readers see all of its tables or none."""
    fs, p = file_system(spark, f"{version_path(root, version)}/{_MARK}")
    fs.create(p, True).close()


def is_finished(spark: SparkSession, root: str, version: int) -> bool:
    return exists(spark, f"{version_path(root, version)}/{_MARK}")


def write_version(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> int:
    """Full reload: write every table to a new version, then switch.

    The frames may read the current version; it stays in place. An unfinished version left by a
    lost driver is written over, so running the reload again gives the same result.
    """
    version = next_version(spark, root)

    def write(name: str) -> Callable[[], None]:
        return lambda: replace(tables[name], f"{version_path(root, version)}/{name}")

    together(*[write(name) for name in tables])
    finish(spark, root, version)
    return version


def read_version(
    spark: SparkSession, root: str, name: str, version: int | None = None
) -> DataFrame:
    """A table of one version, by default the newest finished one."""
    if version is None:
        done = versions(spark, root)
        if not done:
            raise FileNotFoundError(f"no finished version below {root}")
        version = done[-1]
    return read(spark, f"{version_path(root, version)}/{name}")


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all finished versions but the newest `keep`; readers of those lose nothing."""
    for version in versions(spark, root)[:-keep]:
        # Without its mark no new reader finds the version while its files go.
        for path in (f"{version_path(root, version)}/{_MARK}", version_path(root, version)):
            fs, p = file_system(spark, path)
            fs.delete(p, True)
