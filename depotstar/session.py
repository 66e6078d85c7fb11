"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}

# Option of the Parquet files that this library writes; digits and keys take a third less than by default.
COMPRESSION = {"compression": "zstd"}
# Spark's setting that lets go the shuffle files of a query as soon as it has ended.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# By session: how many writes are in `shuffles_freed`, and what the setting was before.
_freeing: dict[int, list] = {}
_lock = threading.Lock()


def build_session(app: str = "depotstar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects.

    Skew joins are split at run time even where that costs one more shuffle, and small shuffles are
    merged. `conf` keys use `__` for the dot, e.g. `spark__sql__shuffle__partitions="8"`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Recording the Python line of every column costs more than planning a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local master may run without it; it then gets a folder of its own, one per application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="depotstar-")
    return _local_dirs[app]


def _own_dir(spark: SparkSession) -> str:
    """What this application stages, all below one folder."""
    return f"{work_dir(spark)}/depotstar/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}/{name}"


def remove_staged(spark: SparkSession) -> None:
    """Remove all that this application has staged; frames made from it can't be used after.

    A job calls this when its results are written. Staged files of a lost job are those of an
    application that no longer runs, and can be removed with its folder.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files behind.

    Otherwise these stay on the disks until the driver happens to collect its garbage, those of all
    steps of a job together. Meant for writes, whose rows nobody asks for again; entered by
    several threads at once, it holds until the last of them has left.
    """
    at = spark._jsparkSession.hashCode()
    with _lock:
        if at not in _freeing:
            _freeing[at] = [0, spark.conf.get(_FREE, None)]
            spark.conf.set(_FREE, "true")
        _freeing[at][0] += 1
    try:
        yield
    finally:
        with _lock:
            _freeing[at][0] -= 1
            if not _freeing[at][0]:
                before = _freeing.pop(at)[1]
                if before is None:
                    spark.conf.unset(_FREE)
                else:
                    spark.conf.set(_FREE, before)


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", partitions: list[str] | None = None, **options: str
) -> None:
    """Write `df` as Parquet, as all of this library's own tables are written."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).options(**COMPRESSION, **options).parquet(path, partitionBy=partitions)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The lineage ends at the written files, which outlive any executor, and Spark plans the next
    join from their true size.
    """
    return stage_at(df, fresh_path(df.sparkSession, name))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """As `stage`, at a path that the caller removes."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, on which Spark decides whether to broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """Size of the largest table `df` reads, from its files.

    For a chain of lookups this tells the size of the result better than the estimate, which
    multiplies the sizes of the two sides of each join.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(sizes, default=0)


def together(*jobs: Callable[[], object]) -> list:
    """Run independent jobs at the same time and return their results in order.

    Spark fills the cluster with the tasks of all of them; the first error is raised.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
