"""File listing through Hadoop's file system API, for any store Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system that holds `path`, and the path object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A new small file, put in place by a rename: readers see all of it or none."""
    fs, path = file_system(spark, f"{folder}/{name}")
    hidden = file_system(spark, f"{folder}/.{name}")[1]
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(hidden, path):
        raise RuntimeError(f"{folder}/{name} is there already")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it; nothing happens where there is none."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)
