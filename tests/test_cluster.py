"""Tables written along a space-filling curve."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from depotstar.operators import cluster


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(60_000).selectExpr(
        "id", "cast(pmod(hash(id), 500) as int) as a", "cast(pmod(hash(id, 1), 70) as int) as b",
        # A third of all rows have one value of c, and some none.
        "case when id % 3 = 0 then 7 when id % 50 = 1 then null else cast(pmod(hash(id, 2), 1000) as int) end as c",
    )


def test_filters_on_any_column_skip_most_row_groups(points, spark, tmp_path):
    path = str(tmp_path / "t")
    cluster.write_clustered(points, path, ["a", "b", "c"], files=512)
    groups = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            own = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(4)}
            groups.append(own)
    for column, value in (("a", 123), ("b", 33), ("c", 801)):
        read = sum(g[column].has_min_max and g[column].min <= value <= g[column].max for g in groups)
        assert read < 0.25 * len(groups), column
        share = cluster.share_read(spark.read.parquet(path), column, value, value).scalar()
        assert spark.range(1).select(share).first()[0] == pytest.approx(read / len(groups), abs=0.01)
    back = spark.read.parquet(path)
    assert back.count() == 60_000 and back.exceptAll(points).isEmpty()
    # No file is much larger than its share, hot value or not.
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 4 * 60_000 / 512


def test_partitions_and_small_tables(points, spark, tmp_path):
    path = str(tmp_path / "p")
    some = points.limit(300).withColumn("month", F.col("id") % 3)
    cluster.write_clustered(some, path, ["a", "c"], files=6, partitions=["month"])
    assert spark.read.parquet(path).where("month = 1").count() == some.where("month = 1").count()
    none = str(tmp_path / "none")
    cluster.write_clustered(points.limit(0), none, ["a"], files=4)
    assert spark.read.schema(points.schema).parquet(none).count() == 0


def test_curve_orders_by_interleaved_slices(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    got = {(r.x, r.y): r.z for r in df.withColumn("z", cluster.curve(df, ["x", "y"], bits=2)).collect()}
    assert got[0, 0] == 0 and got[3, 3] == max(got.values())
    assert got[1, 0] < got[0, 1] < got[2, 0] < got[0, 2]
