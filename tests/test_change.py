"""Upserts, history, incremental loads."""

import os
from datetime import date, datetime

from pyspark.sql import functions as F

from depotstar.operators import change
from depotstar.sources import steps
from depotstar.streaming import incremental


def test_upsert_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    once = change.upsert(target, batch, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(change.upsert(once, batch, ["k"])) == rows(once)
    assert rows(change.new_keys(batch, target, ["k"])) == [("c", 3)]


def test_history(spark, rows):
    events = spark.createDataFrame(
        [
            (1, "a", datetime(2024, 1, 1, 8), 1), (1, "b", datetime(2024, 1, 1, 9), 2),
            (1, "b", datetime(2024, 1, 3), 3), (1, None, datetime(2024, 1, 5), 4),
            (1, None, datetime(2024, 1, 6), 5), (1, "b", datetime(2024, 2, 1), 6),
            (2, "z", datetime(2024, 1, 1), 7),
        ],
        "k int, v string, t timestamp, n int",
    )
    got = rows(change.history(events, ["k"], ["v"], "t", ["n"]))
    end = change.OPEN_END
    assert got == [
        (1, None, date(2024, 1, 5), date(2024, 1, 31), False, 2),
        (1, "b", date(2024, 1, 1), date(2024, 1, 4), False, 1),
        (1, "b", date(2024, 2, 1), end, True, 3),
        (2, "z", date(2024, 1, 1), end, True, 1),
    ]


def test_apply_snapshot(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    dim = change.with_open_history(first, F.lit(date(2024, 1, 1)))
    snapshot = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (4, "d")], "k int, v string")
    day = date(2024, 6, 1)
    once = change.apply_snapshot(dim, snapshot, ["k"], ["v"], day)
    end = change.OPEN_END
    assert rows(once) == [
        (1, "a", date(2024, 1, 1), end, True, 1),
        (2, None, date(2024, 1, 1), date(2024, 5, 31), False, 1),
        (2, "b", day, end, True, 2),
        (3, "c", date(2024, 1, 1), end, True, 1),
        (4, "d", day, end, True, 1),
    ]
    assert rows(change.apply_snapshot(once, snapshot, ["k"], ["v"], day)) == rows(once)


def test_a_second_snapshot_of_a_day_replaces_the_first(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    dim = change.with_open_history(first, F.lit(date(2024, 1, 1)))

    def apply(dim, data, day):
        return change.apply_snapshot(dim, spark.createDataFrame(data, "k int, v string"), ["k"], ["v"], day)

    day, end = date(2024, 6, 1), change.OPEN_END
    draft = apply(dim, [(1, "x"), (2, "y"), (4, "d")], day)
    got = rows(apply(draft, [(1, "z"), (2, "b"), (4, "dd")], day))
    assert got == [
        (1, "a", date(2024, 1, 1), date(2024, 5, 31), False, 1),
        (1, "z", day, end, True, 2),
        (2, "b", date(2024, 1, 1), end, True, 1),  # as it was before the draft
        (3, "c", date(2024, 1, 1), end, True, 1),
        (4, "dd", day, end, True, 1),
    ]
    # A snapshot older than the history changes nothing, but adds what it lacks.
    late = rows(apply(draft, [(1, "old"), (5, "e")], date(2024, 3, 1)))
    assert late == sorted([*rows(draft), (5, "e", date(2024, 3, 1), end, True, 1)])


LAYOUT = "order_id string, v string, n int"


def drop_file(spark, folder, name, data):
    """Put one parquet file of rows into the watched folder."""
    import glob
    import os
    import shutil

    temp = f"{folder}_{name}"
    spark.createDataFrame(data, LAYOUT).coalesce(1).write.parquet(temp)
    os.makedirs(folder, exist_ok=True)
    shutil.copy(glob.glob(f"{temp}/part-*")[0], f"{folder}/{name}.parquet")


def test_append_new_keeps_the_first_row_per_key(spark, rows, tmp_path):
    folder, target, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    schema = spark.createDataFrame([], LAYOUT).schema

    def load():
        return incremental.append_new(
            spark, folder, schema, target, mark, ["order_id"], ["n"], files_per_batch=1
        ).select("order_id", "v", "n")

    drop_file(spark, folder, "a", [("1", "first", 1), ("1", "again", 2), ("2", "x", 1)])
    assert rows(load()) == [("1", "first", 1), ("2", "x", 1)]
    assert rows(load()) == [("1", "first", 1), ("2", "x", 1)]
    drop_file(spark, folder, "b", [("1", "late", 0), ("3", "new", 1)])
    drop_file(spark, folder, "c", [("3", "later", 0), ("4", "y", 1)])
    got = rows(load())
    assert [r[0] for r in got] == ["1", "2", "3", "4"] and got[0] == ("1", "first", 1)


def test_a_lost_checkpoint_loses_and_repeats_nothing(spark, rows, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "table")
    schema = spark.createDataFrame([], LAYOUT).schema

    def load(mark):
        return incremental.append_new(
            spark, folder, schema, target, str(tmp_path / mark), ["order_id"], ["n"]
        ).select("order_id", "v", "n")

    drop_file(spark, folder, "a", [("1", "first", 1)])
    load("one")
    assert rows(load("two")) == [("1", "first", 1)]
    drop_file(spark, folder, "b", [("1", "late", 0), ("2", "new", 1)])
    assert rows(load("three")) == [("1", "first", 1), ("2", "new", 1)]
    assert [s.files for s in listed(spark, target)] == [["a.parquet"], ["b.parquet"]]


def listed(spark, root):
    found = steps._all(spark, root).orderBy("number").collect()
    return [
        steps.Step(r.number, r.folder, r.base, [f.rsplit("/", 1)[1] for f in r.files]) for r in found
    ]


def test_upsert_new(spark, rows, tmp_path):
    folder, root, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    schema = spark.createDataFrame([], LAYOUT).schema

    def load(mark=mark):
        return incremental.upsert_new(
            spark, folder, schema, root, mark, ["order_id"], ["n"], files_per_batch=1
        )

    drop_file(spark, folder, "a", [("1", "old", 1), ("1", "new", 2), ("2", "x", 1)])
    assert rows(load()) == [("1", "new", 2), ("2", "x", 1)]
    drop_file(spark, folder, "b", [("2", "y", 5), ("3", "z", 1), (None, "n", 1)])
    assert rows(load()) == [(None, "n", 1), ("1", "new", 2), ("2", "y", 5), ("3", "z", 1)]
    # An older row comes late, and the checkpoint is lost.
    drop_file(spark, folder, "c", [("2", "older", 4), ("1", "newest", 9)])
    expected = [(None, "n", 1), ("1", "newest", 9), ("2", "y", 5), ("3", "z", 1)]
    assert rows(load(str(tmp_path / "other"))) == expected
    assert len(listed(spark, root)) == 3

    incremental.compact(load(), root)
    assert rows(load()) == expected
    assert len(os.listdir(f"{root}/rows")) == 1
    drop_file(spark, folder, "d", [("4", "w", 1), ("3", "zz", 2)])
    assert rows(load()) == [*expected[:3], ("3", "zz", 2), ("4", "w", 1)]


def test_an_unlisted_step_is_not_seen(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a", 1)], LAYOUT)
    assert steps.read(spark, root, df.schema).columns == [*df.columns, steps.STEP]
    assert steps.read(spark, root, df.schema).count() == 0
    assert steps.add(df, root, ["f"]) == 1
    df.withColumn(steps.STEP, F.lit(2)).write.parquet(f"{root}/rows/2-lost")  # a driver lost here
    assert rows(steps.read(spark, root, df.schema)) == [("1", "a", 1, 1)]
    assert steps.add(df, root, ["g"]) == 2
    assert steps.read(spark, root, df.schema).count() == 2
    batch = spark.createDataFrame([("f",), ("h",), ("h",)], "file string")
    assert rows(steps.unseen(batch, root, "file")) == [("h",)]
    steps.expire(spark, root)
    assert len(os.listdir(f"{root}/rows")) == 2 and steps.read(spark, root, df.schema).count() == 2


def test_upsert_new_prepares_rows(spark, rows, tmp_path):
    folder = str(tmp_path / "in")
    schema = spark.createDataFrame([], LAYOUT).schema
    drop_file(spark, folder, "a", [("1", "old", 1), ("2", "x", 1)])
    got = incremental.upsert_new(
        spark, folder, schema, str(tmp_path / "t"), str(tmp_path / "m"), ["order_id"], ["n"],
        prepare=lambda df: df.where("order_id <> '2'"),
    )
    assert rows(got) == [("1", "old", 1)]


def test_open_history_columns(spark):
    row = change.with_open_history(spark.range(1), F.lit("2024-01-01")).first()
    assert (row.effective_date, row.expiry_date, row.is_current, row.version) == (
        date(2024, 1, 1), date(9999, 12, 31), True, 1,
    )


def test_rows_sent_again_are_dropped_on_arrival(spark, rows, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "table")
    schema = spark.createDataFrame([], LAYOUT).schema

    def load(mark="mark", delay="30 days"):
        return incremental.append_once(
            spark, folder, schema, target, str(tmp_path / mark), ["order_id"], ["n"], delay
        ).select("order_id", "v", "n")

    def written():
        return [r["n"] for r in steps.read(spark, target, schema).groupBy(steps.STEP).agg(F.count("*").alias("n")).orderBy(steps.STEP).collect()]

    drop_file(spark, folder, "a", [("1", "first", 1), ("1", "again", 2), ("2", None, 1), (None, "x", 1)])
    expected = [(None, "x", 1), ("1", "first", 1), ("2", None, 1)]
    assert rows(load()) == expected and written() == [3]
    # The same rows, one of them twice, a changed one and a new one.
    drop_file(spark, folder, "b", [("1", "first", 1), ("2", None, 1), ("2", None, 1), ("1", "late", 0), (None, "x", 1), ("3", "new", 1)])
    expected.append(("3", "new", 1))
    assert rows(load()) == expected and written() == [3, 2]
    # A lost checkpoint writes nothing of known files again.
    drop_file(spark, folder, "c", [("3", "new", 1), ("4", "y", 1)])
    expected.append(("4", "y", 1))
    assert rows(load("other")) == expected and written()[:2] == [3, 2]
    # Without memory (a delay long gone), rows sent again are written, and left out when read.
    drop_file(spark, folder, "d", [("1", "first", 1), ("5", "z", 1)])
    expected.append(("5", "z", 1))
    assert rows(load("third", "1 second")) == expected


def test_stream_state_is_bounded_by_the_delay(spark, tmp_path):
    import time

    from pyspark.sql.streaming import StreamingQueryListener

    folder, target, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    schema = spark.createDataFrame([], LAYOUT).schema
    held = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            held.extend(s.numRowsTotal for s in event.progress.stateOperators)

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    try:
        for n in range(4):
            drop_file(spark, folder, f"f{n}", [(f"{n}-{i}", "v", 1) for i in range(50)])
            got = incremental.append_once(spark, folder, schema, target, mark, ["order_id"], ["n"], "1 second")
            time.sleep(1.5)
        assert got.count() == 200
        deadline = time.time() + 20
        while not held and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    # The last batch of a run lets go of what the ones before it left.
    assert held and held[-1] < 200 and held[-1] <= 2 * held[1]


def test_a_batch_moves_no_row_for_its_files_and_is_read_once_where_it_has_state(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    schema = spark.createDataFrame([], LAYOUT).schema
    plans, add = [], steps.add

    def watched(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return add(df, *args)

    monkeypatch.setattr(steps, "add", watched)
    drop_file(spark, folder, "a", [("1", "first", 1), ("2", "x", 1)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, load in (("new", incremental.append_new), ("once", incremental.append_once)):
            load(spark, folder, schema, str(tmp_path / name), str(tmp_path / f"{name}_mark"), ["order_id"], ["n"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) == 2 and not any("SortMergeJoin" in p for p in plans)
    assert "FileScan parquet" in plans[1]
