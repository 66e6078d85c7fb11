"""Versions valid on a date, and snapshots in any order."""

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from depotstar.operators import asof, change

DAY = date(2020, 1, 1)


def plain_version(history, key, at):
    """The last version of the key from that day on or before, if it has not ended."""
    if key is None or at is None:
        return None
    own = [h for h in history if h[0] == key and h[1] <= at]
    last = max(own, key=lambda h: h[1], default=None)
    return last[3] if last and at <= last[2] else None


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_valid_version(spark, ranges):
    r = random.Random(ranges)
    history = []
    for key in range(1, 8):
        days = sorted(r.sample(range(60), r.randrange(1, 9)))
        for a, b in zip(days, [*days[1:], 9999]):
            ends = DAY + timedelta(min(b - 1, a + r.choice([2, 9999])))  # some versions end early
            history.append((key, DAY + timedelta(a), ends, f"{key}-{a}"))
    history.append((None, DAY, DAY + timedelta(99), "nobody"))
    # Key 1 has a third of the facts, many of them on one day; key 9 has no versions.
    facts = [(i, 1, DAY + timedelta(30 if i % 2 else r.randrange(-5, 70))) for i in range(200)]
    facts += [(i, r.choice([None, 2, 3, 4, 5, 6, 7, 9]), r.choice([None, DAY + timedelta(r.randrange(-5, 70))])) for i in range(400)]
    facts += facts[:20]
    f = spark.createDataFrame(facts, "id int, customer int, day date")
    h = spark.createDataFrame(history, "key int, effective_date date, expiry_date date, segment string")
    got = asof.valid_version(f, h, {"customer": "key"}, "day", ["segment"], ranges=ranges)
    assert got.columns == ["id", "customer", "day", "segment"]
    expected = [(*x, plain_version(history, x[1], x[2])) for x in facts]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_valid_version_of_nothing(spark):
    f = spark.createDataFrame([(1, DAY)], "k int, day date")
    h = spark.createDataFrame([], "k int, effective_date date, expiry_date date, v string")
    assert [tuple(r) for r in asof.valid_version(f, h, {"k": "k"}, "day", ["v"]).collect()] == [(1, DAY, None)]
    assert asof.valid_version(f.limit(0), h, {"k": "k"}, "day", ["v"]).count() == 0


def test_valid_version_by_two_keys_and_time(spark):
    f = spark.sql("SELECT 1 AS a, 'x' AS b, timestamp'2020-01-01 12:00:00' AS at UNION ALL SELECT 1, 'y', timestamp'2020-01-01 12:00:00'")
    h = spark.sql("SELECT 1 AS a, 'x' AS b, timestamp'2020-01-01 11:00:00' AS since, 5 AS v UNION ALL SELECT 1, 'x', timestamp'2020-01-01 13:00:00', 6")
    got = asof.valid_version(f, h, {"a": "a", "b": "b"}, "at", ["v"], effective="since", expiry=None)
    assert sorted((r.b, r.v) for r in got.collect()) == [("x", 5), ("y", None)]


def test_ranges_split_a_hot_key(spark):
    """No range holds much more than its share, though one key and day own all facts."""
    f = spark.range(4000).select(F.lit(1).alias("k"), F.lit(DAY).alias("day"), "id")
    h = spark.createDataFrame([(1, DAY, date(9999, 12, 31), "v")], "k int, effective_date date, expiry_date date, s string")
    got = asof.valid_version(f, h, {"k": "k"}, "day", ["s"], ranges=8)
    assert got.where("s = 'v'").count() == 4000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan


def states(r, days):
    """A snapshot a day: some keys, each with one of three states."""
    return {d: {k: r.choice("abc") for k in [None, 1, 2, 3, 4] if r.random() < 0.7} for d in days}


def plain_history(snapshots):
    out = []
    for key in {k for s in snapshots.values() for k in s}:
        versions = []
        for d in sorted(snapshots):
            if key in snapshots[d]:
                if versions and versions[-1][0] == snapshots[d][key]:
                    versions[-1][1].append(d)
                else:
                    versions.append((snapshots[d][key], [d]))
        for i, (state, seen) in enumerate(versions):
            last = i + 1 == len(versions)
            ends = date(9999, 12, 31) if last else versions[i + 1][1][0] - timedelta(1)
            out.append((key, state, seen[0], ends, last, i + 1, seen))
    return sorted(out, key=str)


def put(spark, dim, day, snapshot):
    df = spark.createDataFrame([(k, v) for k, v in snapshot.items()], "k int, s string")
    rows = change.put_snapshot(dim, df, ["k"], ["s"], day).collect()
    return spark.createDataFrame(rows, dim.schema)


def begin(spark):
    events = spark.createDataFrame([], "k int, s string, day date")
    return change.seen_history(events, ["k"], ["s"], "day", ["day"])


def collected(dim):
    return sorted((tuple(r) for r in dim.collect()), key=str)


def test_snapshots_in_any_order_give_one_history(spark):
    r = random.Random(8)
    days = [DAY + timedelta(n) for n in (0, 3, 4, 9)]
    orders = list(itertools.permutations(days))
    for order in r.sample(orders, 4):
        snapshots = states(r, days)
        dim, put_in = begin(spark), {}
        for day in order:
            dim = put(spark, dim, day, snapshots[day])
            put_in[day] = snapshots[day]
            assert collected(dim) == plain_history(put_in)


def test_a_snapshot_of_a_day_replaces_the_one_before(spark):
    r = random.Random(2)
    days = [DAY, DAY + timedelta(2), DAY + timedelta(5)]
    snapshots = states(r, days)
    dim = begin(spark)
    for day in days:
        dim = put(spark, dim, day, snapshots[day])
    for day in (days[1], days[2], days[0]):
        fresh = states(r, [day])[day]
        # Keys that the second snapshot lacks keep what the first one said.
        snapshots[day] = {**snapshots[day], **fresh}
        dim = put(spark, dim, day, fresh)
        assert collected(dim) == plain_history(snapshots)
        assert collected(put(spark, dim, day, fresh)) == plain_history(snapshots)


def test_seen_history_is_that_of_the_snapshots(spark):
    r = random.Random(5)
    snapshots = states(r, [DAY + timedelta(n) for n in range(6)])
    rows = [(k, v, d) for d, s in snapshots.items() for k, v in s.items()]
    events = spark.createDataFrame(rows, "k int, s string, day date")
    got = change.seen_history(events, ["k"], ["s"], "day", ["day"])
    assert collected(got) == plain_history(snapshots)
    plain = change.history(events, ["k"], ["s"], "day", ["day"])
    assert collected(got.drop("seen")) == collected(plain.select(got.drop("seen").columns))
