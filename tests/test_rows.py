"""Deduplication, keys, lookups, reshaping."""

import random
from datetime import datetime
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from depotstar.layouts import read_layout
from depotstar.operators import dedupe, keys, reshape
from depotstar.operators.joins import broadcast_limit, hot_keys, left_lookup, matching, may_match, sifted
from depotstar.operators.sets import union_all
from depotstar.schemas import conform


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a"), (2, "a ")], "k int, v string")
    assert dedupe.drop_duplicate_rows(df).count() == 3
    assert dedupe.count_duplicates(df).first()[0] == 2
    assert dedupe.count_duplicates(df.limit(0)).first()[0] == 0
    assert rows(dedupe.duplicate_rows(df)) == [(1, None, 2)]
    assert tuple(dedupe.row_census(df).first()) == (5, 3, 2)
    assert tuple(dedupe.row_census(df.limit(0)).first()) == (0, 0, 0)


def test_keep_first(spark, rows):
    data = [("a", 2, "second"), ("a", 1, "first"), (None, 5, "null"), (None, 4, "null first"), ("b", 1, None)]
    df = spark.createDataFrame(data, "k string, o int, v string").repartition(4)
    assert rows(dedupe.keep_first(df, ["k"], ["o"])) == [(None, "null first"), ("a", "first"), ("b", None)]


def test_first_match(spark, rows):
    df = spark.createDataFrame([(1, "b", 10), (1, "a", 11), (2, None, 12)], "k int, v string, id int")
    assert rows(dedupe.first_match(df, ["k"], ["v"])) == [(1, "a", 11), (2, None, 12)]


@pytest.mark.parametrize("merge", ["true", "false"])
def test_keys_do_not_depend_on_partitions(spark, merge):
    values = [(i // 7, f"v{i % 7}") for i in range(2000)] + [(None, None), (None, "v")]
    random.Random(3).shuffle(values)
    df = spark.createDataFrame(values, "a int, b string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        got = keys.assign_keys(df, ["a", "b"], "k")
        numbers = {(r.a, r.b): r.k for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted(values, key=lambda t: ((t[0] is not None, t[0]), (t[1] is not None, t[1])))
    assert numbers == {v: i + 1 for i, v in enumerate(ordered)}
    assert got.columns == ["k", "a", "b"]


def test_keys_of_nothing(spark):
    assert keys.assign_keys(spark.createDataFrame([], "a int"), ["a"], "k").count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_lookup_equals_plain_join(spark, rows, null_safe):
    data = [(1 if i % 3 == 0 else None if i % 3 == 1 else i, i) for i in range(20000)]
    left = spark.createDataFrame(data, "k int, v int")
    right = spark.createDataFrame([(i, f"r{i}") for i in range(0, 20000, 2)] + [(1, "hot"), (None, "n")], "id int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert set(hot_keys(left, ["k"])) == {(1,), (None,)}
        spread = left_lookup(left, right, {"k": "id"}, null_safe=null_safe, floor=0, salts=5)
        assert "_salt" in spread._jdf.queryExecution().executedPlan().toString()
        plain = left_lookup(left, right, {"k": "id"}, null_safe=null_safe, floor=1 << 70)
        assert "_salt" not in plain._jdf.queryExecution().executedPlan().toString()
        assert spread.columns == plain.columns == ["k", "v", "name"]
        assert rows(spread) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_lookup_on_two_columns_keeps_multiplicity(spark, rows):
    left = spark.createDataFrame([("x", None if i % 2 else 1, i) for i in range(3000)], "a string, b int, v int")
    right = spark.createDataFrame([("x", 1, "p"), ("x", 1, "q"), ("x", None, "n")], "ra string, rb int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for null_safe, expected in [(False, 4500), (True, 4500)]:
            got = left_lookup(left, right, {"a": "ra", "b": "rb"}, null_safe, floor=0, salts=3)
            assert got.count() == expected
            named = got.where("name = 'n'").count()
            assert named == (1500 if null_safe else 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("text, size", [("10485760b", 10485760), ("64m", 64 << 20), ("-1", -1), ("1g", 1 << 30), ("7", 7)])
def test_broadcast_limit(spark, text, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
    try:
        assert broadcast_limit(spark.range(1)) == size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_names(spark):
    assert reshape.clean_name(" order date (DateOrders) ") == "order_date_dateorders"
    assert reshape.clean_name("Days  for") == "days__for"
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    with pytest.raises(ValueError, match="a_b"):
        reshape.clean_names(df)


def test_splits(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `c d` int")
    assert [p.columns for p in reshape.split_tolerant(df, ["a", "x"], ["c d"])] == [["a"], ["c d"]]
    assert reshape.split_strict(df, ["c d"])[0].columns == ["c d"]
    with pytest.raises(ValueError, match="x"):
        reshape.split_strict(df, ["a", "x"])


def test_rename_if_present(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert reshape.rename_if_present(df, "a", "c").columns == ["c", "b"]
    assert reshape.rename_if_present(df, "a", "b").columns == ["a", "b"]
    assert reshape.rename_if_present(df, "x", "c").columns == ["a", "b"]


def test_lineage(spark):
    now = datetime(2024, 1, 2, 3, 4, 5)
    df = spark.range(1)
    assert tuple(reshape.with_load_lineage(df, "OMS", now).first()) == (0, now, "OMS")
    assert tuple(reshape.with_record_lineage(df, "src", now).first()) == (0, "2024-01-02 03:04:05", "src")
    long = reshape.with_record_lineage(df, "src", now, loaded_by="etl")
    assert long.columns == ["id", "source_system", "load_date", "loaded_by"]


def test_nameless_columns(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "a int, _c1 int, `Unnamed: 3` int, ` ` int")
    assert reshape.nameless_columns(df) == ["_c1", "Unnamed: 3", " "]


def test_link_services_does_not_multiply(spark, rows):
    sales = spark.createDataFrame([("1", 2.0), ("1", 3.0), ("2", 4.0)], "`Order Id` string, Sales double")
    logistics = spark.createDataFrame(
        [("1", "1", "2018-01-01"), ("1", "0", "2018-01-03")],
        "`Order Id` string, Late_delivery_risk string, `shipping date (DateOrders)` string",
    )
    got = rows(reshape.link_services(sales, logistics))
    assert got == [("1", 2, 5.0, 2, 1, "2018-01-03"), ("2", 1, 4.0, None, None, None)]


def test_conform(spark):
    layout = read_layout("id BIGINT, price DECIMAL(10,2), day DATE, system STRING, gone INT NOT NULL")
    df = spark.createDataFrame([("12.0", "1.005", "1/2/2018 0:00"), ("x", "y", "z")], "id string, price string, day string")
    got = conform(df, layout, {"system": "OMS"})
    assert [f.dataType for f in got.schema] == [f.dataType for f in layout]
    first, bad = got.collect()
    assert (first.id, str(first.price), str(first.day), first.system, first.gone) == (12, "1.01", "2018-01-02", "OMS", None)
    assert tuple(bad) == (None, None, None, "OMS", None)
    # A given NULL stays, though the column has a default.
    given = spark.createDataFrame([(None,)], "system string")
    assert conform(given, read_layout("system STRING"), {"system": "OMS"}).first().system is None


def test_union_all(spark):
    parts = [spark.range(i, i + 1).select((F.col("id")).alias("v")) for i in range(5)]
    assert sorted(r.v for r in union_all(parts).collect()) == list(range(5))


def test_digests_see_one_changed_cell(spark):
    from depotstar.operators.digest import column_digests

    rows = [(i, f"t{i % 5}", None if i % 7 == 0 else i * 0.25) for i in range(60)]
    layout = "a int, b string, c double"

    def digests(data):
        found = column_digests(spark.createDataFrame(data, layout)).collect()
        return {r.column_name: (r.rows_read, r.nulls, r.digest) for r in found}

    whole = digests(rows)
    assert whole["a"][:2] == (60, 0) and whole["c"][1] == 9
    assert digests(rows[30:] + rows[:30]) == whole
    for i, (column, value) in enumerate((("a", 99), ("b", "t9"), ("c", None), ("c", 1e6))):
        changed = list(rows[7 + i])
        changed["abc".index(column)] = value
        other = digests([*rows[:7 + i], tuple(changed), *rows[8 + i:]])
        assert {c for c in whole if other[c] != whole[c]} == {column}
    # A repeated row counts twice, and halves add up.
    assert digests([rows[1]] * 2)["b"][2] == str(2 * int(digests([rows[1]])["b"][2]))
    assert str(sum(int(digests(half)["a"][2]) for half in (rows[:9], rows[9:]))) == whole["a"][2]
    assert digests([])["a"] == (0, 0, "0")


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("negate", [False, True])
def test_sifted_is_matching(spark, rows, negate, null_safe):
    left = spark.range(2000).selectExpr("if(id % 50 = 0, null, id) AS k", "concat('v', id % 7) AS s", "id AS n")
    right = spark.createDataFrame([(3, "v3"), (3, "v3"), (4, "v9"), (None, "v1"), (51, None), (1999, "v4")], "a bigint, b string")
    for on in ({"k": "a"}, {"k": "a", "s": "b"}):
        want = rows(matching(left, right, on, negate, null_safe))
        assert rows(sifted(left, right, on, negate, null_safe)) == want
    # Unlike types are left to the join; no keys match nothing.
    texts = right.withColumn("a", F.concat(F.lit("0"), F.col("a").cast("string")))
    assert rows(sifted(left, texts, {"k": "a"}, negate, null_safe)) == rows(matching(left, texts, {"k": "a"}, negate, null_safe))
    none = right.limit(0)
    assert rows(sifted(left, none, {"k": "a"}, negate, null_safe)) == rows(matching(left, none, {"k": "a"}, negate, null_safe))


def test_filter_of_keys_passes_few(spark):
    left = spark.range(20000).withColumnRenamed("id", "k")
    right = spark.range(0, 20000, 100).withColumnRenamed("id", "a")
    assert may_match(left, right, {"k": "a"}, "m").where("m").count() < 220
    # A full filter lets more pass, but no key is lost and the filter stays as small.
    tight = may_match(left, right, {"k": "a"}, "m", words=2)
    assert tight.where("m AND k % 100 = 0").count() == 200


def test_digests_of_many_columns_need_no_more_code(spark):
    from depotstar.operators.digest import column_digests

    def aggregates(n):
        df = spark.createDataFrame([(1,)], "a int").selectExpr(*[f"a + {i} as c{i}" for i in range(n)])
        return column_digests(df)._jdf.queryExecution().optimizedPlan().toString().count("sum(")

    assert aggregates(2) == aggregates(30) > 0
    empty = column_digests(spark.createDataFrame([], "a int, b string")).collect()
    assert sorted(map(tuple, empty)) == [("a", 0, 0, "0"), ("b", 0, 0, "0")]
    # Sums of more than 64 bits; the hash of a text is the first 15 hex digits of its MD5.
    many = column_digests(spark.range(200).selectExpr("'x' as b", "cast(null as int) as a")).collect()
    one = int(md5(b"x").hexdigest()[:15], 16)
    assert sorted(map(tuple, many)) == [("a", 200, 200, "0"), ("b", 200, 0, str(200 * one))]
