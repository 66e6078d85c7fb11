"""Profiles, cleansing, checks, summaries."""

import random
import statistics
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotstar.operators import checks, cleanse, profile, summary

LAYOUT = (
    "`Order Id` string, `Customer Id` string, `Product Name` string, Sales string, "
    "`Customer Email` string, `Customer Fname` string, `order date (DateOrders)` string, "
    "`Unnamed: 3` string, nothing string"
)


@pytest.fixture(scope="module")
def dirty(spark):
    data = [
        ("1", "7", " Ball ", " 1.5 ", "XXXXXXXXX", "\tAna ", "1/31/2018 22:56", None, None),
        ("1", "7", " Ball ", " 1.5 ", "XXXXXXXXX", "\tAna ", "1/31/2018 22:56", None, None),
        ("1", "7", "Ball", "1.5", None, "Ana", "1/31/2018 22:56", None, None),
        (None, None, None, "x", "a@b", None, "31/12/2018 1:00", None, None),
        ("3", "8", "nan", "-2", "c@d", "Bo", None, None, None),
    ]
    return spark.createDataFrame(data, LAYOUT)


def test_cleansing_steps(dirty):
    now = datetime(2024, 1, 1, 12)
    got = cleanse.cleanse(dirty, cleanse.default_steps(now))
    assert "Unnamed: 3" not in got.columns and "nothing" not in got.columns
    assert got.columns[-3:] == ["data_quality_score", "cleansing_timestamp", "record_source"]
    out = sorted(got.collect(), key=lambda r: (str(r["Order Id"]), str(r["Customer Email"])))
    # Duplicates go before trimming, so the trimmed copy of the first row remains.
    assert len(out) == 4
    assert out[0]["Product Name"] == out[1]["Product Name"] == "Ball"
    assert out[0]["Sales"] == 1.5 and out[0]["Customer Email"] is None and out[0]["Customer Fname"] == "Ana"
    assert out[0]["order date (DateOrders)"] == datetime(2018, 1, 31, 22, 56)
    assert out[2]["Sales"] == -2.0 and out[2]["Product Name"] == "nan"
    assert out[3]["data_quality_score"] == 0 and out[3]["order date (DateOrders)"] is None
    assert out[0]["cleansing_timestamp"] == "2024-01-01 12:00:00"


def test_cleansing_options(spark, dirty):
    assert cleanse.cleanse(dirty, cleanse.default_steps(dedupe_after_trim=True)).count() == 3
    masked = spark.createDataFrame([("1", "XXXXXXXXX")], "`Order Id` string, `Customer Password` string")
    kept = cleanse.cleanse(masked, cleanse.default_steps())
    assert "Customer Password" in kept.columns
    late = cleanse.cleanse(masked, cleanse.default_steps(drop_empty_last=True))
    assert "Customer Password" not in late.columns


def test_own_step(dirty):
    steps = [*cleanse.default_steps(), lambda df: df.where("Sales > 0")]
    assert cleanse.cleanse(dirty, steps).count() == 2


def test_score_ignores_absent_columns(spark):
    df = spark.createDataFrame([(None,)], "`Order Id` string")
    assert df.select(cleanse.quality_score(df)).first()[0] == 75
    assert spark.range(1).select(cleanse.quality_score(spark.range(1))).first()[0] == 100


def test_cleansing_reports(dirty):
    cleaned = cleanse.cleanse(dirty, cleanse.default_steps())
    assert cleanse.negative_counts(cleaned).first().asDict() == {"Sales": 1}
    assert cleanse.invalid_dates(cleaned).first()[0] == 2
    scores = [(r.data_quality_score, r.n) for r in cleanse.score_distribution(cleaned).collect()]
    assert scores == [(100, 3), (0, 1)]
    summary_row = cleanse.score_summary(cleaned).first()
    assert (summary_row.mean_score, summary_row.perfect_records, summary_row.perfect_pct) == (75.0, 3, 75.0)


def test_checks_find_what_is_wrong(spark, dirty):
    cleaned = cleanse.cleanse(dirty, cleanse.default_steps(datetime(2024, 1, 1)))
    found = {r.check_name: r for r in checks.run_checks(cleaned, checks.standard_checks(cleaned)).collect()}
    failed = {n for n, r in found.items() if not r.passed}
    assert failed == {
        "Critical Field 'Order Id'", "Critical Field 'Customer Id'", "Critical Field 'Product Name'",
        "Critical Field 'Sales'", "Non-negative 'Sales'", "Data Quality Score",
        "Duplicates",
    } - ({"Duplicates"} if found["Duplicates"].passed else set())
    assert found["Non-negative 'Sales'"].severity == "warning" and found["Non-negative 'Sales'"].observed == 1
    assert found["Data Quality Score"].observed == 75.0
    assert found["Masked 'Customer Email'"].passed

    raw = dirty.select("Customer Email", "nothing", "Sales")
    bad = {r.check_name: r for r in checks.run_checks(raw, checks.standard_checks(raw)).collect()}
    assert not bad["Masked 'Customer Email'"].passed and bad["Masked 'Customer Email'"].observed == 2
    assert not bad["Empty Columns"].passed and not bad["Duplicates"].passed


def test_verdict(spark):
    good = spark.createDataFrame([("1", 1.0)], "`Order Id` string, Sales double")
    own = checks.Check("Big", F.max("Sales"), "observed > 5", warning=True, fail="small")
    results = checks.run_checks(good, [*checks.standard_checks(good), own])
    assert results.where("check_name = 'Big'").first().message == "small"
    row = checks.verdict(results).first()
    assert (row.failed, row.warnings, row.ready) == (0, 1, True)
    empty = good.limit(0)
    assert not checks.verdict(checks.run_checks(empty, checks.standard_checks(empty))).first().ready


def test_missing_profile(dirty):
    got = [tuple(r) for r in profile.missing_profile(dirty).collect()]
    assert got[:2] == [("Unnamed: 3", 5, 100.0), ("nothing", 5, 100.0)]
    assert ("Customer Email", 1, 20.0) in got and all(m for _, m, _ in got)
    assert profile.missing_cells(dirty).first()[0] == sum(m for _, m, _ in got)
    assert tuple(profile.shape(dirty).first()) == (5, 9)
    assert profile.type_census(dirty) == {"string": 9}


@pytest.mark.parametrize("merge", ["true", "false"])
def test_exact_quantiles(spark, merge):
    rng = random.Random(5)
    a = [rng.choice([0.0, 1.0, rng.uniform(-9, 9)]) for _ in range(4000)]
    b = [None if i % 4 else rng.gauss(0, 1) for i in range(4000)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        got = {(r.column_name, r.point): r.quantile for r in profile.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.77, 1.0]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name, values in [("a", a), ("b", [v for v in b if v is not None])]:
        for p in (0.0, 0.25, 0.5, 0.77, 1.0):
            assert got[name, p] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_describe(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", None), (2, float("nan"), "b", None), (4, 4.0, "b", None), (None, None, "a", None)],
        "i int, d double, s string, n string",
    )
    rows_ = {r.column_name: r for r in profile.describe_numeric(df).collect()}
    assert rows_["i"].n == 3 and rows_["d"].n == 2
    assert rows_["i"]["std"] == pytest.approx(statistics.stdev([1, 2, 4]))
    assert (rows_["i"].q25, rows_["i"].q50, rows_["i"].q75) == (1.5, 2.0, 3.0)
    assert (rows_["d"]["min"], rows_["d"]["max"], rows_["d"]["mean"]) == (1.0, 4.0, 2.5)
    sketch = {r.column_name: r for r in profile.describe_numeric(df, ["i"], approximate=True).collect()}
    assert sketch["i"].q50 == 2.0
    texts = {r.column_name: r for r in profile.describe_categorical(df).collect()}
    # Equal counts: the smaller value.
    assert (texts["s"].n, texts["s"].distinct_values, texts["s"].top, texts["s"].freq) == (4, 2, "a", 2)
    assert "n" not in texts


def test_impute(spark, rows):
    df = spark.createDataFrame(
        [(1, Decimal("1.00"), "b", None), (2, None, "a", None), (None, Decimal("2.00"), None, None), (4, Decimal("9.00"), "a", None)],
        "i int, m decimal(5,2), s string, none string",
    )
    got = profile.impute(df, ["i", "m"], ["s", "none"])
    assert got.where("m = 2.00").count() == 2 and got.where("s = 'a'").count() == 3
    assert sorted(r.i for r in got.collect()) == [1.0, 2.0, 2.0, 4.0]
    assert got.where("none IS NOT NULL").count() == 0


def test_summaries_follow_the_group_rules(spark, rows):
    df = spark.createDataFrame(
        [("a", 5.0, 1.0, "x", 1), ("a", 5.0, None, "x", 0), ("b", 10.0, 2.0, None, 1), (None, 99.0, 0.0, "y", 1), ("c", None, None, "x", None)],
        "`Product Name` string, Sales double, `Benefit per order` double, `Delivery Status` string, Late_delivery_risk int",
    )
    assert [tuple(r) for r in summary.ranked_sums(df, "Product Name").collect()] == [("a", 10.0), ("b", 10.0), ("c", 0.0)]
    assert [r[0] for r in summary.top_groups(df, k=2).collect()] == ["a", "b"]
    t = summary.totals(df).first()
    assert (t.total_revenue, t.mean_line_sales, t.total_profit) == (119.0, 29.75, 3.0)
    assert [tuple(r) for r in summary.status_share(df).collect()] == [("x", 3, 75.0), ("y", 1, 25.0)]
    assert summary.late_rate(df).first()[0] == 75.0
    assert summary.top_contribution(df, k=1).first().share_pct == 8.4
    plan = summary.top_groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_measures_of_a_write(spark):
    from depotstar.operators.cleanse import Cleaner, measured

    df = spark.createDataFrame([("a", None, 1), (" ", "NA", None), ("", "x", 3)], "a string, b string, c int")
    written, seen = measured(df.repartition(3), lambda d: d.collect())
    assert len(written) == 3 and (seen.rows, seen.missing) == (3, {"a": 1, "b": 2, "c": 1}) and seen.empty == []
    _, none = measured(df.limit(0), lambda d: d.collect())
    assert (none.rows, none.empty) == (0, ["a", "b", "c"])
    # Cleansing a frame reads it once: each row passes a counter one time.
    seen = spark.sparkContext.accumulator(0)
    from pyspark.sql import functions as F

    def count(x):
        seen.add(1)
        return x

    raw = spark.range(50).select(F.udf(count, "long")("id").cast("string").alias("Order Id"), F.lit(None).cast("string").alias("Empty"))
    kept, report = Cleaner.of(raw).write(lambda d: d.collect())
    row = report.first()
    assert seen.value == 50 and len(kept) == 50
    assert (row.total_rows_original, row.total_rows_cleaned, row.duplicates_removed, row.columns_dropped) == (50, 50, 0, "Empty")


def test_checks_of_a_write_are_those_of_the_frame(spark, rows):
    from depotstar.operators import checks

    df = spark.createDataFrame(
        [("1", None, 5.0, 100), (None, "x", -1.0, 75), ("1", None, 5.0, 100)],
        "`Order Id` string, `Customer Id` string, Sales double, data_quality_score int",
    )
    wanted = checks.standard_checks(df)
    written, found = checks.checked_write(df, wanted, lambda d: spark.createDataFrame(d.collect(), df.schema))
    assert rows(found) == rows(checks.run_checks(df, wanted)) and written.count() == 3
    _, alone = checks.checked_write(df, wanted, lambda d: spark.createDataFrame(d.collect(), df.schema), duplicates=False)
    assert alone.count() == len(wanted)


def test_profiles_of_parts(spark, tmp_path):
    from pyspark.sql import functions as F

    from depotstar.operators import profile, sketches

    df = spark.range(20_000).selectExpr(
        "id % 4 as part", "cast(pmod(hash(id), 1000) as double) as v",
        "if(id % 9 = 0, null, cast(pmod(hash(id, 1), 300) as string)) as t", "cast(null as double) as nothing",
        "if(id % 3 = 0, 'often', cast(id as string)) as skewed",
    )
    kept = sketches.Profile(spark, str(tmp_path / "p"))
    reads = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda x: reads.add(1) or x, "double")
    for n in (0, 1, 2, 3, 2, 0):
        part = df.where(F.col("part") == n).drop("part")
        kept.add(part.withColumn("v", tick("v")), f"part-{n}")
    # A row is read once for the numbers and once for the texts, and not again for a part sent twice.
    assert reads.value <= 2 * 20_000
    exact = profile.describe_numeric(df.select("v", "nothing")).where("n > 0").first()
    got = sketches.describe_numeric(kept.numeric()).collect()
    assert [r.column_name for r in got] == ["v"]
    assert (got[0].n, got[0].min, got[0].max) == (exact.n, exact.min, exact.max)
    assert abs(got[0].mean - exact["mean"]) < 1e-9 and abs(got[0]["std"] - exact["std"]) < 1e-6
    for q in ("q25", "q50", "q75"):
        assert abs(got[0][q] - exact[q]) <= 10  # a hundredth of the ranks
    texts = {r.column_name: r for r in sketches.describe_categorical(kept.text()).collect()}
    right = {r.column_name: r for r in profile.describe_categorical(df.select("t", "skewed")).collect()}
    assert texts["skewed"].top == right["skewed"].top == "often" and texts["skewed"].freq == right["skewed"].freq
    for c in ("t", "skewed"):
        assert texts[c].n == right[c].n and abs(texts[c].distinct_values / right[c].distinct_values - 1) < 0.05
    both = sketches.overlap(kept.text(["part-0"]), kept.text(["part-1"])).where("column_name = 't'").first().common
    assert abs(both - 300) < 30
    assert kept.fills()["skewed"] == "often" and abs(kept.fills()["v"] - exact.q50) <= 10


def test_merged_states_of_one_part_are_that_part(spark):
    from depotstar.operators import sketches

    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "a")], "v double, t string")
    one, merged = sketches.numeric_state(df), sketches.merge_numeric(sketches.numeric_state(df))
    a, b = (sketches.describe_numeric(x).first().asDict() for x in (one, merged))
    assert abs(a.pop("std") - b.pop("std")) < 1e-12 and a == b
    state = sketches.text_state(df)
    assert tuple(sketches.describe_categorical(state).first()) == ("t", 3, 2, "a", 2)
    assert sketches.describe_numeric(sketches.numeric_state(df.limit(0))).count() == 0
