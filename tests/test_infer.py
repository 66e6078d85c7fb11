"""Types of text columns."""

import random

import pytest

from depotstar.operators import dedupe, profile
from depotstar.operators.cleanse import Cleaner
from depotstar.sources import csv, infer

COLUMNS = {
    "string": [None, None],
    "boolean": ["True", "FALSE", None, " true "],
    "bigint": ["1", "-7", " +12", None, "0009"],
    "decimal(20,0)": ["99999999999999999999", "1"],
    "decimal(4,2)": ["1.5", "-20", ".25", "007.10"],
    "decimal(1,0)": ["0.", "0"],
    "double": ["1e3", "2", "inf", "-1.5"],
    "date": ["2020-01-31", None, "1999-12-01"],
    "timestamp": ["1/31/2018 22:56", "2/1/2018 5:06"],
}
TEXTS = [
    ["1", "x"], ["2020-01-31", "1/31/2018"], ["2020-02-30"], ["31/12/2018 1:00"], ["true", "1"], ["1d"], ["0x1"],
    ["1,5"], ["1e"], ["--1"], ["."], ["1 2"], ["", "1"],
]


def types(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return infer.resolve(infer.type_states(df))["c"]


@pytest.mark.parametrize("kind", COLUMNS)
def test_types(spark, kind):
    assert types(spark, COLUMNS[kind]).type == kind


def test_texts_stay_texts(spark):
    wide = [[v[i] if i < len(v) else None for v in TEXTS] for i in range(2)]
    df = spark.createDataFrame([tuple(r) for r in wide], ", ".join(f"c{i} string" for i in range(len(TEXTS))))
    assert {t.type for t in infer.resolve(infer.type_states(df)).values()} == {"string"}


def test_digits_beyond_any_decimal(spark):
    assert types(spark, ["1" * 39]).type == "double"
    assert types(spark, ["1" * 30, "0." + "1" * 20]).type == "double"


def test_own_formats(spark):
    df = spark.createDataFrame([("31.12.2018",), ("01.02.2019",)], "c string")
    found = infer.infer_types(df, ("dd.MM.yyyy",))
    assert found.dtypes == [("c", "date")] and str(found.first().c) == "2018-12-31"


def test_states_of_parts_merge_to_those_of_the_whole(spark, rows):
    r = random.Random(4)
    values = ["1", "2.50", "1e3", "true", "x", "2020-01-31", "1/31/2018 22:56", None, "-12345.678", "00"]
    names = [f"c`{i}.'" for i in range(6)]
    data = [tuple(r.choice(values[i:i + 5]) for i in range(6)) for _ in range(60)]
    df = spark.createDataFrame(data, infer.T.StructType([infer.T.StructField(n, infer.T.StringType()) for n in names]))
    parts = None
    for k in range(3):
        part = spark.createDataFrame(data[k * 20:k * 20 + 20], df.schema)
        state = infer.type_states(part)
        parts = state if parts is None else parts.union(state)
    assert rows(infer.merge_states(parts)) == rows(infer.type_states(df))
    assert infer.resolve(infer.merge_states(parts)) == infer.resolve(infer.type_states(df))


def test_empty_frames(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert infer.infer_types(df).dtypes == [("a", "string"), ("b", "string")]


def test_values(spark):
    df = spark.createDataFrame(
        [(" +1", "1.50", "1e2", "TRUE", "2020-01-31", "1/2/2020 3:04", " kept "), (None,) * 7],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    found = infer.infer_types(df)
    assert [t for _, t in found.dtypes] == ["bigint", "decimal(3,2)", "double", "boolean", "date", "timestamp", "string"]
    assert str(tuple(found.first())) == (
        "(1, Decimal('1.50'), 100.0, True, datetime.date(2020, 1, 31), "
        "datetime.datetime(2020, 1, 2, 3, 4), ' kept ')"
    )
    assert tuple(found.tail(1)[0]) == (None,) * 7


def test_csv_by_value(spark, tmp_path):
    """One bad row of a thousand decides a type, and equal values are duplicates however written."""
    path = f"{tmp_path}/in.csv"
    lines = ["Order Id,Sales,Code,Nothing"] + [f"{i},{i}.0,{i},NA" for i in range(1000)]
    with open(path, "w") as f:
        f.write("\n".join([*lines, "7, 7.00 ,7,", "8,8.0,eight,None"]) + "\n")
    df = infer.read_typed(spark, path)
    assert df.dtypes == [("Order Id", "bigint"), ("Sales", "decimal(5,2)"), ("Code", "string"), ("Nothing", "string")]
    assert profile.type_census(df) == {"bigint": 1, "decimal(5,2)": 1, "string": 2}
    assert dedupe.row_census(df).first().duplicate_rows == 1
    assert dedupe.row_census(csv.read_flat(spark, path)).first().duplicate_rows == 0
    by_value = Cleaner(spark, path, typed=True).run(f"{tmp_path}/a").first()
    by_text = Cleaner(spark, path).run(f"{tmp_path}/b").first()
    assert (by_value.duplicates_removed, by_text.duplicates_removed) == (1, 0)


def test_typed_dates_are_cleaned_as_they_are(spark, tmp_path):
    path = f"{tmp_path}/in.csv"
    with open(path, "w") as f:
        f.write("Order Id,order date (DateOrders)\n1,1/31/2018 22:56\n2,\n")
    cleaner = Cleaner(spark, path, typed=True)
    cleaner.run(f"{tmp_path}/out")
    got = cleaner.df.orderBy("Order Id").collect()
    assert str(got[0]["order date (DateOrders)"]) == "2018-01-31 22:56:00" and got[1]["order date (DateOrders)"] is None
