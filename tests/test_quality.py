import pytest
from pyspark.sql import functions as F

from stratalake.operators.profile import profile
from stratalake.operators.quality import (
    Counting,
    DataQualityError,
    enforce,
    expect_all,
    expect_not_empty,
    expect_unique,
    fail_if_broken,
    nulls,
    quality_report,
    rows as count_rows,
    rows_where,
)
from tests.helpers import plan, rows


@pytest.fixture
def checks(spark):
    return [
        count_rows(),
        expect_not_empty(),
        expect_unique("k"),
        expect_all("positive", F.col("v") > 0),
        nulls("v"),
        rows_where("big", F.col("v") > 5),
    ]



def test_report_of_good_and_bad_data(spark, checks):
    good = spark.createDataFrame([("a", 1), (None, 9), ("b", None)], "k string, v int")
    assert enforce(quality_report(good, checks)) == {
        "rows": 3,
        "not_empty": 3,
        "unique_k": 0,
        "positive": 0,
        "null_v": 1,
        "big": 1,
    }
    bad = spark.createDataFrame([("a", 1), ("a", -2), (None, 3), (None, 3)], "k string, v int")
    with pytest.raises(DataQualityError, match="unique_k = 2; positive = 1"):
        enforce(quality_report(bad, checks))


def test_empty_data_fails_only_where_rows_are_expected(spark, checks):
    empty = spark.createDataFrame([], "k string, v int")
    report = {r.check_name: r.passed for r in quality_report(empty, checks).collect()}
    assert [name for name, passed in report.items() if not passed] == ["not_empty"]


def test_counts_in_passing_equal_those_of_a_query(spark, checks, tmp_path):
    data = [("a", 1), ("a", -2), (None, 3), (None, 9), ("b", None)]
    for i, df in enumerate((spark.createDataFrame(data, "k string, v int"), spark.createDataFrame([], "k string, v int"))):
        counting = Counting(df.repartition(3), checks)
        counting.frame.write.parquet(f"{tmp_path}/{i}")
        stored = spark.read.schema("k string, v int").parquet(f"{tmp_path}/{i}")
        counts = counting.counts(stored)
        assert list(counts) == [c.name for c in checks]
        report = quality_report(stored, checks).collect()
        assert counts == {r.check_name: r.observed for r in report}
        assert [c.holds(counts[c.name]) for c in checks] == [r.passed for r in report]
        with pytest.raises(DataQualityError):
            fail_if_broken(checks, counts)


def test_one_scan_for_all_checks(spark, checks):
    df = spark.range(10).selectExpr("cast(id as string) as k", "cast(id as int) as v")
    assert plan(quality_report(df, checks)).split("\n\n")[0].count("Range") == 1


def test_profile_counts_nulls_values_and_copies(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 1, 11), ("a", 1, 12), ("b", None, 13), (None, None, 14)], "k string, v int, _load int"
    )
    columns = ("column_name", "row_count", "null_count", "distinct_count", "duplicate_rows")
    assert rows(profile(df), *columns) == [("k", 5, 1, 2, 2), ("v", 5, 2, 1, 2)]


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, v int, _load int")
    for approximate in (False, True):
        assert rows(profile(df, approximate=approximate)) == [("k", 0, 0, 0, 0), ("v", 0, 0, 0, 0)]


def test_profile_tells_null_from_empty_and_estimates_on_request(spark):
    df = spark.createDataFrame([("", None), (None, ""), ("", None), ("a", "b")], "k string, v string")
    wanted = [("k", 4, 1, 2, 1), ("v", 4, 2, 2, 1)]
    assert rows(profile(df)) == wanted == rows(profile(df, approximate=True))
