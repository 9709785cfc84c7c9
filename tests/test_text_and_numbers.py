import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.functions.numbers import count_true, money, percent, rounded_ratio, unreadable_money
from stratalake.functions.text import iso_date, tidy, tidy_key, title_case, unreadable_date


def one(spark, value, column, type_="string"):
    return spark.createDataFrame([(value,)], f"x {type_}").select(column).first()[0]


@pytest.mark.parametrize("raw, key, text", [(" A1 ", "A1", "A1"), ("   ", None, ""), (None, None, None)])
def test_blank_keys_are_null_but_blank_text_is_empty(spark, raw, key, text):
    assert one(spark, raw, tidy_key("x")) == key
    assert one(spark, raw, tidy("x")) == text


def test_title_case_covers_every_word(spark):
    assert one(spark, "  IN pROGRESS ", title_case("x")) == "In Progress"


@pytest.mark.parametrize(
    "raw, expected, bad",
    [
        ("2024-01-05", dt.date(2024, 1, 5), False),
        (" 2024-01-05 ", dt.date(2024, 1, 5), False),
        ("2024-1-5", None, True),
        ("2024-02-30", None, True),
        ("2024-01-5T", None, True),
        ("02024-1-05", None, True),
        ("n/a", None, True),
        ("  ", None, False),
        (None, None, False),
    ],
)
def test_dates_in_iso_form_only_and_never_an_error(spark, raw, expected, bad):
    assert one(spark, raw, iso_date("x")) == expected
    assert one(spark, raw, unreadable_date("x")) is bad


@pytest.mark.parametrize(
    "raw, expected",
    [(10.1, Decimal("10.10")), (1.005, Decimal("1.01")), (float("nan"), None), (123456789012.5, Decimal("123456789012.50")), (1e15, Decimal("1e15")), (1e19, None), (float("inf"), None), (None, None)],
)
def test_money_is_exact_and_unfit_numbers_are_null_and_counted(spark, raw, expected):
    assert one(spark, raw, money("x"), "double") == expected
    assert one(spark, raw, unreadable_money("x"), "double") == (raw is not None and expected is None)


@pytest.mark.parametrize(
    "top, bottom, digits, expected",
    [(201, 200, 2, 1.01), (-201, 200, 2, -1.01), (1, 3, 2, 0.33), (1, 8, 2, 0.13), (5, 0, 2, None), (29, 20, 1, 1.5)],
)
def test_ratios_round_half_away_from_zero(spark, top, bottom, digits, expected):
    df = spark.createDataFrame([(top, bottom)], "a bigint, b bigint")
    assert df.select(rounded_ratio(F.col("a"), F.col("b"), digits)).first()[0] == expected


def test_percent_of_flags_leaves_nulls_out(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "flag boolean")
    assert df.agg(percent(count_true(F.col("flag")), F.count("flag"))).first()[0] == 33.33
    nothing = df.filter("flag is null")
    assert nothing.agg(count_true(F.col("flag"))).first()[0] is None
