import pytest

from stratalake.functions.lifecycle import add_lifecycle_fields
from stratalake.functions.pricing import price_bounds, price_range_known, price_tier
from tests.helpers import d

SCHEMA = "job_status string, received_date date, promised_date date, completed_date date"
RECEIVED, PROMISED, EARLY, LATE = "2023-02-25", "2023-03-06", "2023-03-02", "2023-03-11"


def fields(spark, status, completed, promised=PROMISED, as_of="2023-03-20"):
    df = spark.createDataFrame([(status, d(RECEIVED), d(promised), d(completed))], SCHEMA)
    r = add_lifecycle_fields(df, as_of).first()
    return r.is_completed, r.is_cancelled, r.turnaround_days, r.is_overdue, r.sla_breach_days


@pytest.mark.parametrize(
    "status, completed, expected",
    [
        ("Completed", EARLY, (True, False, 5, False, 0)),
        ("Completed", PROMISED, (True, False, 9, False, 0)),
        ("Completed", LATE, (True, False, 14, True, 5)),
        # An open job has no turnaround and no counted breach, however late it is.
        ("In Progress", None, (False, False, None, True, 0)),
        ("Completed", None, (True, False, None, True, 0)),
        ("Cancelled", None, (False, True, None, False, 0)),
        # A cancelled job with a completion date is judged by that date.
        ("Cancelled", LATE, (False, True, 14, True, 5)),
        (None, None, (None, None, None, False, 0)),
        (None, LATE, (None, None, 14, True, 5)),
    ],
)
def test_fields_of_a_job(spark, status, completed, expected):
    assert fields(spark, status, completed) == expected


def test_without_a_promise_nothing_is_known_to_be_late(spark):
    assert fields(spark, "Completed", LATE, promised=None) == (True, False, 14, None, 0)
    assert fields(spark, "Pending", None, promised=None) == (False, False, None, None, 0)


def test_open_jobs_are_measured_against_the_given_day(spark):
    assert fields(spark, "Pending", None, as_of="2023-03-06")[3] is False
    assert fields(spark, "Pending", None, as_of=d("2024-01-06"))[3] is True
    # Without a day it is today.
    assert fields(spark, "Pending", None, as_of=None)[3] is True
    assert fields(spark, "Pending", None, promised="9999-01-01", as_of=None)[3] is False


@pytest.mark.parametrize(
    "label, bounds, tier, known",
    [
        ("Budget (< 15K)", (0, 15000), "Budget", True),
        ("Mid-range (15K-40K)", (15000, 40000), "Mid-range", True),
        ("Premium (> 40K)", (40000, None), "Premium", True),
        ("Luxury", (15000, 40000), "Luxury", False),
        (" Budget", (0, 15000), "", True),
        ("(none)", (15000, 40000), "", False),
        (None, (15000, 40000), None, False),
    ],
)
def test_price_labels(spark, label, bounds, tier, known):
    df = spark.createDataFrame([(label,)], "price_range string")
    lowest, highest = price_bounds("price_range")
    row = df.select(lowest, highest, price_tier("price_range"), price_range_known("price_range")).first()
    assert tuple(row) == (*bounds, tier, known)
