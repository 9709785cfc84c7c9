import random

from stratalake.operators.visits import visit_gaps
from tests.helpers import d, plan, rows

SCHEMA = "job_id string, customer_id string, received_date date"


def brute_force(data):
    """Previous visit by sorting each customer's visits."""
    result = []
    for customer in {c for _, c, _ in data}:
        visits = sorted((v for v in data if v[1] == customer), key=lambda v: (v[2] is not None, v[2] or d("2024-01-01"), v[0]))
        previous = None
        for job, _, day in visits:
            if customer is None:
                previous = None  # visits of nobody
            gap = (day - previous).days if day and previous else None
            result.append((job, customer, day, previous, gap))
            previous = day
    return sorted(result, key=repr)


def test_gaps_equal_the_sorted_visits(spark):
    rng = random.Random(3)
    days = [d("2024-01-01"), d("2024-01-04"), d("2024-02-01"), d("2024-03-01"), None]
    data = [(f"J{i:03d}", rng.choice(["A", "A", "A", "B", None]), rng.choice(days)) for i in range(120)]
    data.append(("J999", "once", days[0]))
    assert rows(visit_gaps(spark.createDataFrame(data, SCHEMA))) == brute_force(data)


def test_the_window_runs_over_days(spark):
    df = spark.range(1000).selectExpr(
        "concat('J', id) as job_id", "'hot' as customer_id", "date'2024-01-01' + cast(id % 30 as int) as received_date"
    )
    steps = plan(visit_gaps(df)).split("\n\n")[0]
    # Below the window: an aggregate to one row per day.
    assert steps.index("Window") < steps.index("Aggregate")
    assert rows(visit_gaps(df).groupBy("days_since_prev_visit").count()) == [(0, 970), (1, 29), (None, 1)]
