import pytest
from pyspark.sql import functions as F

from stratalake.operators.profile import profile
from stratalake.operators.references import flag_reference, orphans
from stratalake.operators.sketches import estimates, merge, merged_profile, profile_sketch, sketch, unit_sketches, units_affected
from stratalake.sources.scratch import stage
from stratalake.sources.tables import Layout, drop_old_versions, replace_table, versions
from tests.helpers import d, executed_plan, plan, rows


def test_sketches_of_days_merge_to_that_of_a_month(spark):
    events = spark.range(200_000).selectExpr("id % 30 as day", "id % 4 as kind", "id % 20011 as device", "if(id % 3 = 0, null, id % 7) as few")
    by_day = stage(sketch(events, ["day", "kind"], {"device": "device", "few": "few"}), "by_day")
    merged = estimates(merge(by_day, ["kind"], ["device", "few"]), ["device", "few"])
    exact = events.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("device"), F.count_distinct("few"))
    for found, wanted in zip(rows(merged), rows(exact), strict=True):
        assert found[:2] == wanted[:2] and found[3] == wanted[3] == 7
        assert abs(found[2] - wanted[2]) / wanted[2] < 0.05
    # The days' own counts do not add up.
    assert estimates(by_day, ["device"]).agg(F.sum("device")).first()[0] > 100_000
    # Merging in two steps is the same.
    twice = merge(merge(by_day, ["day"], ["device"]), [], ["device"])
    assert rows(estimates(twice, ["device"])) == rows(estimates(merge(by_day, [], ["device"]), ["device"]))


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "day int, device string")
    assert rows(estimates(sketch(empty, ["day"], {"device": "device"}), ["device"])) == []
    nulls = spark.createDataFrame([(1, None)], "day int, device string")
    assert rows(estimates(sketch(nulls, ["day"], {"device": "device"}), ["device"])) == [(1, 1, 0)]


def test_units_of_any_days(spark):
    jobs = spark.createDataFrame(
        [(d("2024-01-01"), "D1", "Fan"), (d("2024-01-02"), "D1", "Fan"), (d("2024-01-02"), "D2", "Fan"), (d("2024-03-01"), "D3", "Fan"),
         (d("2024-01-05"), "gone", "Fan"), (None, "D3", "Fan")],
        "received_date date, device_id string, issue_type string",
    )
    devices = spark.createDataFrame(
        [(f"D{i}", "Acme", "TV", 12, "Budget") for i in (1, 2, 3)],
        "device_id string, brand string, device_type string, warranty_months int, price_tier string",
    )
    stored = stage(unit_sketches(jobs, devices), "units")
    assert rows(units_affected(stored, ["brand"])) == [("Acme", 5, 3)]
    assert rows(units_affected(stored, ["issue_type"], ("2024-01-01", "2024-01-31"))) == [("Fan", 3, 2)]


def test_profiles_of_loads_merge(spark):
    one = spark.createDataFrame([("a", 1, 9), ("a", 1, 8), ("b", None, 7)], "k string, v int, _load int")
    two = spark.createDataFrame([("a", 1, 6), (None, None, 5)], "k string, v int, _load int")
    merged = merged_profile(stage(profile_sketch(one).unionByName(profile_sketch(two)), "states"))
    assert rows(merged) == rows(profile(one.unionByName(two)))
    empty = one.limit(0)
    assert rows(merged_profile(profile_sketch(empty))) == rows(profile(empty))


@pytest.fixture
def bucketed(spark, tmp_path, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    buckets = {"silver_facts": (8, ("k",)), "silver_things": (8, ("k",))}
    layout = Layout(f"bk_{tmp_path.name}", "", f"{tmp_path}/tables", bucket_by=buckets)
    layout.ensure_schema(spark)
    facts = spark.range(5000).selectExpr("cast(if(id % 3 = 0, 7, id % 200) as string) as k", "id as n")
    things = spark.range(150).selectExpr("cast(id as string) as k", "'x' as name")
    counts = replace_table(facts, layout, layout.silver("facts"))
    replace_table(things, layout, layout.silver("things"))
    assert counts == {}
    return layout, facts, things


def exchanges(df):
    final = executed_plan(df).split("\n\n")[0].split("== Initial Plan ==")[0]
    return final.count("Exchange")


def test_bucketed_tables_join_without_a_shuffle(spark, bucketed):
    layout, facts, things = bucketed
    joined = spark.table(layout.silver("facts")).join(spark.table(layout.silver("things")), "k", "left")
    assert exchanges(joined) == 0 and "SortMergeJoin" in plan(joined)
    assert rows(joined) == rows(facts.join(things, "k", "left"))
    assert exchanges(facts.join(things, "k", "left")) > 0


def test_references_of_bucketed_facts_shuffle_only_the_keys(spark, bucketed):
    layout, facts, things = bucketed
    stored, dimension = spark.table(layout.silver("facts")), spark.table(layout.silver("things"))
    missing = orphans(stored, dimension, "k")
    assert exchanges(missing) == 0 and rows(missing) == rows(orphans(facts, things, "k"))
    flagged = flag_reference(stored, dimension, "k", "known")
    assert rows(flagged) == rows(flag_reference(facts, things, "k", "known"))
    # Only the distinct keys travel.
    assert exchanges(flagged) == 1


def test_versions_of_bucketed_tables(spark, bucketed):
    layout, facts, _ = bucketed
    table = layout.silver("facts")
    for n in (10, 20):
        replace_table(facts.limit(n), layout, table)
    assert spark.table(table).count() == 20 and len(versions(spark, layout, table)) == 3
    assert len(drop_old_versions(spark, layout, table, keep=1)) == 2
    assert spark.table(table).count() == 20
    names = [t.name for t in spark.catalog.listTables(layout.schema) if t.name.startswith("silver_facts__")]
    assert len(names) == 1
