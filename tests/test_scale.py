"""Work per task, and bytes on the way, that must not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from cases import fixture, spark_queries
from stratalake.operators.dedupe import dedupe_exact_rows, row_hash
from stratalake.operators.profile import profile
from stratalake.operators.sketches import profile_sketch
from stratalake.sources.buckets import Buckets
from stratalake.sources.tables import Layout
from stratalake.streaming import upsert
from tests.helpers import plan, rows

SF = "/root/testdata/sf0.001"


def test_jobs_are_dealt_to_as_many_tasks_as_their_size_needs(spark, monkeypatch):
    whole = rows(fixture.raw_jobs(spark, SF))
    monkeypatch.setattr(fixture, "BYTES_A_TASK", 4096)
    jobs = fixture.raw_jobs(spark, SF)
    assert jobs.rdd.getNumPartitions() > 20
    assert rows(jobs) == whole


@pytest.mark.parametrize("make", [fixture.raw_customers, fixture.raw_devices])
def test_dimensions_are_dealt_to_as_many_tasks_as_their_size_needs(spark, monkeypatch, make):
    whole = rows(make(spark, SF))
    monkeypatch.setattr(fixture, "DIMENSION_BYTES_A_TASK", 512, raising=False)
    dealt = make(spark, SF)
    assert dealt.rdd.getNumPartitions() > 4
    assert rows(dealt) == whole


def test_two_loads_are_derived_once(spark):
    found = spark_queries.dedupe_exact_metadata(spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("lineitem") <= 1
    jobs = fixture.raw_jobs(spark, SF)
    file = F.when(F.col("estimated_cost") > 30000, "b.csv").otherwise("a.csv")
    loads = [jobs.withColumns({"_source_file": F.lit("a.csv"), "_batch_id": F.lit("2")}), jobs.withColumns({"_source_file": file, "_batch_id": F.lit("1")})]
    assert rows(found) == rows(dedupe_exact_rows(loads[0].unionByName(loads[1])))


SCHEMA = "k string, ts int, v string"


@pytest.mark.parametrize("many", [1, 10**9])
@pytest.mark.parametrize("tie_breakers", [None, ["v"]])
def test_many_changes_do_what_few_do(spark, tmp_path, monkeypatch, many, tie_breakers):
    monkeypatch.setattr(upsert, "MANY_CHANGES", many)
    monkeypatch.setattr(upsert, "UNEVEN", 100)
    layout, landing, seen = Layout(f"m_{tmp_path.name}", "", f"{tmp_path}/tables"), f"{tmp_path}/landing", []
    layout.ensure_schema(spark)
    table = layout.silver("things")

    def run(*data):
        spark.createDataFrame(list(data), SCHEMA).write.mode("append").parquet(landing)
        changes = spark.readStream.schema(SCHEMA).parquet(landing)
        see = lambda old, new, batch: seen.append((rows(old), rows(new)))
        upsert.upsert_stream(
            changes, layout, table, ["k"], "ts", f"{tmp_path}/checkpoint", tie_breakers, buckets=4, on_change=see
        )
        return rows(spark.table(table))

    first = [("a", 1, "a1"), ("b", 5, "b5"), ("c", 5, "c5"), (None, 1, "n1")]
    assert run(*first, ("a", 0, "a0")) == sorted(first, key=repr)
    assert seen.pop() == ([], sorted(first, key=repr))
    after = [("a", 7, "z"), ("b", 5, "b5"), ("c", 5, "c5"), ("d", 1, "d1"), (None, 2, "n2")]
    assert run(("a", 7, "y"), ("a", 7, "z"), ("b", 4, "old"), ("d", 1, "d1"), (None, 2, "n2")) == sorted(after, key=repr)
    assert seen.pop() == (
        sorted([first[0], first[1], first[3]], key=repr), sorted([after[0], after[1], after[3], after[4]], key=repr)
    )
    assert spark.table(table).columns == ["k", "ts", "v"] and run() == sorted(after, key=repr)


def test_many_changes_and_their_snapshot_meet_in_one_shuffle(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    dealt = Buckets(Layout("m", "", "/nowhere"), "things", ("k",), 4)
    current = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 2, "y")], SCHEMA)
    changes = spark.createDataFrame([("b", 1, "old")], SCHEMA)
    swept = upsert._swept(dealt, current, changes, 5, "ts", None)
    assert plan(swept).split("\n\n")[0].count("Exchange") == 1
    # Untouched keys keep their repeated rows.
    kept = swept.filter("__position = 1 or not __touched")
    assert rows(kept, "k", "ts", "v") == [("a", 1, "x"), ("a", 2, "y"), ("b", 2, "y")]


def test_a_row_is_told_by_which_column_holds_a_value(spark):
    data = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("ab", "c"), ("a", "bc"), (None, None), ("a", None)]
    df = spark.createDataFrame(data, "x string, y string")
    hashed = [r[0] for r in df.select(row_hash([F.col("x"), F.col("y")])).collect()]
    assert len(set(hashed)) == 7 and {len(h) for h in hashed} == {32}
    assert {r["duplicate_rows"] for r in profile(df).collect()} == {1}


def test_rows_are_told_apart_without_text_of_the_whole_row(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert "to_json" not in plan(profile(df)) and "to_json" not in plan(profile_sketch(df))
