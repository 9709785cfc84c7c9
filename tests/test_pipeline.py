from dataclasses import replace

import pytest

from stratalake.operators.quality import DataQualityError
from stratalake.plans import gold, pipeline
from stratalake.plans.pipeline import run_incremental, run_pipeline
from stratalake.sources.tables import Layout
from tests.helpers import d, plan, rows

CUSTOMERS = """customer_id,customer_name,phone_number,email,city,registration_date
 C1 ,Kiran , 98,K@X.COM,new delhi,2022-08-12
C2,Maya,99,,pune,soon
   ,nobody,,,,
"""
DEVICES = """device_id,brand,device_type,model_series,warranty_months,price_range
D1,Acme,TV,M1,12,Budget (< 15K)
D2,Acme,TV,M2,24,Premium (> 40K)
"""
JOBS = """job_id,customer_id,device_id,issue_type,job_status,received_date,promised_date,completed_date,technician_id,technician_name,repair_notes,estimated_cost,actual_cost
J1,C1,D1,Screen,COMPLETED,2024-01-01,2024-01-05,2024-01-08,T1,Asha,"said ""ok"",
twice",10.5,12.25
J1,C1,D1,Screen,COMPLETED,2024-01-01,2024-01-05,2024-01-08,T1,Asha,"said ""ok"",
twice",10.5,12.25
J2, C1,D2,Screen,in progress,2024-01-11,2024-01-12,,T1 ,,,5,
J3,C9,D1,Fan,Completed,2024-01-03,2024-01-09,2024-01-04,T2,,,5,7
J4,C2,D9,Fan,Cancelled,n/a,2024-01-09,,,,,5,
  ,C2,D9,Fan,Cancelled,,,,,,,1e30,
"""


@pytest.fixture
def site(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "customers.csv").write_text(CUSTOMERS)
    (raw / "devices.csv").write_text(DEVICES)
    (raw / "service_jobs.csv").write_text(JOBS)
    return raw, Layout(f"p_{tmp_path.name}", str(raw), f"{tmp_path}/tables")


def state(spark, layout):
    names = {
        layout.silver: ("customers", "devices", "service_jobs", "technicians", "issue_types"),
        layout.gold: ("repair_turnaround", "technician_performance", "repeat_customers", "device_failure_trends"),
    }
    result = {}
    for layer, tables in names.items():
        for name in tables:
            df = spark.table(layer(name))
            result[layer(name)] = rows(df.select([c for c in df.columns if not c.startswith("_")]))
    return result


def test_raw_files_to_marts(spark, site):
    _, layout = site
    run = run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B1")
    assert spark.table(layout.bronze("service_jobs")).count() == 6

    assert rows(spark.table(layout.silver("customers")), "customer_id", "email", "city", "registration_date") == [
        ("C1", "k@x.com", "New Delhi", d("2022-08-12")),
        ("C2", None, "Pune", None),
    ]
    jobs = spark.table(layout.silver("service_jobs"))
    assert rows(
        jobs, "job_id", "customer_id", "job_status", "technician_name", "is_overdue", "has_valid_customer", "has_valid_device"
    ) == [
        ("J1", "C1", "Completed", "Asha", True, True, True),
        ("J2", "C1", "In Progress", "Asha", True, True, True),
        ("J3", "C9", "Completed", None, False, False, True),
        ("J4", "C2", "Cancelled", None, False, True, False),
    ]
    assert jobs.filter("job_id = 'J1'").first().repair_notes == 'said "ok",\ntwice'
    assert {"_ingest_ts", "_source_file", "_batch_id", "_silver_updated_ts"} <= set(jobs.columns)

    assert run.counts[layout.silver("service_jobs")] == {
        "rows": 4,
        "received": 6,
        "no_key": 1,
        "superseded": 1,
        "unique_job_id": 0,
        "turnaround_not_negative": 0,
        "null_technician_name": 2,
        "orphan_customer": 1,
        "orphan_device": 1,
    }
    bronze = run.counts[layout.bronze("service_jobs")]
    assert (bronze["not_empty"], bronze["unnamed_technician"], bronze["unreadable_received_date"]) == (6, 2, 1)
    assert run.counts[layout.silver("technicians")] == {"rows": 1, "unique_technician_id": 0, "several_names": 0}
    # Every valid job is in the marts that it belongs to.
    gold = layout.gold
    assert spark.table(gold("technician_performance")).selectExpr("sum(total_jobs_assigned)").first()[0] == 3
    assert spark.table(gold("repeat_customers")).selectExpr("sum(total_visits)").first()[0] == 3
    assert spark.table(gold("device_failure_trends")).selectExpr("sum(failure_count)").first()[0] == 3
    assert spark.table(gold("repair_turnaround")).selectExpr("sum(completed_jobs)").first()[0] == 2

    # A second run gives the same tables.
    before = state(spark, layout)
    run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B2")
    assert state(spark, layout) == before


def test_bad_deliveries_do_not_replace_good_tables(spark, site):
    raw, layout = site
    run_pipeline(spark, layout, as_of="2024-02-01")
    before = state(spark, layout)

    (raw / "service_jobs.csv").write_text(JOBS.splitlines()[0] + "\n")
    with pytest.raises(DataQualityError, match="not_empty = 0"):
        run_pipeline(spark, layout, as_of="2024-02-01")
    assert spark.table(layout.bronze("service_jobs")).count() == 6

    (raw / "service_jobs.csv").write_text(JOBS.replace("2024-01-04", "2024-01-02"))
    with pytest.raises(DataQualityError, match="turnaround_not_negative = 1"):
        run_pipeline(spark, layout, as_of="2024-02-01")
    assert state(spark, layout) == before


def test_rows_that_lose_something_are_kept_and_counted(spark, site):
    raw, layout = site
    (raw / "devices.csv").write_text(DEVICES + "D3,Acme,TV,M3,a year,Budget\n")
    (raw / "service_jobs.csv").write_text(JOBS + "J8,C1,D1,Fan,Pending,,,,,,,ask,7\nJ9,C1,D1,Fan,Pending,,,,,,,1,2,3\n")
    run = run_pipeline(spark, layout, as_of="2024-02-01")
    jobs = run.counts[layout.bronze("service_jobs")]
    assert (jobs["lost_estimated_cost"], jobs["lost_actual_cost"], jobs["wrong_column_count"]) == (1, 0, 1)
    assert run.counts[layout.bronze("devices")] == {
        "not_empty": 3,
        "no_key": 0,
        "lost_warranty_months": 1,
        "wrong_column_count": 0,
    }
    kept = spark.table(layout.bronze("service_jobs_quarantine"))
    assert rows(kept.selectExpr("job_id", "get(_lost, 0).column", "get(_lost, 0).text", "_raw_record")) == [
        ("J8", "estimated_cost", "ask", None),
        ("J9", None, None, "J9,C1,D1,Fan,Pending,,,,,,,1,2,3"),
    ]
    assert run.counts[layout.bronze("customers_quarantine")] == {"rows": 0}
    # The rest of such a row goes on.
    silver = spark.table(layout.silver("service_jobs"))
    assert rows(silver.filter("job_id in ('J8', 'J9')"), "job_id", "estimated_cost", "actual_cost") == [("J8", None, 7), ("J9", 1, 2)]
    assert not {"_lost", "_raw_record"} & {*silver.columns, *spark.table(layout.silver("devices")).columns}


def test_strict_loads_refuse_malformed_rows(spark, site):
    raw, layout = site
    (raw / "devices.csv").write_text(DEVICES + "D3,Acme,TV,M3,a year,Budget\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        run_pipeline(spark, layout, as_of="2024-02-01", strict=True)


def test_the_newest_state_of_a_load_wins(spark, site):
    raw, layout = site
    (raw / "service_jobs.csv").write_text(
        JOBS
        + "J2,C1,D2,Screen,Completed,2024-01-11,2024-01-12,2024-01-12,T1,,,5,6\n"
        + "J5,C1,D2,Screen,Pending,2024-01-11,2024-01-12,,T1,,,5,\nJ5,C1,D2,Screen,In Progress,2024-01-11,2024-01-12,,T1,,,4,\n"
    )
    run_pipeline(spark, layout, as_of="2024-02-01")
    jobs = spark.table(layout.silver("service_jobs")).filter("job_id in ('J2', 'J5')")
    assert rows(jobs, "job_id", "job_status", "completed_date") == [("J2", "Completed", d("2024-01-12")), ("J5", "In Progress", None)]


def test_large_amounts_reach_the_marts_and_lost_ones_are_counted(spark, site):
    raw, layout = site
    (raw / "service_jobs.csv").write_text(JOBS.replace("12.25", "123456789012.5"))
    run = run_pipeline(spark, layout, as_of="2024-02-01")
    revenue = spark.table(layout.gold("technician_performance")).filter("technician_id = 'T1'").first()
    assert revenue.total_revenue_generated == 123456789012.5
    counts = run.counts[layout.bronze("service_jobs")]
    assert (counts["unreadable_estimated_cost"], counts["unreadable_actual_cost"], counts["no_job_id"]) == (1, 0, 1)
    assert spark.table(layout.silver("service_jobs_without_id")).count() == 1


def test_incremental_runs_equal_one_full_run(spark, site, tmp_path):
    raw, layout = site
    lines = JOBS.replace('"said ""ok"",\ntwice"', "said ok").splitlines()
    (raw / "service_jobs.csv").write_text("\n".join(lines) + "\n")
    run_pipeline(spark, layout, as_of="2024-02-01")
    full = state(spark, layout)
    landing = tmp_path / "landing"
    landing.mkdir()
    for name, part in (("a", lines[1:3]), ("b", lines[3:])):
        (landing / f"{name}.csv").write_text("\n".join([lines[0], *part]) + "\n")
        run = run_incremental(spark, layout, str(landing), f"{tmp_path}/checkpoints", as_of="2024-02-01", silver_jobs=True)
    assert state(spark, layout) == full
    counts = run.counts[layout.silver("service_jobs")]
    assert (counts["rows"], counts["received"], counts["superseded"]) == (4, 6, 1)
    # Lost checkpoints change nothing.
    run_incremental(spark, layout, str(landing), f"{tmp_path}/new_checkpoints", as_of="2024-02-01", silver_jobs=True)
    assert state(spark, layout) == full


def test_a_run_can_be_resumed(spark, site, monkeypatch):
    _, layout = site
    real = pipeline.replace_table

    def fail_at_gold(df, at, table, *args):
        if table == layout.gold("repeat_customers"):
            raise RuntimeError("lost")
        return real(df, at, table, *args)

    monkeypatch.setattr(pipeline, "replace_table", fail_at_gold)
    with pytest.raises(RuntimeError, match="lost"):
        run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B1")
    made = []
    monkeypatch.setattr(pipeline, "replace_table", lambda df, at, table, *args: made.append(table) or real(df, at, table, *args))
    resumed = run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B1", resume=True)
    assert layout.gold("repeat_customers") in made and layout.silver("service_jobs") not in made and layout.bronze("customers") not in made
    # Counts of what was left out are those of the first attempt.
    found = state(spark, layout)
    whole = run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B2")
    assert resumed.counts == whole.counts and state(spark, layout) == found
    # Another batch has nothing to resume.
    made.clear()
    run_pipeline(spark, layout, as_of="2024-02-01", batch_id="B3", resume=True)
    assert layout.bronze("customers") in made


def test_partitioned_tables_are_pruned(spark, site):
    raw, layout = site
    layout = replace(layout, partition_by={"gold_repair_turnaround": ("completion_month",)})
    run_pipeline(spark, layout, as_of="2024-02-01", multi_line={"service_jobs": True})
    mart = spark.table(layout.gold("repair_turnaround")).filter("completion_month = date'2024-01-01'")
    assert "PartitionFilters: [isnotnull(completion_month" in plan(mart) and mart.count() == 2


def test_the_turnaround_mart_joins_sums(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    jobs = spark.range(1000).selectExpr(
        "true as is_completed", "date'2024-01-01' as completed_date", "'x' as issue_type", "cast(id % 3 as string) as device_id",
        "cast(id % 9 as int) as turnaround_days", "false as is_overdue", "cast(1 as decimal(20,2)) as actual_cost",
    )
    devices = spark.range(3).selectExpr("cast(id as string) as device_id", "'TV' as device_type")
    steps = plan(gold.repair_turnaround(jobs, devices)).split("\n\n")[0]
    # Bottom up: the jobs are added up, in their tasks and then by shuffle, before the join.
    assert steps.rindex("HashAggregate") > steps.index("SortMergeJoin")
