"""Refresh all tables, from raw files to marts."""

import datetime as dt
from collections.abc import Callable, Mapping
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from stratalake.functions.lifecycle import add_lifecycle_fields
from stratalake.functions.numbers import unreadable_money
from stratalake.functions.text import tidy_key, unreadable_date
from stratalake.operators.backfill import group_lookup
from stratalake.operators.quality import (
    Check,
    enforce,
    expect_all,
    expect_not_empty,
    expect_unique,
    nulls,
    quality_report,
    rows,
    rows_where,
)
from stratalake.plans import gold, silver
from stratalake.plans.graph import Once, Step, run_steps
from stratalake.plans.mart_state import Marts, apply_changes
from stratalake.sources import schemas
from stratalake.sources.raw_csv import (
    LOST,
    LOST_TYPE,
    RECORD,
    lost_from,
    lost_something,
    new_batch_id,
    read_checked_csv,
    read_raw_csv,
    with_ingestion_metadata,
)
from stratalake.sources.scratch import passes, staged, with_brief_shuffles
from stratalake.sources.tables import Layout, counts_of_run, replace_table
from stratalake.streaming.ingest import ingest_new_files, ledger_of
from stratalake.streaming.upsert import upsert_stream

# The raw files and their schemas. Only the catalogue has no line breaks in its fields.
RAW_FILES = {
    "customers": ("customers.csv", schemas.CUSTOMERS, True),
    "devices": ("devices.csv", schemas.DEVICES, False),
    "service_jobs": ("service_jobs.csv", schemas.SERVICE_JOBS, True),
}
MARTS = ("repair_turnaround", "technician_performance", "repeat_customers", "device_failure_trends")
JOB_DATES = ("received_date", "promised_date", "completed_date")
JOB_AMOUNTS = ("estimated_cost", "actual_cost")


def load_bronze(
    spark: SparkSession,
    layout: Layout,
    name: str,
    batch_id: str,
    strict: bool = False,
    multi_line: Mapping[str, bool] | None = None,
) -> DataFrame:
    """``multi_line`` says by table name whether fields may hold line breaks; a big feed without can then be split.

    Text that a number column cannot hold, and records with the wrong number of columns, are kept in two columns of their own;
    ``strict`` refuses such files instead.
    """
    file_name, schema, by_default = RAW_FILES[name]
    path, lines = layout.raw_file(file_name), (multi_line or {}).get(name, by_default)
    if strict:
        nothing = {LOST: F.array().cast(LOST_TYPE), RECORD: F.lit(None).cast("string")}
        raw = read_raw_csv(spark, path, schema, lines, strict).withColumns(nothing)
    else:
        raw = read_checked_csv(spark, path, schema, lines)
    return with_ingestion_metadata(raw, batch_id=batch_id)


def loss_checks(name: str) -> list[Check]:
    """How many rows of a raw table lost the text of each column but text, and how many had the wrong number of columns."""
    fields = StructType.fromDDL(RAW_FILES[name][1]).fields
    typed = [f.name for f in fields if not isinstance(f.dataType, StringType)]
    lost = [rows_where(f"lost_{c}", lost_from(c)) for c in typed]
    return [*lost, rows_where("wrong_column_count", F.col(RECORD).isNotNull())]


def quarantine(bronze: DataFrame) -> DataFrame:
    """The rows of a raw table that lost something, with the text that was lost, to be mended by whoever sent it."""
    return bronze.filter(lost_something())


def customer_checks() -> list[Check]:
    return [rows(), expect_unique("customer_id"), nulls("email"), nulls("registration_date")]


def device_checks() -> list[Check]:
    return [rows(), expect_unique("device_id"), rows_where("unknown_price_range", ~F.col("price_range_known"))]


def technician_checks() -> list[Check]:
    return [rows(), expect_unique("technician_id"), rows_where("several_names", F.col("value_count") > 1)]


def issue_type_checks() -> list[Check]:
    return [rows(), expect_unique("issue_type")]


def raw_job_checks(strict: bool = False) -> list[Check]:
    """A ``strict`` read has lost nothing, and no columns that say so."""
    unreadable = [rows_where(f"unreadable_{c}", unreadable_date(c)) for c in JOB_DATES]
    unreadable += [rows_where(f"unreadable_{c}", unreadable_money(c)) for c in JOB_AMOUNTS]
    unnamed = rows_where("unnamed_technician", tidy_key("technician_id").isNotNull() & tidy_key("technician_name").isNull())
    losses = [] if strict else loss_checks("service_jobs")
    return [expect_not_empty(), rows_where("no_job_id", tidy_key("job_id").isNull()), unnamed, *unreadable, *losses]


def job_checks() -> list[Check]:
    return [
        rows(),
        expect_unique("job_id"),
        expect_all("turnaround_not_negative", F.col("turnaround_days") >= 0),
        nulls("technician_name"),
        rows_where("orphan_customer", ~F.col("has_valid_customer")),
        rows_where("orphan_device", ~F.col("has_valid_device")),
    ]


@dataclass
class Refresh:
    """What a run did: the counts of every table's checks, and of the rows that were left out on the way."""

    batch_id: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


class _Publisher:
    """Stores, checks and publishes the tables of a run. ``resume`` leaves out what the same run has published already."""

    def __init__(self, spark: SparkSession, layout: Layout, run: Refresh, resume: bool = False) -> None:
        self.spark, self.layout, self.run, self.resume = spark, layout, run, resume

    def __call__(self, table: str, df: DataFrame, checks: list[Check]) -> None:
        self.run.counts[table] = replace_table(df, self.layout, table, checks, self.run.batch_id)

    def step(self, table: str, make: Callable[[], DataFrame], checks: list[Check], *needs: str) -> dict[str, Step]:
        """The step that makes a table from the published tables ``needs``."""
        return {table: Step(lambda: self(table, make(), checks), needs, lambda: self._recall(table))}

    def _recall(self, table: str) -> bool:
        counts = counts_of_run(self.spark, table, self.run.batch_id) if self.resume else None
        if counts is None:
            return False
        self.run.counts[table] = counts
        return True

    def bronze_steps(self, name: str, load: Callable[[], DataFrame], checks: list[Check]) -> dict[str, Step]:
        """A raw table, and beside it the rows of it that lost something."""
        table, beside = self.layout.bronze(name), self.layout.bronze(f"{name}_quarantine")
        return self.step(table, load, checks) | self.step(beside, lambda: quarantine(self.spark.table(table)), [rows()], table)

    def left_out(self, silver_table: str, bronze_table: str, no_key: str) -> None:
        """Versions and rows without a key that did not reach the silver table."""
        bronze, kept = self.run.counts[bronze_table], self.run.counts[silver_table]
        seen = {"received": bronze["not_empty"], "no_key": bronze[no_key]}
        kept |= seen | {"superseded": seen["received"] - seen["no_key"] - kept["rows"]}


def _dimensions() -> tuple[tuple[str, str, Callable[[DataFrame], DataFrame], list[Check]], ...]:
    return (
        ("customers", "customer_id", silver.silver_customers, customer_checks()),
        ("devices", "device_id", silver.silver_devices, device_checks()),
    )


def _dimension_steps(publish: _Publisher, load: Callable[[str], DataFrame]) -> dict[str, Step]:
    steps: dict[str, Step] = {}
    for name, key, make, checks in _dimensions():
        bronze = publish.layout.bronze(name)
        raw_checks = [expect_not_empty(), rows_where("no_key", tidy_key(key).isNull()), *loss_checks(name)]
        steps |= publish.bronze_steps(name, lambda name=name: load(name), raw_checks)
        steps |= publish.step(publish.layout.silver(name), lambda b=bronze, make=make: make(publish.spark.table(b)), checks, bronze)
    return steps


def _dimensions_left_out(publish: _Publisher) -> None:
    for name, *_ in _dimensions():
        publish.left_out(publish.layout.silver(name), publish.layout.bronze(name), "no_key")


def _job_steps(
    publish: _Publisher, load: Callable[[str], DataFrame], as_of: "dt.date | str | None", kept: ExitStack
) -> dict[str, Step]:
    """``kept`` holds what is stored on the way; a step closes it once nothing reads that any more."""
    spark, layout = publish.spark, publish.layout
    bronze, jobs, technicians = layout.bronze("service_jobs"), layout.silver("service_jobs"), layout.silver("technicians")
    customers, devices = layout.silver("customers"), layout.silver("devices")

    def newest() -> list[DataFrame]:
        """The current versions, by a hash of the id if one shuffle would be too big."""
        raw, number = spark.table(bronze), passes(publish.run.counts[bronze]["not_empty"])
        part = F.pmod(F.xxhash64(tidy_key("job_id")), F.lit(number))
        return [silver.latest_jobs(raw.filter(part == i)) for i in range(number)] if number > 1 else [silver.latest_jobs(raw)]

    # Stored, as the names and the jobs both come from it.
    latest = Once(lambda: kept.enter_context(staged(newest(), "latest_jobs")))

    def made_jobs() -> DataFrame:
        return silver.silver_jobs(latest(), spark.table(customers), spark.table(devices), as_of, spark.table(technicians))

    def lookup() -> DataFrame:
        return group_lookup(latest(), "technician_id", "technician_name")

    steps = publish.bronze_steps("service_jobs", lambda: load("service_jobs"), raw_job_checks())
    without_id = layout.silver("service_jobs_without_id")
    steps |= publish.step(without_id, lambda: silver.keyless_jobs(spark.table(bronze)), [rows()], bronze)
    steps |= publish.step(technicians, lookup, technician_checks(), bronze)
    issues = layout.silver("issue_types")
    steps |= publish.step(issues, lambda: silver.issue_types(latest()), issue_type_checks(), bronze)
    steps |= publish.step(jobs, made_jobs, job_checks(), bronze, customers, devices, technicians)
    steps["latest_jobs"] = Step(kept.close, (technicians, issues, jobs))
    marts = (
        lambda: gold.repair_turnaround(spark.table(jobs), spark.table(devices)),
        lambda: gold.technician_performance(spark.table(jobs)),
        lambda: gold.repeat_customers(spark.table(jobs), spark.table(customers)),
        lambda: gold.device_failures(spark.table(jobs), spark.table(devices)),
    )
    # The mart that shuffles most comes after the others, so that not all their files lie side by side.
    first = {"repeat_customers": (layout.gold("repair_turnaround"), layout.gold("device_failure_trends"))}
    for name, mart in zip(MARTS, marts, strict=True):
        steps |= publish.step(layout.gold(name), mart, [rows()], jobs, *first.get(name, ()))
    return steps


@with_brief_shuffles
def refresh_dimensions(
    spark: SparkSession,
    layout: Layout,
    batch_id: str | None = None,
    strict: bool = False,
    multi_line: Mapping[str, bool] | None = None,
    resume: bool = False,
    side_by_side: int = 4,
) -> Refresh:
    """Refresh bronze and silver customers and devices; the arguments are those of :func:`run_pipeline`."""
    layout.ensure_schema(spark)
    run = Refresh(batch_id or new_batch_id())
    publish = _Publisher(spark, layout, run, resume)
    load = partial(load_bronze, spark, layout, batch_id=run.batch_id, strict=strict, multi_line=multi_line)
    run_steps(spark, _dimension_steps(publish, load), side_by_side)
    _dimensions_left_out(publish)
    return run


@with_brief_shuffles
def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    as_of: "dt.date | str | None" = None,
    batch_id: str | None = None,
    strict: bool = False,
    multi_line: Mapping[str, bool] | None = None,
    resume: bool = False,
    side_by_side: int = 4,
) -> Refresh:
    """Refresh bronze, silver and gold: each table after those that it is made from, up to ``side_by_side`` at a time.

    Every table is written once, checked, and only then published; the next step reads the published table. Of the versions of
    a job in the load, the newest wins (:func:`silver.newest_job_first`). Jobs without an id go to a table of their own.

    After a failure, a call with the same ``batch_id`` and ``resume`` leaves out the tables that this batch has already published.
    """
    layout.ensure_schema(spark)
    run = Refresh(batch_id or new_batch_id())
    publish = _Publisher(spark, layout, run, resume)
    load = partial(load_bronze, spark, layout, batch_id=run.batch_id, strict=strict, multi_line=multi_line)
    with ExitStack() as kept:
        run_steps(spark, _dimension_steps(publish, load) | _job_steps(publish, load, as_of, kept), side_by_side)
    _dimensions_left_out(publish)
    publish.left_out(layout.silver("service_jobs"), layout.bronze("service_jobs"), "no_job_id")
    return run


@with_brief_shuffles
def run_incremental(
    spark: SparkSession,
    layout: Layout,
    landing: str,
    checkpoints: str,
    as_of: "dt.date | str | None" = None,
    strict: bool = False,
    multi_line: Mapping[str, bool] | None = None,
    silver_jobs: bool = False,
    buckets: int = 64,
) -> Refresh:
    """Take in the job files that are new in the folder ``landing``, and refresh the marts, at the cost of what the files change.

    New files are checked, then appended to the bronze files of the layout's storage. Their jobs are upserted into the table
    ``silver_service_jobs_latest``: a later delivery wins, within one the newest version. What that changes is added to the stored sums of
    :mod:`mart_state`, from which the marts and the counts follow as in a full run; no unchanged job is read. Customers and
    devices are the published ones (:func:`refresh_dimensions`). Two streams with own checkpoints below ``checkpoints`` remember what is
    done; either can be lost.

    The columns of silver jobs depend on the day and on other tables, so each run would have to write them all: ``silver_jobs``
    asks for that. :func:`current_jobs` gives the same rows without storing them. Jobs and sums are stored in ``buckets``
    (:class:`Buckets`), of which a run reads and writes those that it changes.
    """
    layout.ensure_schema(spark)
    run = Refresh(new_batch_id())
    publish = _Publisher(spark, layout, run)
    _, schema, by_default = RAW_FILES["service_jobs"]
    bronze_path = layout.version_path(layout.bronze("service_jobs_incremental"), "files")
    lines = (multi_line or {}).get("service_jobs", by_default)
    ingest_new_files(spark, landing, schema, bronze_path, f"{checkpoints}/bronze", lines, strict, checks=raw_job_checks(strict))
    run.counts[layout.bronze("service_jobs_incremental")] = ledger_of(spark, bronze_path).totals()

    bronze = spark.read.parquet(bronze_path)
    changes = silver.standardise_jobs(spark.readStream.schema(bronze.schema).parquet(bronze_path))
    changes = changes.filter(F.col("job_id").isNotNull()).drop("_batch_id")
    table = layout.silver("service_jobs_latest")

    def change_marts(old: DataFrame, new: DataFrame, batch: str) -> None:
        in_order = expect_all("turnaround_not_negative", F.col("turnaround_days") >= 0)
        enforce(quality_report(add_lifecycle_fields(new, as_of), [expect_unique("job_id"), in_order]))
        apply_changes(spark, layout, old, new, batch, buckets)

    tie_breakers = silver.newest_job_first(changes.columns)
    upsert_stream(
        changes,
        layout,
        table,
        ["job_id"],
        "_ingest_ts",
        f"{checkpoints}/silver",
        tie_breakers,
        buckets=buckets,
        on_change=change_marts,
    )

    customers, devices = spark.table(layout.silver("customers")), spark.table(layout.silver("devices"))
    marts = Marts(spark, layout, customers, devices, as_of)
    technicians = layout.silver("technicians")
    steps = publish.step(technicians, marts.technicians, technician_checks())
    steps |= publish.step(layout.silver("issue_types"), marts.issue_types, issue_type_checks())
    made = (
        (marts.repair_turnaround,),
        (lambda: marts.technician_performance(spark.table(technicians)), technicians),
        (marts.repeat_customers,),
        (marts.device_failures,),
    )
    for name, (mart, *needs) in zip(MARTS, made, strict=True):
        steps |= publish.step(layout.gold(name), mart, [rows()], *needs)
    jobs_table = layout.silver("service_jobs")
    if silver_jobs:
        steps |= publish.step(jobs_table, lambda: current_jobs(spark, layout, as_of), job_checks(), technicians)
    run_steps(spark, steps)

    run.counts[jobs_table] = run.counts.get(jobs_table, {}) | marts.counts(spark.table(technicians))
    publish.left_out(jobs_table, layout.bronze("service_jobs_incremental"), "no_job_id")
    return run


def current_jobs(spark: SparkSession, layout: Layout, as_of: "dt.date | str | None" = None) -> DataFrame:
    """Silver jobs as of a day, from what :func:`run_incremental` has stored."""
    latest, customers, devices, technicians = (
        spark.table(layout.silver(t)) for t in ("service_jobs_latest", "customers", "devices", "technicians")
    )
    return silver.silver_jobs(latest, customers, devices, as_of, technicians)
