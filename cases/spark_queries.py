"""One query per operator, over the whole derived tables of :mod:`cases.fixture`."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cases import fixture
from stratalake.functions.lifecycle import add_lifecycle_fields
from stratalake.functions.pricing import price_bounds, price_range_known
from stratalake.operators.backfill import group_lookup
from stratalake.operators.dedupe import dedupe_exact_rows, keep_latest_per_key
from stratalake.operators.profile import profile
from stratalake.operators.quality import quality_report
from stratalake.operators.references import flag_reference, orphans
from stratalake.operators.sketches import merged_profile, profile_sketch, unit_sketches, units_affected
from stratalake.operators.visits import visit_gaps
from stratalake.plans import gold, silver
from stratalake.plans.mart_state import STATES, TURNAROUND, signed, turnaround_quantiles as stored_quantiles
from stratalake.plans.pipeline import (
    MARTS,
    RAW_FILES,
    current_jobs,
    customer_checks,
    device_checks,
    job_checks,
    quarantine,
    raw_job_checks,
    refresh_dimensions,
    run_incremental,
    run_pipeline,
)
from stratalake.sources import schemas
from stratalake.sources.raw_csv import LOST, RECORD, read_checked_csv, read_raw_csv, with_ingestion_metadata
from stratalake.sources.scratch import brief_shuffles, scratch_folder, stage
from stratalake.sources.tables import Layout, replace_table
from stratalake.streaming.ingest import ingest_new_files
from stratalake.streaming.upsert import upsert_latest as upsert_changes, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

JOB_COLUMNS = [c for c in fixture.JOBS if not c.startswith("_")]
CUSTOMER_COLUMNS = [c for c in fixture.CUSTOMERS if not c.startswith("_")]
DEVICE_COLUMNS = [c for c in fixture.DEVICES if not c.startswith("_")]
TRACKING = ["job_id", "job_status", "received_date", "promised_date", "completed_date"]
LIFECYCLE = ["is_completed", "is_cancelled", "turnaround_days", "is_overdue", "sla_breach_days"]
BATCH_ID = "20240101000000"


# --- inputs shared by the queries ---


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver customers as a stored table, so that joins know its size."""
    return stage(silver.silver_customers(fixture.raw_customers(spark, sf_dir)), "customers")


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(silver.silver_devices(fixture.raw_devices(spark, sf_dir)), "devices")


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.latest_jobs(fixture.raw_jobs(spark, sf_dir), fixture.JOB_TIE_BREAKERS)


def _tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_lifecycle_fields(_latest(spark, sf_dir), fixture.AS_OF)


def _named(latest: DataFrame) -> DataFrame:
    """Names filled from the given jobs, which are stored as they are read twice."""
    return silver.backfill_technician_names(stage(latest, "latest_jobs"))


def _silver_jobs(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Silver jobs with only the given columns stored on the way."""
    latest = stage(_latest(spark, sf_dir).select(columns), "latest_jobs")
    return silver.silver_jobs(latest, _customers(spark, sf_dir), _devices(spark, sf_dir), fixture.AS_OF)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write text as it is: padded values stay padded, quotes are doubled, no file grows without bound.

    Files are compressed, as a feed is that waits to be read: plain text would be most of the disk that a run takes. One task reads a file either way.
    """
    options = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxRecordsPerFile": 2_000_000,
        "compression": "gzip",
        "zlib.compress.level": "BEST_SPEED",
    }
    with brief_shuffles(df.sparkSession):
        df.write.options(**options).mode(mode).csv(path)


def _faulty_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job files without a header in which some records have text for an amount, a column too many, or too few."""
    columns = [F.col(c).cast("string").alias(c) for c in JOB_COLUMNS]
    jobs = fixture.raw_jobs(spark, sf_dir).select(F.expr(fixture.FAULT).alias("fault"), *columns)
    jobs = jobs.withColumns(
        {
            "estimated_cost": F.when(F.col("fault") == 0, "on request").otherwise(F.col("estimated_cost")),
            "actual_cost": F.when(F.col("fault") == 1, "12,50 EUR").otherwise(F.col("actual_cost")),
        }
    )
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole = F.to_csv(F.struct(*JOB_COLUMNS), options)
    short = F.to_csv(F.struct(*JOB_COLUMNS[: fixture.FEW_COLUMNS]), options)
    lines = F.when(F.col("fault") == 2, F.concat(whole, F.lit(",extra"))).when(F.col("fault") == 3, short).otherwise(whole)
    folder = scratch_folder(spark, "faulty_jobs")
    jobs.select(lines.alias("value")).write.text(folder)
    return stage(read_checked_csv(spark, folder, schemas.SERVICE_JOBS, header=False), "checked_jobs")


def _raw_folder(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """A folder with the raw files of the given tables."""
    folder = scratch_folder(spark, "raw")
    makers = {
        "customers": (fixture.raw_customers, CUSTOMER_COLUMNS),
        "devices": (fixture.raw_devices, DEVICE_COLUMNS),
        "service_jobs": (fixture.raw_jobs, JOB_COLUMNS),
    }
    for name in names:
        make, columns = makers[name]
        write_csv(make(spark, sf_dir).select(columns), f"{folder}/{RAW_FILES[name][0]}")
    return folder


def _layout(spark: SparkSession, raw_path: str = "") -> Layout:
    storage = scratch_folder(spark, "tables")
    return Layout(schema=f"stratalake_{storage[-12:]}", raw_path=raw_path, storage=storage)


def _forget(spark: SparkSession, layout: Layout, *tables: str) -> None:
    """Take the names out of the catalog again. Frames that were resolved before keep reading the files."""
    for name in tables:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP SCHEMA IF EXISTS {layout.schema}")


# --- sources and sinks ---


def csv_ingest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, "customers")
    return read_raw_csv(spark, f"{folder}/customers.csv", schemas.CUSTOMERS)


def csv_ingest_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, "devices")
    return read_raw_csv(spark, f"{folder}/devices.csv", schemas.DEVICES, multi_line=False)


def csv_ingest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, "service_jobs")
    return read_raw_csv(spark, f"{folder}/service_jobs.csv", schemas.SERVICE_JOBS)


def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = with_ingestion_metadata(csv_ingest_jobs(spark, sf_dir), batch_id=BATCH_ID)
    return loaded.select(
        "job_id",
        F.col("_batch_id").alias("batch_id"),
        F.regexp_extract("_source_file", r"([a-z_]+\.csv)/", 1).alias("source_file"),
        F.col("_ingest_ts").isNotNull().alias("is_stamped"),
    )


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is replaced by one with other columns; readers then see the second state only."""
    layout = _layout(spark)
    layout.ensure_schema(spark)
    table = layout.silver("customers")
    customers = silver.silver_customers(fixture.raw_customers(spark, sf_dir))
    replace_table(customers.select("customer_id"), layout, table)
    replace_table(customers.select(CUSTOMER_COLUMNS), layout, table)
    current = spark.table(table)
    _forget(spark, layout, table)
    return current


# --- repair ---


def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_exact_rows(fixture.raw_jobs(spark, sf_dir))


def dedupe_exact_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice, with the three metadata columns of a bronze table; the copies differ in file or load."""
    file = F.when(F.col("estimated_cost") > 30000, "b.csv").otherwise("a.csv")
    loads = [
        F.struct(f.alias("_source_file"), F.lit(load).alias("_batch_id")) for f, load in ((F.lit("a.csv"), "2"), (file, "1"))
    ]
    twice = fixture.raw_jobs(spark, sf_dir).select("*", F.inline(F.array(*loads)))
    return dedupe_exact_rows(twice).withColumnsRenamed({"_source_file": "source_file", "_batch_id": "batch_id"})


def latest_within_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of a job have the same load time, so dates and status tell which is the newest."""
    one_load = fixture.raw_jobs(spark, sf_dir).withColumn("_ingest_ts", F.lit("2024-01-01").cast("timestamp"))
    return silver.latest_jobs(one_load).select(JOB_COLUMNS)


def jobs_without_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.keyless_jobs(fixture.raw_jobs(spark, sf_dir)).select(JOB_COLUMNS)


def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest_per_key(fixture.raw_jobs(spark, sf_dir), ["job_id"], "_ingest_ts", fixture.JOB_TIE_BREAKERS)


def backfill_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(_latest(spark, sf_dir).select("job_id", "technician_id", "technician_name"))


def price_bounds_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowest, highest = price_bounds("price_range")
    return fixture.raw_devices(spark, sf_dir).select(
        "device_id",
        "price_range",
        lowest.alias("price_range_min"),
        highest.alias("price_range_max"),
        price_range_known("price_range").alias("price_range_known"),
    )


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_customers(fixture.raw_customers(spark, sf_dir)).select(CUSTOMER_COLUMNS)


def silver_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_devices(fixture.raw_devices(spark, sf_dir)).select(
        *DEVICE_COLUMNS, "price_tier", "price_range_min", "price_range_max", "price_range_known"
    )


def silver_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _silver_jobs(spark, sf_dir, JOB_COLUMNS)
    return jobs.select(*JOB_COLUMNS, *LIFECYCLE, "has_valid_customer", "has_valid_device")


# --- enrichment ---


def lifecycle_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tracked(spark, sf_dir).select("job_id", *LIFECYCLE)


def referential_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _latest(spark, sf_dir).select("job_id", "customer_id", "device_id")
    flagged = flag_reference(jobs, _customers(spark, sf_dir), "customer_id", "has_valid_customer")
    return flag_reference(flagged, _devices(spark, sf_dir), "device_id", "has_valid_device")


def orphan_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs to show to the owners of the dimensions, once per missing reference."""
    jobs = stage(_latest(spark, sf_dir).select("job_id", "customer_id", "device_id"), "references")
    missing = [
        orphans(jobs, dimension, key).select("job_id", F.lit(key).alias("reference"), F.col(key).alias("missing_key"))
        for dimension, key in (
            (_customers(spark, sf_dir), "customer_id"),
            (_devices(spark, sf_dir), "device_id"),
        )
    ]
    return missing[0].unionByName(missing[1])


def visit_gaps_of_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of known customers only: jobs of unknown ones need not be of one person."""
    jobs = _latest(spark, sf_dir).select("job_id", "customer_id", "received_date")
    flagged = flag_reference(jobs, _customers(spark, sf_dir), "customer_id", "has_valid_customer")
    return visit_gaps(stage(flagged.filter("has_valid_customer").drop("has_valid_customer"), "visits"))


# --- marts ---


def mart_repair_turnaround(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.repair_turnaround(_tracked(spark, sf_dir), _devices(spark, sf_dir))


def mart_technician_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(_latest(spark, sf_dir).select(*TRACKING, "technician_id", "technician_name", "actual_cost"))
    return gold.technician_performance(add_lifecycle_fields(named, fixture.AS_OF))


def mart_repeat_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir)
    jobs = flag_reference(_tracked(spark, sf_dir), customers, "customer_id", "has_valid_customer")
    return gold.repeat_customers(jobs, customers)


def mart_device_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = _devices(spark, sf_dir)
    jobs = flag_reference(_tracked(spark, sf_dir), devices, "device_id", "has_valid_device")
    return gold.device_failures(jobs, devices)


def top_technicians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_technicians(mart_technician_performance(spark, sf_dir), 10).select(
        "technician_id", "technician_name", "jobs_completed", "total_revenue_generated"
    )


def top_failure_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_failure_modes(mart_device_failures(spark, sf_dir))


def failures_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.failures_by_tier(mart_device_failures(spark, sf_dir))


def kpi_repeat_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.repeat_share(mart_repeat_customers(spark, sf_dir))


# --- quality ---


def quality_of_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*TRACKING, "customer_id", "device_id", "technician_id", "technician_name"]
    return quality_report(_silver_jobs(spark, sf_dir, columns), job_checks())


def quality_of_raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_faulty_jobs(spark, sf_dir), raw_job_checks())


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that lost something as they were read, with what they lost."""
    kept = quarantine(_faulty_jobs(spark, sf_dir))
    return kept.select(
        *JOB_COLUMNS,
        F.array_join(F.transform(LOST, lambda x: F.concat_ws("=", x["column"], x["text"])), ";").alias("lost"),
        F.col(RECORD).isNotNull().alias("has_record"),
        F.regexp_extract(RECORD, ",(extra)$", 1).alias("record_end"),
    )


def quality_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_customers(spark, sf_dir), customer_checks())


def quality_of_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_devices(spark, sf_dir), device_checks())


def technician_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_lookup(_latest(spark, sf_dir), "technician_id", "technician_name")


def issue_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.issue_types(_latest(spark, sf_dir))


def profile_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(fixture.raw_jobs(spark, sf_dir))


# --- incremental ---

# The jobs arrive in two deliveries; both together are the whole table.
SECOND_DELIVERY_FROM = "1998-07-01"


def _deliveries(jobs: DataFrame) -> list[DataFrame]:
    """Each is read from the tables by itself: the load time is one of their columns, so a delivery joins its own line items only."""
    is_late = F.col("_ingest_ts") >= F.lit(SECOND_DELIVERY_FROM).cast("timestamp_ntz")
    return [jobs.filter(~is_late), jobs.filter(is_late)]


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "incremental")
    for delivery in _deliveries(fixture.raw_jobs(spark, sf_dir)):
        write_csv(delivery.select(JOB_COLUMNS), f"{base}/landing", mode="append")
        ingest_new_files(spark, f"{base}/landing", schemas.SERVICE_JOBS, f"{base}/bronze", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/bronze").select(*JOB_COLUMNS, F.col("_batch_id").alias("batch_no"))


def upsert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot repeats keys and the changes hold old news: untouched keys stay as they are, touched ones get one row."""
    jobs = stage(fixture.raw_jobs(spark, sf_dir).select("job_id", "_ingest_ts", "estimated_cost"), "raw_jobs")
    snapshot, changes = _deliveries(jobs)
    touched = changes.select("job_id").distinct()
    old_news = snapshot.join(touched, "job_id", "left_semi")
    return upsert_changes(snapshot, stage(changes.union(old_news), "changes"), ["job_id"], "_ingest_ts", ["estimated_cost"])


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark)
    layout.ensure_schema(spark)
    table = layout.silver("service_jobs")
    jobs = fixture.raw_jobs(spark, sf_dir)
    landing = f"{layout.storage}/landing"
    for delivery in _deliveries(jobs):
        delivery.write.mode("append").option("compression", "zstd").parquet(landing)
        changes = spark.readStream.schema(jobs.schema).parquet(landing)
        upsert_stream(
            changes,
            layout,
            table,
            ["job_id"],
            "_ingest_ts",
            f"{layout.storage}/checkpoint",
            fixture.JOB_TIE_BREAKERS,
            buckets=BUCKETS,
        )
    current = spark.table(table)
    _forget(spark, layout, table)
    return current


# --- everything ---


def refreshed_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw files to marts through stored tables; returns the stored marts."""
    raw = _raw_folder(spark, sf_dir, *RAW_FILES)
    layout = _layout(spark, raw)
    run_pipeline(spark, layout, as_of=fixture.AS_OF, batch_id=BATCH_ID)
    marts = {name: spark.table(layout.gold(name)) for name in MARTS}
    inputs = [layer(name) for layer in (layout.bronze, layout.silver) for name in RAW_FILES]
    inputs += [layout.bronze(f"{name}_quarantine") for name in RAW_FILES]
    more = [layout.silver(name) for name in ("technicians", "issue_types", "service_jobs_without_id")]
    _forget(spark, layout, *inputs, *more, *[layout.gold(name) for name in MARTS])
    return marts


def _all_rows(marts: dict[str, DataFrame]) -> DataFrame:
    """All rows and columns of the marts in one frame; a column that a mart lacks is null."""
    named = [mart.withColumn("mart", F.lit(name)) for name, mart in marts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rows(refreshed_marts(spark, sf_dir))


# Of stored tables that changes are added to: at the size of the given tables a bucket holds few rows anyway.
BUCKETS = 8


def _after_deliveries(spark: SparkSession, sf_dir: str, read: Callable[[Layout], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Two deliveries of jobs, each taken in by a run of its own; returns what is read from the tables."""
    layout = _layout(spark, _raw_folder(spark, sf_dir, "customers", "devices"))
    refresh_dimensions(spark, layout, batch_id=BATCH_ID)
    landing, checkpoints = f"{layout.storage}/landing", f"{layout.storage}/checkpoints"
    for delivery in _deliveries(fixture.raw_jobs(spark, sf_dir)):
        write_csv(delivery.select(JOB_COLUMNS), landing, mode="append")
        run_incremental(spark, layout, landing, checkpoints, as_of=fixture.AS_OF, buckets=BUCKETS)
    found = read(layout)
    inputs = [layer(name) for layer in (layout.bronze, layout.silver) for name in RAW_FILES]
    inputs += [layout.bronze(f"{name}_quarantine") for name in RAW_FILES]
    more = [layout.silver(n) for n in ("technicians", "issue_types", "service_jobs_latest", *[f"state_{s.name}" for s in STATES])]
    _forget(spark, layout, *inputs, *more, *[layout.gold(name) for name in MARTS])
    return found


def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rows(_after_deliveries(spark, sf_dir, lambda layout: {n: spark.table(layout.gold(n)) for n in MARTS}))


def silver_jobs_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver jobs, which an incremental run need not store."""
    jobs = _after_deliveries(spark, sf_dir, lambda layout: {"jobs": current_jobs(spark, layout, fixture.AS_OF)})["jobs"]
    return jobs.select(*JOB_COLUMNS, *LIFECYCLE, "has_valid_customer", "has_valid_device")


def turnaround_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles over two years of months, from stored counts per day and without the jobs."""
    signed_jobs = signed(_latest(spark, sf_dir).limit(0), _latest(spark, sf_dir))
    state = stage(TURNAROUND.of(signed_jobs), "turnaround_state")
    return stored_quantiles(state, ["issue_type"], [0.25, 0.5, 0.9], ("1995-03-01", "1997-02-01"))


# --- sketches and buckets ---


def sketched_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct devices of half a year by issue, merged from stored sketches of each day; exact ones beside them."""
    devices = _devices(spark, sf_dir)
    jobs = stage(_latest(spark, sf_dir).select("received_date", "device_id", "issue_type"), "jobs")
    days = ("1996-01-01", "1996-06-30")
    estimated = units_affected(stage(unit_sketches(jobs, devices), "unit_sketches"), ["issue_type"], days)
    known = jobs.filter(F.col("received_date").between(*days)).join(devices, "device_id", "left_semi")
    exact = known.groupBy("issue_type").agg(F.count_distinct("device_id").alias("units"))
    error = F.abs(F.col("distinct_units_affected") - F.col("units")) / F.col("units")
    return estimated.join(exact, "issue_type").select("issue_type", "failure_count", "units", (error < 0.08).alias("is_close"))


def profile_of_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two deliveries, stored apart and merged; estimates within 8 % of the exact counts."""
    jobs = stage(fixture.raw_jobs(spark, sf_dir), "raw_jobs")
    states = [profile_sketch(delivery) for delivery in _deliveries(jobs)]
    merged = merged_profile(stage(states[0].unionByName(states[1]), "profiles"))
    exact = profile(jobs).select("column_name", "distinct_count", "duplicate_rows")
    close = lambda a, b, of: F.abs(F.col(a) - F.col(b)) <= 0.08 * F.col(of)
    joined = merged.withColumnsRenamed({"distinct_count": "d", "duplicate_rows": "r"}).join(exact, "column_name")
    return joined.select(
        "column_name",
        "row_count",
        "null_count",
        "distinct_count",
        "duplicate_rows",
        (close("d", "distinct_count", "distinct_count") & close("r", "duplicate_rows", "row_count")).alias("is_close"),
    )


def bucketed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs and devices are stored in buckets of the device, so that they meet without a shuffle of the jobs."""
    storage = scratch_folder(spark, "tables")
    buckets = {"silver_service_jobs": (BUCKETS, ("device_id",)), "silver_devices": (BUCKETS, ("device_id",))}
    layout = Layout(schema=f"stratalake_{storage[-12:]}", raw_path="", storage=storage, bucket_by=buckets)
    layout.ensure_schema(spark)
    columns = ["job_id", "device_id", "issue_type", "received_date"]
    replace_table(_latest(spark, sf_dir).select(columns), layout, layout.silver("service_jobs"))
    replace_table(silver.silver_devices(fixture.raw_devices(spark, sf_dir)), layout, layout.silver("devices"))
    jobs, devices = spark.table(layout.silver("service_jobs")), spark.table(layout.silver("devices"))
    return jobs.join(devices.select("device_id", "brand", "device_type", "price_tier"), "device_id", "left")


QUERIES: dict[str, Query] = {
    "csv_ingest_customers": csv_ingest_customers,
    "csv_ingest_devices": csv_ingest_devices,
    "csv_ingest_jobs": csv_ingest_jobs,
    "csv_quarantine": csv_quarantine,
    "ingest_metadata": ingest_metadata,
    "snapshot_roundtrip": snapshot_roundtrip,
    "dedupe_exact": dedupe_exact,
    "dedupe_exact_metadata": dedupe_exact_metadata,
    "keep_latest": keep_latest,
    "latest_within_load": latest_within_load,
    "jobs_without_id": jobs_without_id,
    "backfill_names": backfill_names,
    "price_bounds": price_bounds_of_labels,
    "silver_customers": silver_customers,
    "silver_devices": silver_devices,
    "silver_jobs": silver_jobs,
    "lifecycle_fields": lifecycle_fields,
    "referential_flags": referential_flags,
    "orphan_jobs": orphan_jobs,
    "visit_gaps": visit_gaps_of_jobs,
    "mart_repair_turnaround": mart_repair_turnaround,
    "mart_technician_performance": mart_technician_performance,
    "mart_repeat_customers": mart_repeat_customers,
    "mart_device_failures": mart_device_failures,
    "top_technicians": top_technicians,
    "top_failure_modes": top_failure_modes,
    "failures_by_tier": failures_by_tier,
    "kpi_repeat_share": kpi_repeat_share,
    "quality_report": quality_of_jobs,
    "quality_raw_jobs": quality_of_raw_jobs,
    "quality_customers": quality_of_customers,
    "quality_devices": quality_of_devices,
    "technician_names": technician_names,
    "issue_types": issue_types,
    "profile_jobs": profile_jobs,
    "incremental_ingest": incremental_ingest,
    "upsert_latest": upsert_latest,
    "upsert_repeated_keys": upsert_repeated_keys,
    "refresh_all": refresh_all,
    "refresh_incremental": refresh_incremental,
    "silver_jobs_incremental": silver_jobs_incremental,
    "turnaround_quantiles": turnaround_quantiles,
    "sketched_units": sketched_units,
    "profile_of_deliveries": profile_of_deliveries,
    "bucketed_failures": bucketed_failures,
}
