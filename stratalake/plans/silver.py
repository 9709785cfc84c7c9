"""Silver tables: typed, tidy, one row per key, with derived fields."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.lifecycle import add_lifecycle_fields
from stratalake.functions.numbers import money
from stratalake.functions.pricing import price_bounds, price_range_known, price_tier
from stratalake.functions.text import iso_date, tidy, tidy_key, title_case
from stratalake.operators.backfill import backfill_from_group
from stratalake.operators.dedupe import keep_latest_per_key
from stratalake.operators.references import flag_reference
from stratalake.sources.raw_csv import LOST, RECORD


# From the first to the last status that a job goes through.
STATUS_ORDER = ("Pending", "In Progress", "Cancelled", "Completed")


def _without_losses(bronze: DataFrame) -> DataFrame:
    """What a column could not hold stays in bronze."""
    return bronze.drop(LOST, RECORD)


def standardise_customers(bronze: DataFrame) -> DataFrame:
    """Tidy text and typed registration date; rows without a key are left out."""
    return _without_losses(bronze).withColumns(
        {
            "customer_id": tidy_key("customer_id"),
            "customer_name": tidy("customer_name"),
            "phone_number": tidy("phone_number"),
            "email": F.lower(tidy("email")),
            "city": title_case("city"),
            "registration_date": iso_date("registration_date"),
        }
    ).filter(F.col("customer_id").isNotNull())


def standardise_devices(bronze: DataFrame) -> DataFrame:
    """Tidy text and the price label split into tier and bounds; rows without a key are left out."""
    lowest, highest = price_bounds("price_range")
    return _without_losses(bronze).withColumns(
        {
            "device_id": tidy_key("device_id"),
            "brand": tidy("brand"),
            "device_type": tidy("device_type"),
            "model_series": tidy("model_series"),
            "price_tier": price_tier("price_range"),
            "price_range_min": lowest,
            "price_range_max": highest,
            "price_range_known": price_range_known("price_range"),
        }
    ).filter(F.col("device_id").isNotNull())


def standardise_jobs(bronze: DataFrame) -> DataFrame:
    """Tidy text, typed dates and exact amounts. It comes first, so that ``'T1 '`` and ``'T1'`` are one id."""
    return _without_losses(bronze).withColumns(
        {
            "job_id": tidy_key("job_id"),
            "customer_id": tidy_key("customer_id"),
            "device_id": tidy_key("device_id"),
            "technician_id": tidy_key("technician_id"),
            "technician_name": tidy_key("technician_name"),
            "issue_type": tidy("issue_type"),
            "job_status": title_case("job_status"),
            "received_date": iso_date("received_date"),
            "promised_date": iso_date("promised_date"),
            "completed_date": iso_date("completed_date"),
            "estimated_cost": money("estimated_cost"),
            "actual_cost": money("actual_cost"),
        }
    )


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_silver_updated_ts", F.current_timestamp())


def silver_customers(bronze: DataFrame) -> DataFrame:
    return _stamped(keep_latest_per_key(standardise_customers(bronze), ["customer_id"], "_ingest_ts"))


def silver_devices(bronze: DataFrame) -> DataFrame:
    return _stamped(keep_latest_per_key(standardise_devices(bronze), ["device_id"], "_ingest_ts"))


def newest_job_first(columns: Sequence[str]) -> list[str | Column]:
    """Which of two versions of a job in one load is newer: the one with the later completion date, then the one whose
    status is further on, then the higher one in the other columns."""
    progress = F.coalesce(F.array_position(F.array(*map(F.lit, STATUS_ORDER)), F.col("job_status")), F.lit(0))
    others = [c for c in columns if c not in ("job_id", "completed_date", "job_status") and c[0] != "_"]
    return [F.col("completed_date").desc_nulls_last(), progress.desc(), *others, "job_status"]


def latest_jobs(bronze: DataFrame, tie_breakers: Sequence[str | Column] | None = None) -> DataFrame:
    """The current version of each job that has an id. Exact copies share the job's key, so they go in the same step.

    By default :func:`newest_job_first` tells versions of one load apart. Name the columns that do where they are known:
    a query that needs few columns then shuffles few. :func:`keyless_jobs` has the rows without an id.
    """
    jobs = standardise_jobs(bronze).filter(F.col("job_id").isNotNull())
    return keep_latest_per_key(jobs, ["job_id"], "_ingest_ts", newest_job_first(jobs.columns) if tie_breakers is None else tie_breakers)


def keyless_jobs(bronze: DataFrame) -> DataFrame:
    """The jobs without an id, null or blank: nobody can say which of them are one job, so they stay out of silver."""
    return bronze.filter(tidy_key("job_id").isNull())


def issue_types(jobs: DataFrame) -> DataFrame:
    """The dimension of issue types: each one that occurs, and in how many jobs. ``jobs`` may also be sums with a column ``jobs``."""
    number = F.sum("jobs") if "jobs" in jobs.columns else F.count(F.lit(1))
    return jobs.filter(F.col("issue_type").isNotNull()).groupBy("issue_type").agg(number.alias("jobs"))


def backfill_technician_names(jobs: DataFrame, technicians: DataFrame | None = None, stored: bool = False) -> DataFrame:
    return backfill_from_group(jobs, "technician_id", "technician_name", technicians, stored)


def silver_jobs(
    latest: DataFrame,
    customers: DataFrame,
    devices: DataFrame,
    as_of: "dt.date | str | Column | None" = None,
    technicians: DataFrame | None = None,
) -> DataFrame:
    """:func:`latest_jobs` with technician names filled, lifecycle fields and reference flags.

    ``latest`` is read up to five times, for the names unless ``technicians`` is given, and for the rows without a name and the keys
    that large customers or devices lack, so pass it stored.
    """
    enriched = add_lifecycle_fields(backfill_technician_names(latest, technicians, stored=True), as_of)
    flagged = flag_reference(enriched, customers, "customer_id", "has_valid_customer", latest)
    return _stamped(flag_reference(flagged, devices, "device_id", "has_valid_device", latest))
