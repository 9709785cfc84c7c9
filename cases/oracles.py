"""The same results in DuckDB SQL, written independently of the Spark code."""

from cases.fixture import (
    AS_OF,
    CUSTOMERS,
    DEVICES,
    FAULT,
    FEW_COLUMNS,
    JOB_TIE_BREAKERS,
    JOBS,
    RAW_CUSTOMERS_SQL,
    RAW_DEVICES_SQL,
    RAW_JOBS_SQL,
)

JOB_COLUMNS = [c for c in JOBS if not c.startswith("_")]
CUSTOMER_COLUMNS = [c for c in CUSTOMERS if not c.startswith("_")]
DEVICE_COLUMNS = [c for c in DEVICES if not c.startswith("_")]


def _newest_first(columns: list[str], key: str) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns if c != key)


def _title(text: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({text})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def _date(text: str) -> str:
    return f"cast(try_strptime(trim({text}), '%Y-%m-%d') as date)"


_DELIVERY = "case when _ingest_ts >= timestamp '1998-07-01' then 1 else 0 end"
_PROGRESS = """case job_status when 'Completed' then 4 when 'Cancelled' then 3 when 'In Progress' then 2
  when 'Pending' then 1 else 0 end"""


def _ctes(jobs_by: str = "load time") -> str:
    """Raw to silver. Jobs are ordered by load time and tie breakers, or as the versions of one load ("file"), or of one
    delivery after the other ("delivery"). Other tables have a load time in the first case only."""
    load = ["_ingest_ts"] if jobs_by == "load time" else []
    job_order = ["_ingest_ts", *JOB_TIE_BREAKERS]
    if jobs_by != "load time":
        others = [c for c in JOB_COLUMNS if c not in ("completed_date", "job_status")]
        job_order = [*([_DELIVERY] if jobs_by == "delivery" else []), "completed_date", _PROGRESS, *others, "job_status"]
    return f"""
with raw_jobs as ({RAW_JOBS_SQL}),
raw_customers as ({RAW_CUSTOMERS_SQL}),
raw_devices as ({RAW_DEVICES_SQL}),
tidy_jobs as (
  select nullif(trim(job_id), '') as job_id, nullif(trim(customer_id), '') as customer_id,
    nullif(trim(device_id), '') as device_id, trim(issue_type) as issue_type,
    {_title('job_status')} as job_status, {_date('received_date')} as received_date,
    {_date('promised_date')} as promised_date, {_date('completed_date')} as completed_date,
    nullif(trim(technician_id), '') as technician_id, nullif(trim(technician_name), '') as technician_name,
    repair_notes, try_cast(estimated_cost as decimal(20,2)) as estimated_cost,
    try_cast(actual_cost as decimal(20,2)) as actual_cost, _ingest_ts
  from raw_jobs),
latest_jobs as (
  select * from tidy_jobs where job_id is not null
  qualify row_number() over (partition by job_id order by {_newest_first(job_order, 'job_id')}) = 1),
names as (select technician_id, min(technician_name) as found from latest_jobs group by 1),
named_jobs as (
  select j.* replace (coalesce(j.technician_name, n.found) as technician_name)
  from latest_jobs j left join names n on j.technician_id = n.technician_id),
silver_customers as (
  select * from (
    select nullif(trim(customer_id), '') as customer_id, trim(customer_name) as customer_name,
      trim(phone_number) as phone_number, lower(trim(email)) as email, {_title('city')} as city,
      {_date('registration_date')} as registration_date, _ingest_ts
    from raw_customers) c
  where customer_id is not null
  qualify row_number() over (
    partition by customer_id order by {_newest_first(load + CUSTOMER_COLUMNS, 'customer_id')}) = 1),
silver_devices as (
  select *, regexp_extract(price_range, '^(\\w[\\w\\-]*)', 1) as price_tier,
    case when price_range like '%Budget%' then 0 when price_range like '%Premium%' then 40000 else 15000 end as price_range_min,
    case when price_range like '%Budget%' then 15000 when price_range like '%Premium%' then null else 40000 end as price_range_max,
    coalesce(regexp_matches(price_range, 'Budget|Mid-range|Premium'), false) as price_range_known
  from (
    select nullif(trim(device_id), '') as device_id, trim(brand) as brand, trim(device_type) as device_type,
      trim(model_series) as model_series, warranty_months, price_range, _ingest_ts
    from raw_devices) d
  where device_id is not null
  qualify row_number() over (
    partition by device_id order by {_newest_first(load + DEVICE_COLUMNS, 'device_id')}) = 1),
silver_jobs as (
  select j.*, job_status = 'Completed' as is_completed, job_status = 'Cancelled' as is_cancelled,
    cast(date_diff('day', received_date, completed_date) as integer) as turnaround_days,
    case when completed_date is not null then completed_date > promised_date
      when job_status <> 'Cancelled' then date '{AS_OF}' > promised_date else false end as is_overdue,
    cast(case when completed_date > promised_date then date_diff('day', promised_date, completed_date) else 0 end
      as integer) as sla_breach_days,
    exists (select 1 from silver_customers c where c.customer_id = j.customer_id) as has_valid_customer,
    exists (select 1 from silver_devices d where d.device_id = j.device_id) as has_valid_device
  from named_jobs j)
"""


_CTES = _ctes()


def _mean(value: str, digits: int = 2) -> str:
    """Half up, with the sum still exact when it is scaled."""
    return f"round(cast(sum({value}) * {10**digits} as double) / count({value})) / {10**digits}"


def _rate(part: str, whole: str) -> str:
    return f"round(cast(({part}) * 10000 as double) / ({whole})) / 100"


def _select(body: str) -> str:
    return _CTES + body


_DONE_DAYS = "case when is_completed then turnaround_days end"
_DONE_COST = "case when is_completed then actual_cost end"

_TURNAROUND = f"""
select cast(date_trunc('month', completed_date) as date) as completion_month, device_type, issue_type,
  count(job_id) as completed_jobs, {_mean('turnaround_days')} as avg_turnaround_days,
  quantile_disc(turnaround_days, 0.5) as median_turnaround_days, max(turnaround_days) as max_turnaround_days,
  cast(sum(cast(is_overdue as int)) as bigint) as sla_breaches,
  {_rate('sum(cast(is_overdue as int))', 'count(is_overdue)')} as sla_breach_rate_pct,
  {_mean('actual_cost')} as avg_actual_cost
from silver_jobs left join silver_devices using (device_id)
where is_completed group by 1, 2, 3"""

_TECHNICIANS = f"""
select *, {_rate('jobs_completed', 'total_jobs_assigned')} as completion_rate_pct,
  {_rate('jobs_completed - jobs_overdue', 'greatest(jobs_completed, 1)')} as on_time_rate_pct
from (
  select technician_id, technician_name, count(job_id) as total_jobs_assigned,
    cast(sum(cast(is_completed as int)) as bigint) as jobs_completed,
    cast(sum(cast(is_cancelled as int)) as bigint) as jobs_cancelled,
    {_mean(_DONE_DAYS)} as avg_turnaround_days,
    cast(sum(cast(is_overdue as int)) as bigint) as jobs_overdue,
    cast(sum({_DONE_COST}) as double) as total_revenue_generated,
    case when count(*) filter (where is_completed) > 0 then
      {_rate('count(*) filter (where is_completed and is_overdue is not true)', 'count(*) filter (where is_completed)')}
    end as on_time_completed_rate_pct
  from silver_jobs where technician_id is not null group by 1, 2) t"""

_REPEAT = f"""
select customer_id, any_value(c.customer_name) as customer_name, any_value(c.city) as city,
  any_value(c.registration_date) as registration_date, count(job_id) as total_visits,
  count(job_id) > 1 as is_repeat_customer, min(received_date) as first_visit_date,
  max(received_date) as last_visit_date,
  case when count(gap) > 0 then {_mean('gap', 1)} end as avg_days_between_visits,
  count(distinct device_id) as distinct_devices_serviced, count(distinct issue_type) as distinct_issue_types,
  cast(sum({_DONE_COST}) as double) as total_spend
from (
  select *, date_diff('day', lag(received_date) over (
    partition by customer_id order by received_date nulls first, job_id), received_date) as gap
  from silver_jobs where has_valid_customer) j
left join silver_customers c using (customer_id)
group by customer_id"""

_FAILURES = f"""
select *, cast(rank() over (partition by brand, device_type order by failure_count desc) as integer)
  as failure_rank_within_device
from (
  select brand, device_type, issue_type, warranty_months, price_tier, count(job_id) as failure_count,
    count(distinct device_id) as distinct_units_affected,
    case when count({_DONE_DAYS}) > 0 then {_mean(_DONE_DAYS)} end as avg_turnaround_days,
    case when count({_DONE_COST}) > 0 then {_mean(_DONE_COST)} end as avg_repair_cost
  from silver_jobs left join silver_devices using (device_id)
  where has_valid_device group by 1, 2, 3, 4, 5) f"""


def _check(name: str, observed: str, failing: str | None = None, table: str = "silver_jobs") -> str:
    severity = "error" if failing else "info"
    passed = f"not (observed {failing})" if failing else "true"
    return f"""select '{name}' as check_name, '{severity}' as severity, observed, {passed} as passed
from (select cast({observed} as bigint) as observed from {table})"""


_QUALITY = "\nunion all\n".join(
    [
        _check("rows", "count(*)"),
        _check("unique_job_id", "count(*) - count(distinct job_id)", "> 0"),
        _check("turnaround_not_negative", "count(*) filter (where turnaround_days < 0)", "> 0"),
        _check("null_technician_name", "count(*) filter (where technician_name is null)"),
        _check("orphan_customer", "count(*) filter (where not has_valid_customer)"),
        _check("orphan_device", "count(*) filter (where not has_valid_device)"),
    ]
)

# What is left of the records of faulty files.
_FAULTY = ", ".join(
    f"case when fault = 3 or ({c!r}, fault) in (('estimated_cost', 0), ('actual_cost', 1)) then null else {c} end as {c}"
    if i >= FEW_COLUMNS
    else c
    for i, c in enumerate(JOB_COLUMNS)
)
_FAULTY_JOBS = f"(select fault, {_FAULTY} from (select {FAULT} as fault, * from raw_jobs) r) faulty"
_UNREADABLE = "count(*) filter (where trim({0}) <> '' and try_strptime(trim({0}), '%Y-%m-%d') is null)"
_QUALITY_RAW = "\nunion all\n".join(
    [
        _check("not_empty", "count(*)", "< 1", _FAULTY_JOBS),
        _check("no_job_id", "count(*) filter (where coalesce(trim(job_id), '') = '')", None, _FAULTY_JOBS),
        _check(
            "unnamed_technician",
            "count(*) filter (where trim(technician_id) <> '' and coalesce(trim(technician_name), '') = '')",
            None,
            _FAULTY_JOBS,
        ),
        *[
            _check(f"unreadable_{c}", _UNREADABLE.format(c), None, _FAULTY_JOBS)
            for c in ("received_date", "promised_date", "completed_date")
        ],
        *[
            _check(f"unreadable_{c}", f"count({c}) - count(try_cast({c} as decimal(20,2)))", None, _FAULTY_JOBS)
            for c in ("estimated_cost", "actual_cost")
        ],
        _check("lost_estimated_cost", "count(*) filter (where fault = 0)", None, _FAULTY_JOBS),
        _check("lost_actual_cost", "count(*) filter (where fault = 1)", None, _FAULTY_JOBS),
        _check("wrong_column_count", "count(*) filter (where fault in (2, 3))", None, _FAULTY_JOBS),
    ]
)
_QUALITY_CUSTOMERS = "\nunion all\n".join(
    [
        _check("rows", "count(*)", None, "silver_customers"),
        _check("unique_customer_id", "count(*) - count(distinct customer_id)", "> 0", "silver_customers"),
        _check("null_email", "count(*) - count(email)", None, "silver_customers"),
        _check("null_registration_date", "count(*) - count(registration_date)", None, "silver_customers"),
    ]
)
_QUALITY_DEVICES = "\nunion all\n".join(
    [
        _check("rows", "count(*)", None, "silver_devices"),
        _check("unique_device_id", "count(*) - count(distinct device_id)", "> 0", "silver_devices"),
        _check("unknown_price_range", "count(*) filter (where not price_range_known)", None, "silver_devices"),
    ]
)

_PROFILE = "\nunion all\n".join(
    f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
  count(distinct {c}) as distinct_count,
  count(*) - (select count(*) from (select distinct {', '.join(JOB_COLUMNS)} from raw_jobs)) as duplicate_rows
from raw_jobs"""
    for c in JOB_COLUMNS
)

_JOB_LIST = ", ".join(JOB_COLUMNS)
_LIFECYCLE = "is_completed, is_cancelled, turnaround_days, is_overdue, sla_breach_days"
_LATEST_RAW = f"""select * from raw_jobs
qualify row_number() over (partition by job_id order by {_newest_first(['_ingest_ts', *JOB_TIE_BREAKERS], 'job_id')}) = 1"""

_ALL_MARTS = "\nunion all by name\n".join(
    f"select '{mart}' as mart, * from ({query}) m"
    for mart, query in (
        ("repair_turnaround", _TURNAROUND),
        ("technician_performance", _TECHNICIANS),
        ("repeat_customers", _REPEAT),
        ("device_failure_trends", _FAILURES),
    )
)

ORACLES: dict[str, str] = {
    "csv_ingest_customers": _select(f"select {', '.join(CUSTOMER_COLUMNS)} from raw_customers"),
    "csv_ingest_devices": _select(f"select {', '.join(DEVICE_COLUMNS)} from raw_devices"),
    "csv_ingest_jobs": _select(f"select {_JOB_LIST} from raw_jobs"),
    "csv_quarantine": _select(
        f"""select {', '.join(JOB_COLUMNS)},
  case fault when 0 then 'estimated_cost=on request' when 1 then 'actual_cost=12,50 EUR' else '' end as lost,
  fault in (2, 3) as has_record, case fault when 2 then 'extra' when 3 then '' end as record_end
from {_FAULTY_JOBS} where fault between 0 and 3"""
    ),
    "ingest_metadata": _select(
        """select job_id, '20240101000000' as batch_id, 'service_jobs.csv' as source_file, true as is_stamped
from raw_jobs"""
    ),
    "snapshot_roundtrip": _select(f"select {', '.join(CUSTOMER_COLUMNS)} from silver_customers"),
    "dedupe_exact": _select(f"select {_JOB_LIST}, max(_ingest_ts) as _ingest_ts from raw_jobs group by {_JOB_LIST}"),
    "keep_latest": _select(_LATEST_RAW),
    "backfill_names": _select("select job_id, technician_id, technician_name from named_jobs"),
    "price_bounds": _select(
        """select device_id, price_range,
  case left(price_range, 3) when 'Bud' then 0 when 'Pre' then 40000 else 15000 end as price_range_min,
  case left(price_range, 3) when 'Bud' then 15000 when 'Pre' then null else 40000 end as price_range_max,
  coalesce(price_range[:6] in ('Budget', 'Mid-ra', 'Premiu'), false) as price_range_known
from raw_devices"""
    ),
    "silver_customers": _select(f"select {', '.join(CUSTOMER_COLUMNS)} from silver_customers"),
    "silver_devices": _select(
        f"""select {', '.join(DEVICE_COLUMNS)}, price_tier, price_range_min, price_range_max, price_range_known
from silver_devices"""
    ),
    "silver_jobs": _select(f"select {_JOB_LIST}, {_LIFECYCLE}, has_valid_customer, has_valid_device from silver_jobs"),
    "lifecycle_fields": _select(f"select job_id, {_LIFECYCLE} from silver_jobs"),
    "referential_flags": _select(
        "select job_id, customer_id, device_id, has_valid_customer, has_valid_device from silver_jobs"
    ),
    "orphan_jobs": _select(
        """select job_id, 'customer_id' as reference, customer_id as missing_key from silver_jobs
where not has_valid_customer
union all
select job_id, 'device_id', device_id from silver_jobs where not has_valid_device"""
    ),
    "visit_gaps": _select(
        """select job_id, customer_id, received_date, prev_received_date,
  cast(date_diff('day', prev_received_date, received_date) as integer) as days_since_prev_visit
from (
  select *, lag(received_date) over (
    partition by customer_id order by received_date nulls first, job_id) as prev_received_date
  from silver_jobs where has_valid_customer) g"""
    ),
    "mart_repair_turnaround": _select(_TURNAROUND),
    "mart_technician_performance": _select(_TECHNICIANS),
    "mart_repeat_customers": _select(_REPEAT),
    "mart_device_failures": _select(_FAILURES),
    "top_technicians": _select(
        f"""select technician_id, technician_name, jobs_completed, total_revenue_generated from ({_TECHNICIANS}) p
order by jobs_completed desc, technician_id, technician_name nulls first limit 10"""
    ),
    "top_failure_modes": _select(f"select * from ({_FAILURES}) f where failure_rank_within_device = 1"),
    "failures_by_tier": _select(
        f"""select price_tier, warranty_months, cast(sum(failure_count) as bigint) as failure_count,
  count(*) as failure_modes
from ({_FAILURES}) f group by 1, 2"""
    ),
    "kpi_repeat_share": _select(
        f"""select count(*) as customers,
  {_rate('count(*) filter (where is_repeat_customer)', 'count(*)')} as repeat_share_pct
from ({_REPEAT}) r"""
    ),
    "quality_report": _select(_QUALITY),
    "quality_raw_jobs": _select(_QUALITY_RAW),
    "quality_customers": _select(_QUALITY_CUSTOMERS),
    "quality_devices": _select(_QUALITY_DEVICES),
    "technician_names": _select(
        """select technician_id, min(technician_name) as technician_name, count(distinct technician_name) as value_count
from latest_jobs where technician_id is not null and technician_name is not null group by 1"""
    ),
    "issue_types": _select("select issue_type, count(*) as jobs from latest_jobs where issue_type is not null group by 1"),
    "profile_jobs": _select(_PROFILE),
    "incremental_ingest": _select(
        f"select {_JOB_LIST}, concat('b000000000', {_DELIVERY}) as batch_no from raw_jobs"
    ),
    "upsert_latest": _select(_LATEST_RAW),
    "dedupe_exact_metadata": _select(
        f"""select {_JOB_LIST}, _ingest_ts, source_file, batch_id from (
  select *, 'a.csv' as source_file, '2' as batch_id from raw_jobs
  union all select *, case when estimated_cost > 30000 then 'b.csv' else 'a.csv' end, '1' from raw_jobs) twice
qualify row_number() over (
  partition by {_JOB_LIST} order by _ingest_ts desc, source_file desc, batch_id desc) = 1"""
    ),
    "upsert_repeated_keys": _select(
        f"""select job_id, _ingest_ts, estimated_cost from raw_jobs where {_DELIVERY} = 0
  and job_id not in (select job_id from raw_jobs where {_DELIVERY} = 1)
union all
select job_id, _ingest_ts, estimated_cost from raw_jobs
where job_id in (select job_id from raw_jobs where {_DELIVERY} = 1)
qualify row_number() over (partition by job_id order by _ingest_ts desc, estimated_cost desc) = 1"""
    ),
    "latest_within_load": _ctes("file") + f"select {_JOB_LIST} from latest_jobs",
    "jobs_without_id": _select(f"select {_JOB_LIST} from raw_jobs where coalesce(trim(job_id), '') = ''"),
    "refresh_all": _ctes("file") + _ALL_MARTS,
    "refresh_incremental": _ctes("delivery") + _ALL_MARTS,
    "silver_jobs_incremental": _ctes("delivery")
    + f"select {_JOB_LIST}, {_LIFECYCLE}, has_valid_customer, has_valid_device from silver_jobs",
    "sketched_units": _select(
        """select issue_type, count(*) as failure_count, count(distinct device_id) as units, true as is_close
from silver_jobs where has_valid_device and received_date between date '1996-01-01' and date '1996-06-30' group by 1"""
    ),
    "profile_of_deliveries": _select(f"select *, true as is_close from ({_PROFILE}) p"),
    "bucketed_failures": _select(
        """select job_id, j.device_id, j.issue_type, j.received_date, d.brand, d.device_type, d.price_tier
from silver_jobs j left join silver_devices d on j.device_id = d.device_id"""
    ),
    "turnaround_quantiles": _select(
        """select issue_type, count(turnaround_days) as timed_jobs, quantile_disc(turnaround_days, 0.25) as q25,
  quantile_disc(turnaround_days, 0.5) as q50, quantile_disc(turnaround_days, 0.9) as q90
from silver_jobs where is_completed and completed_date between date '1995-03-01' and date '1997-02-28' group by 1"""
    ),
}
