"""Repair data derived from the order tables.

The expressions are SQL that Spark and DuckDB both understand, but for the name of the text type. A line item
is a repair job: its order gives customer, status and date, its part the device, its supplier the technician.
The text is dirty on purpose: padded, in the wrong case, with blank ids, missing technicians, names, states and dates, dates that
are none, amounts of any size, technicians with two names, cancelled jobs with a date, unknown price labels, orphans and
repeated deliveries.
"""

import math

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.files import size

AS_OF = "1999-01-01"

_STATUS = """case o_orderstatus when 'F' then 'Completed' when 'O' then 'In Progress'
    else case when l_linestatus = 'F' then 'Cancelled' else 'Pending' end end"""
_RECEIVED = "cast(o_orderdate as date)"
_COST = """cast(cast(round(cast(l_extendedprice as decimal(12,2))
    * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2))), 2) as decimal(12,2)) as double)"""
_TIER = "case when p_retailprice < 933 then 'Budget (< 15K)' when p_retailprice < 966 then 'Mid-range (15K-40K)' else 'Premium (> 40K)' end"

# `copy` is 1, and also 2 for a re-delivered row.
JOBS = {
    "job_id": "case when l_partkey % 401 = 0 then '  ' else concat('J', cast(l_orderkey as {text}), '-', cast(l_linenumber as {text})) end",
    "customer_id": "case when l_partkey % 50 = 0 then '-1' else cast(o_custkey as {text}) end",
    "device_id": "case when l_suppkey % 40 = 7 then '-1' else cast(l_partkey as {text}) end",
    "issue_type": "concat(' ', o_orderpriority)",
    "job_status": f"case when l_partkey % 419 = 0 then null else case l_partkey % 3 when 0 then concat(' ', upper({_STATUS}), ' ') when 1 then lower({_STATUS}) else {_STATUS} end end",
    "received_date": f"case when l_partkey % 307 = 0 then null else cast({_RECEIVED} as {{text}}) end",
    "promised_date": f"case when l_partkey % 211 = 0 then 'tbd' else cast({_RECEIVED} + (7 + l_linenumber) as {{text}}) end",
    "completed_date": f"case when o_orderstatus = 'F' or l_partkey % 43 = 0 then cast({_RECEIVED} + (cast(l_quantity as int) % 20) as {{text}}) end",
    "technician_id": "case when l_suppkey % 29 = 5 then null when l_partkey % 4 = 0 then concat(cast(l_suppkey as {text}), ' ') else cast(l_suppkey as {text}) end",
    "technician_name": "case when l_partkey % 20 = 0 or l_suppkey % 25 = 3 then null when l_suppkey % 7 = 0 and l_partkey % 2 = 0 then concat('Dr. ', s_name) else s_name end",
    "repair_notes": "case when l_linenumber % 3 = 0 then null else concat('Part \"', cast(l_partkey as {text}), '\", checked' , chr(10), 'line ', cast(l_linenumber as {text})) end",
    "estimated_cost": "case when l_partkey % 449 = 0 then cast(123456789012.5 as double) when l_partkey % 457 = 0 then cast(1e30 as double) else l_extendedprice end",
    "actual_cost": f"case when o_orderstatus = 'F' then {_COST} end",
    "_ingest_ts": "l_shipdate",
}
# Versions of a job with the same load time differ in one of these.
JOB_TIE_BREAKERS = ["device_id", "estimated_cost", "technician_id"]
# What is wrong with the record of a job in the faulty files: 0 and 1 text for an amount, 2 a column too many, 3 too few.
FAULT = "case when estimated_cost < 1000000000 then cast(round(estimated_cost * 100) as bigint) % 50 else -1 end"
FEW_COLUMNS = 9
JOBS_REDELIVERED = "l_orderkey % 150 = 0"

# The first copy of a customer or device is the current one. The second, an older one, differs in `city` or
# `warranty_months`; the third has a blank key.
CUSTOMERS = {
    "customer_id": "case when copy = 3 then '  ' else concat(' ', cast(c_custkey as {text}), ' ') end",
    "customer_name": "concat(c_name, ' ')",
    "phone_number": "concat(' +91', lpad(cast(c_custkey as {text}), 10, '0'))",
    "email": "case when c_custkey % 11 = 5 then null else concat(' USER', cast(c_custkey as {text}), '@Example.COM ') end",
    "city": "case when copy = 2 then 'elsewhere' else concat(' ', lower(n_name)) end",
    "registration_date": "case when c_custkey % 97 = 0 then 'n/a' else concat('2022-', lpad(cast(1 + c_custkey % 12 as {text}), 2, '0'), '-', lpad(cast(1 + c_custkey % 28 as {text}), 2, '0')) end",
    "_ingest_ts": "case when copy = 2 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end",
}
CUSTOMERS_REDELIVERED, CUSTOMERS_UNKEYED = "c_custkey % 60 = 0", "c_custkey % 300 = 0"

DEVICES = {
    "device_id": "case when copy = 3 then ' ' else concat(cast(p_partkey as {text}), ' ') end",
    "brand": "concat(' ', p_brand)",
    "device_type": "concat(p_type, ' ')",
    "model_series": "concat(' ', p_name, ' ')",
    "warranty_months": "case when copy = 2 then 0 when p_size <= 12 then 6 when p_size <= 25 then 12 when p_size <= 38 then 18 else 24 end",
    "price_range": f"case when p_partkey % 37 = 0 then null when p_partkey % 41 = 0 then 'on request' else {_TIER} end",
    "_ingest_ts": "case when copy = 2 then timestamp '2024-01-01 00:00:00' else timestamp '2024-01-02 00:00:00' end",
}
DEVICES_REDELIVERED, DEVICES_UNKEYED = "p_partkey % 60 = 0", "p_partkey % 300 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _copies(rows: DataFrame, again: str, unkeyed: str = "false") -> DataFrame:
    numbers = f"case when {unkeyed} then array(1, 2, 3) when {again} then array(1, 2) else array(1) end"
    return rows.selectExpr("*", f"explode({numbers}) as copy")


def _project(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{e.format(text='string')} as {name}" for name, e in columns.items()])


# Of the stored line items, for one task; about a quarter of a million jobs.
BYTES_A_TASK = 4 << 20


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """As many as the jobs need, so that what a task holds does not grow with the tables."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(size(spark, f"{sf_dir}/lineitem.parquet") / BYTES_A_TASK))


# Of stored customers or parts, for one task; some ten thousand rows.
DIMENSION_BYTES_A_TASK = 1 << 20


def _dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of one file in as many tasks as it needs, which then write as many files: each is read by one task."""
    tasks = math.ceil(size(spark, f"{sf_dir}/{name}.parquet") / DIMENSION_BYTES_A_TASK)
    rows = table(spark, sf_dir, name)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # By order, as a join with a large table of orders needs it. A file of one row group would else keep one task busy.
    lines = table(spark, sf_dir, "lineitem").repartition(_tasks(spark, sf_dir), "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    joined = joined.join(suppliers, joined.l_suppkey == suppliers.s_suppkey, "left")
    return _project(_copies(joined, JOBS_REDELIVERED), JOBS)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = _dealt(spark, sf_dir, "customer", "c_custkey"), table(spark, sf_dir, "nation")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    return _project(_copies(joined, CUSTOMERS_REDELIVERED, CUSTOMERS_UNKEYED), CUSTOMERS)


def raw_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_copies(_dealt(spark, sf_dir, "part", "p_partkey"), DEVICES_REDELIVERED, DEVICES_UNKEYED), DEVICES)


def _sql(columns: dict[str, str], source: str, again: str, unkeyed: str = "false") -> str:
    chosen = ",\n  ".join(f"{e.format(text='varchar')} as {name}" for name, e in columns.items())
    return f"""select {chosen}
from {source} cross join (values (1), (2), (3)) as copies(copy)
where copy = 1 or (copy = 2 and ({again})) or (copy = 3 and ({unkeyed}))"""


# The same tables for DuckDB.
RAW_JOBS_SQL = _sql(
    JOBS,
    "lineitem join orders on l_orderkey = o_orderkey left join supplier on l_suppkey = s_suppkey",
    JOBS_REDELIVERED,
)
RAW_CUSTOMERS_SQL = _sql(
    CUSTOMERS, "customer join nation on c_nationkey = n_nationkey", CUSTOMERS_REDELIVERED, CUSTOMERS_UNKEYED
)
RAW_DEVICES_SQL = _sql(DEVICES, "part", DEVICES_REDELIVERED, DEVICES_UNKEYED)
