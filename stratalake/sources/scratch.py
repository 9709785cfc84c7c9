"""Folders for intermediate results."""

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from functools import wraps
from typing import Concatenate, ParamSpec, TypeVar

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.files import delete

P = ParamSpec("P")
T = TypeVar("T")

_SETTING = "spark.checkpoint.dir"
#: Of Spark 4.1 on; earlier ones do not know it and go on as they do.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What one shuffle may put on disk. Stored rows that need more are shuffled in passes, each with the keys of its own.
BYTES_A_PASS = 6 << 30
_chosen: dict[str, str] = {}


def use_scratch(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of an application whose cluster names none. The cluster's own setting goes first."""
    _chosen.setdefault(spark.sparkContext.applicationId, folder)


def has_scratch(spark: SparkSession) -> bool:
    return bool(spark.conf.get(_SETTING, None) or _chosen.get(spark.sparkContext.applicationId))


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder that the cluster names in ``spark.checkpoint.dir``.

    The setting is required. Where it is unset, :func:`use_scratch` can name a folder for the application.
    """
    root = spark.conf.get(_SETTING, None) or _chosen.get(spark.sparkContext.applicationId)
    if not root:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return f"{root.rstrip('/')}/stratalake/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write the frame to the shared scratch folder and read it back.

    Use it where a frame is read more than once: its plan runs once, its size becomes known to the optimizer,
    and the result outlives any executor.
    """
    return stage_at(df, purpose)[0]


def stage_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the folder."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def staged(rows: DataFrame | Sequence[DataFrame], purpose: str) -> Iterator[DataFrame]:
    """As :func:`stage`, for as long as the block lasts: then the folder is deleted, so no frame that reads it may leave the block unwritten.

    Several frames of one schema, as of several :func:`passes`, are written one after the other.
    """
    frames = [rows] if isinstance(rows, DataFrame) else rows
    spark, schema = frames[0].sparkSession, frames[0].schema
    path = scratch_folder(spark, purpose)
    try:
        for df in frames:
            df.write.mode("append").option("compression", "zstd").parquet(path)
        yield spark.read.schema(schema).parquet(path)
    finally:
        delete(spark, path)


def passes(number: int, bytes_a_row: int = 110) -> int:
    """In how many passes by key so many stored rows are to be shuffled. Under :func:`brief_shuffles` the files of a pass are gone before the next begins.
    By default rows are as wide as a job with all its columns, compressed."""
    return max(1, math.ceil(number * bytes_a_row / BYTES_A_PASS))


@contextmanager
def _option(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """An option of the session, for as long as the block lasts."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """In the block, the session's shuffle files go as the query that wrote them ends. By default Spark deletes them when the driver happens to collect
    garbage, so that those of many queries lie side by side. A frame that is computed again shuffles again."""
    return _option(spark, _CLEANUP, "true")


def small_reads(spark: SparkSession) -> AbstractContextManager[None]:
    """In the block, tasks read so little of stored rows that they sort it in memory: compressed rows take many times their bytes on disk."""
    return _option(spark, "spark.sql.files.maxPartitionBytes", str(16 << 20))


def with_brief_shuffles(run: Callable[Concatenate[SparkSession, P], T]) -> Callable[Concatenate[SparkSession, P], T]:
    """The function under :func:`brief_shuffles`."""

    @wraps(run)
    def wrapped(spark: SparkSession, *args: P.args, **kwargs: P.kwargs) -> T:
        with brief_shuffles(spark):
            return run(spark, *args, **kwargs)

    return wrapped
