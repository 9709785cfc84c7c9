"""Folders of any file system that Spark can reach."""

import re

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _open(spark, path)
    return system.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files below a folder."""
    place, system = _open(spark, path)
    return system.getContentSummary(place).getLength()


def broadcast_limit(spark: SparkSession) -> int:
    """The bytes up to which Spark broadcasts a stored table; negative if it never does."""
    number, unit = re.match(r"\s*(-?\d+)\s*([kmgtp]?)", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def delete(spark: SparkSession, path: str) -> None:
    place, system = _open(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; what ``target`` held is gone."""
    place, system = _open(spark, source)
    goal, _ = _open(spark, target)
    system.delete(goal, True)
    system.mkdirs(goal.getParent())
    if not system.rename(place, goal):
        raise OSError(f"could not move {source} to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders below a path, oldest first; none if it does not exist."""
    place, system = _open(spark, path)
    if not system.exists(place):
        return []
    found = [s for s in system.listStatus(place) if s.isDirectory()]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getModificationTime())]
