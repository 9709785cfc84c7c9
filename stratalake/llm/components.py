"""Connected components by alternating large-star and small-star.

Both steps hang neighbours on smaller nodes: the large star moves the larger neighbours of a node to the smallest node around
it, the small star moves a node and its smaller neighbours there. When nothing changes, every node hangs on
the smallest node of its component. A step is one minimum per node and one join, so no neighbourhood is ever
collected, and Spark splits the rows of a node with very many edges.
"""

from pyspark.sql import DataFrame, functions as F

from stratalake.sources.scratch import stage


def _minima(edges: DataFrame) -> DataFrame:
    """The smallest neighbour by node. Stored, as Spark can split a hot node only where both sides of a join are shuffled."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("smallest")), "star_minima")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    found = both.join(_minima(both), "u").where("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "smallest").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    minima = _minima(down)
    moved = down.join(minima, "u").select(F.col("v").alias("u"), F.col("smallest").alias("v"))
    return moved.union(minima.select("u", F.col("smallest").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a, b``), where root is the smallest node of its component.

    Links of a node to itself, repeated links and either direction are fine; links with a null end are left out. Without
    links there are no rows.
    """
    ends = links.select("a", "b").where("a is not null and b is not null")
    edges = stage(ends.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "star_edges")
    before, now = None, _state(edges)
    while before != now:
        large = stage(_large_star(edges), "star_edges")
        edges = stage(_small_star(large), "star_edges")
        before, now = now, _state(edges)
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return hung.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
