"""Mixing sources to target weights by Pareto order sampling, with Spark expressions only.

A source that shall give ``target`` words out of ``size`` words gives ``target / size`` copies of each document on
average. The whole part is certain: so many whole copies of every document. The words that are still missing are drawn from one more copy
of each, with unequal probabilities: a document of class ``floor(log2(size))`` weighs one more than its class, so longer documents are
likelier to come once more. Inclusion probabilities are the weights times a factor per source, such that the expected words are
those missing; where that would reach 1, the copy is certain too, and the factor follows from the others.

The draw: each document has an inclusion probability ``p`` and a random number ``u``, and documents are taken in the order of
``u / (1 - u)`` divided by ``p / (1 - p)`` until the missing words are found. The sample has a fixed size in words, not only on
average: the last document is taken in part.

Nothing is collected per source. Probabilities come from sums per source and class. The ranking variable is cut into bins; sums per
bin show where the target falls, and only documents of the same bin are sorted together.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stratalake.llm.common import WORD, uniform
from stratalake.sources.scratch import stage

MAX_REPEATS = 3
#: Bins of the ranking variable per source. At 10**10 documents of one source a bin holds about 150,000 short rows.
BINS = 65_536


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Sources in code point order, null last, weigh the numbers of ``cycle`` in turn. One row per source comes in."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w).cast("long") for w in cycle])
    return sources.withColumn("weight", F.get(weights, place % len(cycle)))


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target``: the sum of all sizes shared by weight, at most ``max_repeats`` times the size of a source.

    Takes one row per source (``source``, ``source_size``, ``weight``). Sources in the order of size by weight fill up one
    after the other; each is full if its share of what the full ones before it leave exceeds its limit.
    """
    everything = W.partitionBy()
    order = W.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(W.unboundedPreceding, -1)
    filled = sources.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(order), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(order), F.lit(0)).alias("weight_before"),
    )
    limit = F.col("source_size") * max_repeats
    rest = F.col("total") - F.col("size_before") * max_repeats
    rest_weights = F.col("weights") - F.col("weight_before")
    full = filled.withColumn("full", limit * rest_weights <= F.col("weight") * rest)
    # Once a source is not full, none after it is; those share what the full ones leave.
    shared = full.select(
        "*",
        F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything).alias("full_size"),
        F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything).alias("full_weight"),
    )
    share = (
        F.col("weight").cast("double")
        * (F.col("total") - F.col("full_size") * max_repeats).cast("double")
        / (F.col("weights") - F.col("full_weight")).cast("double")
    )
    return shared.select(
        "source", "source_size", F.when(F.col("full"), limit.cast("double")).otherwise(share).alias("target")
    )


def inclusions(classes: DataFrame) -> DataFrame:
    """Which classes of a source are drawn with certainty, and with what probability the others.

    Takes ``source``, ``class``, ``class_size`` (words) and ``missing`` (words that the source still has to give). Adds ``certain``, ``p`` and
    ``left`` (missing words without those of certain classes). The classes that weigh most become certain first, one after the other.
    """
    weight = F.col("class") + 1
    heavier = W.partitionBy("source").orderBy(F.col("class").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("source")
    summed = classes.select(
        "*",
        F.coalesce(F.sum("class_size").over(heavier), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum(weight * F.col("class_size")).over(heavier), F.lit(0)).alias("weighed_before"),
        F.sum(weight * F.col("class_size")).over(whole).alias("weighed"),
    )
    reaches = weight * (F.col("missing") - F.col("size_before")) >= F.col("weighed") - F.col("weighed_before")
    judged = summed.withColumn("certain", reaches & (F.col("missing") > 0))
    certain, weighed = F.col("certain"), weight * F.col("class_size")
    rest = judged.select(
        "source",
        "class",
        "certain",
        (F.col("missing") - F.sum(F.when(certain, F.col("class_size")).otherwise(0)).over(whole)).alias("left"),
        F.sum(F.when(certain, 0).otherwise(weighed)).over(whole).alias("uncertain"),
    )
    factor = F.when(F.col("uncertain") > 0, F.col("left").cast("double") / F.col("uncertain").cast("double")).otherwise(F.lit(0.0))
    p = F.least(F.greatest(factor * weight.cast("double"), F.lit(1e-12)), F.lit(1 - 1e-12))
    return rest.select("source", "class", "certain", "left", p.alias("p"))


def mix_sources(
    docs: DataFrame,
    weigh=cycle_weights,
    max_repeats: int = MAX_REPEATS,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    bins: int = BINS,
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, source, size, source_size, target, p, copies, taken``.

    ``taken`` counts words with repeats: ``copies`` whole copies, and in the last drawn document a part. Sums of ``taken`` per
    source equal the rounded target. ``weigh`` adds the column ``weight`` to the table of sources. ``p`` is the probability of the copy
    that is drawn, 1 where it is certain.

    Empty and null texts have size 0 and take nothing; a null source is a source. Repeated rows are documents of their own: rows of one
    id, text and source are numbered, so each has a random number of its own. An empty table gives no rows. Reruns agree, whatever the
    partitioning, also for rows without an id.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.md5(text.cast("binary")).alias("digest"),
        F.col(source_column).alias("source"),
        count_words(F.col(text_column)).alias("size"),
    )
    # Counted in the tasks, so copies are numbered without meeting.
    sized = stage(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")), "mix_sizes")
    size_class = F.length(F.bin("size")) - 1
    classes = sized.groupBy("source", size_class.alias("class")).agg(F.sum(F.col("size") * F.col("times")).alias("class_size"))
    classes = stage(classes, "mix_classes")
    per_source = classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    plan = targets(weigh(per_source), max_repeats)

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = plan.withColumn("whole", F.least(F.floor(rate), F.lit(max_repeats)))
    planned = planned.withColumn("missing", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    planned = stage(planned, "mix_targets")
    drawn_from = stage(inclusions(_same_source(classes, planned)), "mix_classes_drawn")

    # Numbers of copies in two steps, as they may be many.
    many = F.lit(10_000).cast("long")
    copies = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / many))))
    first = F.col("block") * many + 1
    copies = copies.withColumn("copy", F.explode(F.sequence(first, F.least(first + many - 1, F.col("times")))))

    of_source = planned.select(F.col("source").alias("s"), "source_size", "target", "whole")
    of_class = drawn_from.select(F.col("source").alias("c"), "class", "certain", "left", "p")
    known = copies.join(of_source, F.col("source").eqNullSafe(F.col("s"))).join(
        of_class, F.col("source").eqNullSafe(F.col("c")) & (size_class == F.col("class"))
    )
    u = uniform(F.lit(seed), F.col("doc_id"), F.col("size"), F.col("digest"), F.col("copy"))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    # What is certain does not compete, so it takes no room in the order.
    ranked = known.withColumn("rank", odds).withColumn("asks", F.when(F.col("certain"), 0).otherwise(F.col("size")))
    # rank / (1 + rank) lies in (0, 1) and keeps the order.
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * bins).cast("int"))

    per_bin = ranked.groupBy("source", "bin").agg(F.sum("asks").alias("bin_size"))
    before = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bin_starts = per_bin.select(
        F.col("source").alias("bin_source"), F.col("bin").alias("b"), F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("bin_start")
    )
    placed = ranked.join(bin_starts, F.col("source").eqNullSafe(F.col("bin_source")) & (F.col("bin") == F.col("b")))
    inside = (
        W.partitionBy("source", "bin")
        .orderBy("rank", "doc_id", "size", "digest", "copy")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    start = F.col("bin_start") + F.coalesce(F.sum("asks").over(inside), F.lit(0))
    drawn = F.when(F.col("certain"), F.col("size")).otherwise(
        F.least(F.col("size"), F.greatest(F.lit(0), F.col("left") - start))
    )
    return placed.select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("certain"), 1.0).otherwise(F.col("p")).alias("p"),
        (F.col("whole") + F.when(drawn > 0, 1).otherwise(0)).alias("copies"),
        (F.col("whole") * F.col("size") + drawn).cast("long").alias("taken"),
    )


def _same_source(sized: DataFrame, planned: DataFrame) -> DataFrame:
    other = planned.withColumnRenamed("source", "planned_source")
    return sized.join(other, F.col("source").eqNullSafe(F.col("planned_source"))).drop("planned_source")
