"""Gaps between successive visits."""

from pyspark.sql import DataFrame, Window, functions as F


def visit_gaps(
    df: DataFrame,
    entity: str = "customer_id",
    visited: str = "received_date",
    visit_id: str = "job_id",
) -> DataFrame:
    """Add the date of the entity's previous visit and the days since then.

    Visits are ordered by date, then by ``visit_id`` (unique). Visits without a date come first. Visits of nobody (a null
    entity) have no gaps, as they need not be of one. ``df`` is read twice, so pass it stored if it is expensive.

    The window runs over the *days* of an entity, not over its visits: one row per day, so its size is bound by
    the calendar even if one entity owns a third of all visits. Of the visits of a day, the first looks back
    to the previous day and the others to the day itself.
    """
    days = df.filter(F.col(entity).isNotNull()).groupBy(entity, visited).agg(F.min(visit_id).alias("__first_id"))
    day_before = F.lag(visited).over(Window.partitionBy(entity).orderBy(F.col(visited).asc_nulls_first()))
    days = days.select(
        F.col(entity).alias("__entity"), F.col(visited).alias("__day"), "__first_id", day_before.alias("__day_before")
    )
    same_day = (F.col(entity) == F.col("__entity")) & F.col(visited).eqNullSafe(F.col("__day"))
    first = F.col(visit_id) == F.col("__first_id")
    previous = F.when(F.col(entity).isNotNull(), F.when(first, F.col("__day_before")).otherwise(F.col(visited)))
    return (
        df.join(days, same_day, "left")
        .withColumns(
            {"prev_received_date": previous, "days_since_prev_visit": F.datediff(F.col(visited), previous)}
        )
        .select(*df.columns, "prev_received_date", "days_since_prev_visit")
    )
