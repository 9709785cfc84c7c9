"""De-duplication with a defined survivor."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def business_columns(df: DataFrame, ignore_prefix: str = "_") -> list[str]:
    """All columns but the load metadata, which starts with ``ignore_prefix``."""
    return [c for c in df.columns if not c.startswith(ignore_prefix)]


def row_hash(columns: Sequence[Column]) -> Column:
    """128 bits of a row of texts, as hex digits: two hashes that start differently. Nulls count, so that a value in another column is another row."""
    told = [part for c in columns for part in (c, c.isNull())]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(start), *told)), 16, "0") for start in (1, 2)])


def dedupe_exact_rows(df: DataFrame, ignore_prefix: str = "_") -> DataFrame:
    """One row per combination of business columns, with the metadata of its latest copy.

    Several metadata columns are compared in column order, and all come from the same copy. Losers are dropped inside
    the tasks first (see :func:`keep_latest_per_key`), so a row sent a billion times costs one row per task.
    """
    business = business_columns(df, ignore_prefix)
    metadata = [c for c in df.columns if c not in business]
    if not metadata:
        return df.distinct()
    if len(metadata) == 1:
        return df.groupBy(business).agg(F.max(metadata[0]).alias(metadata[0])).select(df.columns)
    return keep_latest_per_key(df, business, metadata[0], metadata[1:])


def keep_latest_per_key(
    df: DataFrame,
    key_cols: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The row with the highest ``order_col`` per key; ties go to the highest ``tie_breakers``.

    A tie breaker is a column name, of which the highest value wins and null loses, or a sort order such as
    ``F.col("x").asc()``. Without any, all other columns break ties in column order. Then only exact copies can tie
    and the result does not depend on the order of the input. Spark drops the losers before the shuffle too
    (WindowGroupLimit), so a hot key sends at most one row per task.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c != order_col and c not in key_cols]
    recency = [F.col(c).desc() if isinstance(c, str) else c for c in (order_col, *tie_breakers)]
    position = F.row_number().over(Window.partitionBy(*key_cols).orderBy(*recency))
    return df.withColumn("__position", position).filter(F.col("__position") == 1).drop("__position")
