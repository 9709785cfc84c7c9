"""Profiling of raw data."""

from pyspark.sql import DataFrame, functions as F

from stratalake.operators.dedupe import business_columns, row_hash


def profile(df: DataFrame, ignore_prefix: str = "_", approximate: bool = False) -> DataFrame:
    """One row per business column: row_count, null_count, distinct_count, duplicate_rows.

    ``duplicate_rows`` counts exact copies over all business columns and is the same on every line. An empty table gives zeros.
    The table is read once. Copies are told by a 128-bit hash of the row, which is counted like one more column. Values are
    counted inside the tasks before they are shuffled, so a frequent one is no hot spot. All counts are exact.

    ``approximate`` estimates distinct values and rows (within 5 %) instead, without a shuffle of values.
    """
    columns = business_columns(df, ignore_prefix)
    texts = [F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
    row = row_hash([F.col(c).cast("string") for c in columns]).alias("row")
    names = [f"c{i}" for i in range(len(columns))] + ["row"]
    rows = df.select(*texts, row)
    if approximate:
        measured = rows.agg(
            F.count("row").alias("rows"),
            *[F.count(n).alias(f"filled_{n}") for n in names],
            *[F.least(F.approx_count_distinct(n, 0.05), F.count(n)).alias(f"distinct_{n}") for n in names],
        )
    else:
        values = rows.unpivot([], names, "name", "value").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        filled = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
        by_name = values.groupBy("name").agg(F.sum("n").alias("rows"), filled.alias("filled"), F.count("value").alias("distinct"))
        of = lambda n, what: F.coalesce(F.max(F.when(F.col("name") == n, F.col(what))), F.lit(0))
        measured = by_name.agg(
            of("row", "rows").alias("rows"),
            *[of(n, what).alias(f"{what}_{n}") for n in names for what in ("filled", "distinct")],
        )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"filled_c{i}")).alias("null_count"),
            F.col(f"distinct_c{i}").alias("distinct_count"),
            (F.col("rows") - F.col("distinct_row")).alias("duplicate_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return measured.select(F.inline(F.array(*lines)))
