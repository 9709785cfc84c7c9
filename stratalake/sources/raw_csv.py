"""CSV files with a fixed schema, what is lost as they are read, and the metadata of a load."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: What a column of a type but text could not hold, as an array of structs of column and text.
LOST = "_lost"
#: The whole record if it has too few or too many columns.
RECORD = "_raw_record"
LOST_TYPE = "array<struct<column:string,text:string>>"


def csv_options(multi_line: bool = True, strict: bool = False, header: bool = True) -> dict[str, str]:
    """Reader options for files with doubled quotes, and a header unless told otherwise.

    ``multi_line`` allows line breaks inside quoted fields. Spark cannot split such a file, so deliver big feeds
    as many files, or turn it off where no field holds a line break: then one file is read by many tasks.

    By default a value of the wrong type becomes null and columns are taken by position. ``strict`` raises on
    malformed rows and on a header that does not match the schema.
    """
    options = {"header": str(header).lower(), "multiLine": str(multi_line).lower(), "escape": '"'}
    if strict:
        # A pruned column is not parsed, so that its errors would go unseen.
        options |= {"mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false"}
    return options


def read_raw_csv(
    spark: SparkSession, path: "str | list[str]", schema: str, multi_line: bool = True, strict: bool = False
) -> DataFrame:
    return spark.read.schema(schema).options(**csv_options(multi_line, strict)).csv(path)


def checked_options(multi_line: bool = True, header: bool = True) -> dict[str, str]:
    """Options for a reader with :func:`text_schema`."""
    # Without all columns the parser would not see that a record has too many.
    return csv_options(multi_line, header=header) | {"columnNameOfCorruptRecord": RECORD, "columnPruning": "false"}


def text_schema(schema: str) -> StructType:
    """All columns as text, and the record where their number is wrong."""
    names = [*StructType.fromDDL(schema).fieldNames(), RECORD]
    return StructType([StructField(name, StringType()) for name in names])


def type_columns(texts: DataFrame, schema: str) -> DataFrame:
    """The columns of ``texts`` in the types of the schema, with :data:`LOST`. Blank text is null in any type but text."""
    typed, lost, anything = {}, [], F.lit(False)
    for field in StructType.fromDDL(schema).fields:
        if isinstance(field.dataType, StringType):
            continue
        text, value = F.col(field.name), F.col(field.name).try_cast(field.dataType)
        typed[field.name] = value
        is_lost = (F.trim(text) != "") & value.isNull()
        anything = anything | is_lost
        lost.append(F.when(is_lost, F.struct(F.lit(field.name).alias("column"), text.alias("text"))))
    nothing = F.array().cast(LOST_TYPE)
    # Most rows lose nothing: they need no list that is then thinned out.
    kept = F.when(anything, F.array_compact(F.array(*lost)).cast(LOST_TYPE)).otherwise(nothing) if lost else nothing
    return texts.withColumns(typed | {LOST: kept})


def read_checked_csv(
    spark: SparkSession, path: "str | list[str]", schema: str, multi_line: bool = True, header: bool = True
) -> DataFrame:
    """As :func:`read_raw_csv`, but nothing is lost unseen: :data:`LOST` keeps text that a column could not hold, :data:`RECORD` a record
    with the wrong number of columns. Of such a record, columns are taken by position as far as they go.
    """
    texts = spark.read.schema(text_schema(schema)).options(**checked_options(multi_line, header)).csv(path)
    return type_columns(texts, schema)


def lost_something() -> Column:
    """The condition that a row of a checked read lost something."""
    return (F.size(LOST) > 0) | F.col(RECORD).isNotNull()


def lost_from(column: str) -> Column:
    return F.exists(LOST, lambda x: x["column"] == column)


def new_batch_id() -> str:
    """The current UTC time as ``yyyyMMddHHmmss``."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")


def with_ingestion_metadata(
    df: DataFrame, source_file: "str | Column | None" = None, batch_id: str | None = None
) -> DataFrame:
    """Add _ingest_ts (now), _source_file and _batch_id.

    Without ``source_file`` each row names the very file it was read from; the frame must then be a file scan.
    """
    if source_file is None:
        source_file = F.col("_metadata.file_path")
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    return df.withColumns(
        {
            "_ingest_ts": F.current_timestamp(),
            "_source_file": source_file,
            "_batch_id": F.lit(batch_id or new_batch_id()),
        }
    )
