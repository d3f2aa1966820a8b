"""File readers with an explicit schema and an explicit answer to bad rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.times import as_date, on_day
from tidegate.sinks import storage
from tidegate.sources.parsing import as_struct, as_text, parse_records, typed

NULL_TOKENS = ("NULL", "null", "")


class EmptyInput(ValueError):
    """A source that must deliver rows delivered none."""


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def read_json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one array or one object; a broken file yields no rows."""
    rows = F.from_json("value", T.ArrayType(as_text(schema)))
    parsed = _whole_files(spark, path).select(F.inline(rows))
    return parsed.select([typed(F.col(f.name), f.dataType).alias(f.name) for f in as_struct(schema).fields])


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """The files :func:`read_json_files` skipped, for the run log."""
    df = _whole_files(spark, path).withColumn("file", F.col("_metadata.file_path"))
    return df.filter(F.try_parse_json("value").isNull()).select("file")


def read_jsonl(spark: SparkSession, path: str, schema: str, require_rows: bool = True) -> DataFrame:
    """JSON lines: blank lines ignored, malformed lines dropped, no rows is an error."""
    lines = spark.read.text(path).withColumnRenamed("value", "_line")
    good = parse_records(lines, "_line", schema).filter(~F.col("_bad")).drop("_bad", "_line")
    if require_rows and not good.take(1):
        raise EmptyInput(f"{path} is empty or unreadable")
    return good


def read_csv_strict(
    spark: SparkSession, paths: str | Sequence[str], schema: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """CSV with header; null tokens become null and any other bad value aborts.

    Columns are read as text so that the tokens can be recognised in every
    type; the casts afterwards are strict, so a bad value stops the job.
    """
    target = as_struct(schema)
    raw = (
        spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields]))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    return raw.select(
        [
            F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def list_inputs(spark: SparkSession, pattern: str, required: bool = True) -> str | None:
    """The glob itself when it matches, None when an optional drop is empty."""
    if storage.any_file(spark, pattern):
        return pattern
    if required:
        raise EmptyInput(f"no input matches {pattern}")
    return None


def read_latest(
    spark: SparkSession, pattern: str, reader: Callable[[str], DataFrame], schema: str
) -> DataFrame:
    """Only the greatest matching path is read; no match gives an empty table."""
    newest = storage.newest_file(spark, pattern)
    return spark.createDataFrame([], as_struct(schema)) if newest is None else reader(newest)


def hour_prefix(at: dt.datetime, pattern: str = "%Y/%m/%d/%H", back: int = 1) -> str:
    """Path prefix of the hour before ``at`` (``back=0``: of the hour itself)."""
    return (at.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=back)).strftime(pattern)


def scan_date(df: DataFrame, date_col: str, run_date) -> DataFrame:
    """One business date. A timestamp column gets a range, which still reaches the scan."""
    if isinstance(df.schema[date_col].dataType, T.DateType):
        return df.filter(F.col(date_col) == as_date(run_date))
    return df.filter(on_day(date_col, run_date))


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: str, int_defaults: Sequence[str] = ()) -> DataFrame:
    """Namespaced XML records; tags are named without prefix, missing integers are 0."""
    df = (
        spark.read.format("xml")
        .schema(as_struct(schema))
        .option("rowTag", row_tag)
        .option("ignoreNamespace", True)
        .load(path)
    )
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in int_defaults})
